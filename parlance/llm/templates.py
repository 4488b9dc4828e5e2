"""HTML extraction by template deduction from equivalence classes.

Pages of a host are filled-in copies of a template. A token is an opened
container, named by its path, or a block of text at a path. Tokens that occur
equally often on every page of the host share an occurrence vector; tokens with
one vector are an equivalence class, and a class of several tokens that covers
the host's pages is part of the template. Paths nest: a class holds another one
if its containers are prefixes of the other's. What the template leaves open are
its slots. The slots below boilerplate containers (menus, headers, footers,
sidebars, notices, adverts, forms, comments) are dropped. A template container
that holds the share ``DOMINANT`` of the host's slot text holds the main text;
such containers are nested, and of them the one that is named as an article or
main element counts, or without such a name the innermost, if the template has
others beside it, or a named one in it with most of the slot text. Else the named
one with most slot text does. Text inside a named one is never
taken for template, however many pages repeat it; of an unnamed one the slots
are the main text, on pages where it has any. On a page that deviates
from its host's template its own article, main or body element is used, without
the text that the template explains.

Classes and ids name boilerplate by their whole words only. Boilerplate that is
or holds an article or main element is not dropped if the page has none with
text outside boilerplate. On a page without any, and without a main container of
its host, a name drops nothing that holds most of the page's slot text.

Vectors are compared by sums of page hashes with counts, so they are partial
sums per host and token; neither the pages nor the tokens of a host are ever
gathered. Rows of a host with equal html are one page. Hosts with fewer than
``MIN_PAGES`` pages are pooled. Template text never takes all slot text of a
page: what only some pages of the host have stays there, or else all of it. Only
tokens on the share ``MIN_SHARE`` of a host's pages are brought together, so they
are at most 1 / ``MIN_SHARE`` times the tokens of an average page.

Defined results: null or empty html gives an empty text. A null url belongs to
the host without name. Repeated rows each get their result; extra columns do not
matter. Broken markup is closed as browsers do in the common cases: an end tag
closes what it contains, a block closes an open paragraph, and the end of the
page closes everything.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from parlance.llm.storage import stored

MIN_PAGES = 3
MIN_CLASS = 3
MIN_SHARE = 0.5
DOMINANT = 0.9

# --- Fixed values: elements by their meaning -----------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select".split())
# Of the elements above, those that end where they begin with "/>"; elsewhere that means nothing.
FOREIGN = frozenset(["svg"])
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre section summary table tbody td tfoot th thead tr ul".split()
)
BOILERPLATE = frozenset("nav footer aside form menu dialog button head fieldset".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice alert newsletter subscribe subscription signup popup modal overlay sidebar aside widget "
    "widgets related recommended recommendations share sharing social menu nav navbar navigation breadcrumb "
    "breadcrumbs footer comment comments commentlist disqus discussion replies respond responses pagination pager "
    "login search toolbar "
    "cookie-notice cookie-banner cookie-consent site-footer page-footer main-nav site-nav nav-menu main-menu "
    "main-navigation site-navigation widget-area comments-area comment-list comment-respond share-buttons social-share "
    "social-links related-posts newsletter-signup sidebar-left sidebar-right left-sidebar right-sidebar".split()
)
HEADER_NAMES = frozenset("header masthead topbar site-header page-header".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
ARTICLE, MAIN, CONTENT, PLAIN = 3, 2, 1, 0
CONTENT_NAMES = frozenset("article content post entry story body main text".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a string only behind an equals sign.
    r"|<(/?)([A-Za-z][^\s/>]*)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)|[^>=])*+)(?:>|\Z)", re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Za-z0-9]+")


class Block(NamedTuple):
    """A block of text: its container's path, whether boilerplate holds it, and the innermost open container (or -1).

    ``owner`` is the element that drops it if that is only one and it does so by
    its class or id, else -1.
    """

    text: str
    path: str
    dropped: bool
    inside: int
    owner: int


class Container(NamedTuple):
    """An opened container: its path, the rank of its element as the holder of the main text, and the container around it.

    A path is a hash of the path around it and the container's own name, so its
    length does not grow with the depth.
    """

    path: str
    rank: int
    dropped: bool
    parent: int


class _Open(NamedTuple):
    tag: str
    path: str
    number: int
    article: bool
    element: int


class _Element(NamedTuple):
    """An element: the one around it, why it is boilerplate, and whether it is an article or main element."""

    parent: int
    why: int
    main: bool


KEPT, NAMED, FIRM = 0, 1, 2


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def _names(attributes: dict[str, str]) -> set[str]:
    return {n.lower() for key in ("class", "id") for n in _NAME.findall(attributes.get(key, ""))}


def _boilerplate(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    """Whether an element is boilerplate, by its meaning (``FIRM``) or by a whole word of its class or id (``NAMED``)."""
    if tag in ("html", "body", "main"):
        return KEPT
    if tag in BOILERPLATE or "hidden" in attributes or attributes.get("role", "").lower() in BOILERPLATE_ROLES:
        return FIRM
    if not in_article and tag == "header":
        return FIRM
    words = {w.lower() for key in ("class", "id") for w in attributes.get(key, "").split()}
    return NAMED if words & BOILERPLATE_NAMES or not in_article and words & HEADER_NAMES else KEPT


def _dropped(elements: list[_Element], spared: set[int]) -> list[tuple[int, int, int]]:
    """Per element: how many elements from it outwards drop it, the outermost of them, and why that one does."""
    out: list[tuple[int, int, int]] = []
    for k, (parent, why, _) in enumerate(elements):
        count, owner, reason = out[parent] if parent >= 0 else (0, -1, KEPT)
        if why and k not in spared:
            count, owner, reason = count + 1, owner if count else k, reason if count else why
        out.append((count, owner, reason))
    return out


def _spared(elements: list[_Element], found: list[tuple[int, int]]) -> tuple[set[int], bool]:
    """Boilerplate that is or holds an article or main element, on a page that has none with text outside boilerplate.

    Also whether such elements hold at least as much text as is left without
    them. ``found`` has the element and length of each block.
    """
    if not any(e.main for e in elements):
        return set(), True
    in_main: list[bool] = []
    for parent, _, main in elements:
        in_main.append(main or parent >= 0 and in_main[parent])
    state = _dropped(elements, set())
    if any(in_main[k] and not state[k][0] for k, _ in found if k >= 0):
        return set(), True
    held = outside = 0
    spared: set[int] = set()
    # The nearest article or main element around each element, and the elements seen on the way out.
    around: list[int] = []
    for k, (parent, _, main) in enumerate(elements):
        around.append(k if main else around[parent] if parent >= 0 else -1)
    seen: set[int] = set()
    for k, size in found:
        if k >= 0 and in_main[k]:
            held += size
            k = around[k]
            while k >= 0 and k not in seen:
                seen.add(k)
                if elements[k].why:
                    spared.add(k)
                k = elements[k].parent
        elif k < 0 or not state[k][0]:
            outside += size
    return spared, held >= outside


def _rank(tag: str, attributes: dict[str, str]) -> int:
    if tag == "article":
        return ARTICLE
    if tag == "main" or attributes.get("role", "").lower() == "main":
        return MAIN
    return CONTENT if tag in ("div", "section", "td") and _names(attributes) & CONTENT_NAMES else PLAIN


def parse(page: str | None) -> tuple[list[Container], list[Block]]:
    """Containers and blocks of a page, in order."""
    page = page or ""
    found: list[tuple[str, str, int, int]] = []
    opened: list[tuple[str, int, int, int]] = []
    elements: list[_Element] = []
    stack = [_Open("", "", -1, False, -1)]
    inside: list[int] = [-1]
    open_tags: Counter[str] = Counter()
    parts: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        if text:
            found.append((text, stack[-1].path, inside[-1], stack[-1].element))

    def close(depth: int) -> None:
        for item in reversed(stack[depth:]):
            open_tags[item.tag] -= 1
            if item.number >= 0:
                inside.pop()
        del stack[depth:]

    at = 0
    while (m := _TAG.search(page, at)) is not None:
        parts.append(page[at:m.start()])
        at = m.end()
        if m[0].startswith("<![CDATA["):
            parts.append(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCKS:
                flush()
            if open_tags[tag]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        if tag in RAW:
            if tag in FOREIGN and m[3].endswith("/"):
                continue
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            parts.append(" ")
        if tag in BLOCKS:
            flush()
            # A block ends an open paragraph, and what is open inside it.
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag in BLOCKS), 0)
            if depth and stack[depth].tag == "p":
                close(depth)
            elif tag == "li" and depth and stack[depth].tag == "li":
                close(depth)
        if tag in VOID or m[3].endswith("/"):
            continue
        attributes = _attributes(m[3]) if m[3] else {}
        top = stack[-1]
        rank = _rank(tag, attributes)
        elements.append(_Element(top.element, _boilerplate(tag, attributes, top.article), rank >= MAIN))
        if tag in BLOCKS and tag != "p":
            name = ".".join([tag, *sorted(_names({"class": attributes.get("class", "")}))])
            path = xxhash.xxh64_hexdigest(f"{top.path}/{name}")
            opened.append((path, rank, len(elements) - 1, inside[-1]))
            number = len(opened) - 1
            inside.append(number)
        else:
            path, number = top.path, -1
        stack.append(_Open(tag, path, number, top.article or tag == "article", len(elements) - 1))
        open_tags[tag] += 1
    parts.append(page[at:])
    flush()
    spared, most = _spared(elements, [(element, len(text)) for text, _, _, element in found])
    state = _dropped(elements, spared)
    blocks = []
    for text, path, around, element in found:
        count, owner, why = state[element] if element >= 0 else (0, -1, KEPT)
        blocks.append(Block(text, path, count > 0, around, owner if count == 1 and why == NAMED else -1))
    # Spared elements with less text than the rest of the page add to it but do not stand for it.
    return [Container(path, rank if most or rank < MAIN else PLAIN, state[element][0] > 0, parent)
            for path, rank, element, parent in opened], blocks


def held(containers: list[Container], chosen: set[int]) -> list[bool]:
    """Per container: whether it is a chosen one or inside one."""
    out: list[bool] = []
    for k, container in enumerate(containers):
        out.append(k in chosen or container.parent >= 0 and out[container.parent])
    return out


def _token(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\t".join(parts)) - (1 << 63)


ROOT = _token("page")
TEXT, DROPPED = -2, -1
TOKENS = "host string, token bigint, rank int, low bigint, high bigint, pages bigint, chars bigint, up bigint"
LOW = (1 << 32) - 1


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of each page.

    Of each its rank (``TEXT`` for text), halves of the hash of page and count,
    characters of text outside boilerplate, and the token of the container around it.
    """
    for batch in batches:
        rows: list[tuple] = []
        for host, page, key in zip(
            batch.column("host").to_pylist(), batch.column("html"), batch.column("page").to_pylist(), strict=True,
        ):
            containers, blocks = parse(page.as_py())
            names = [_token("<", container.path) for container in containers]
            found: dict[int, list[int]] = {ROOT: [DROPPED, 1, 0, 0]}
            for name, container in zip(names, containers, strict=True):
                entry = found.setdefault(name, [
                    DROPPED if container.dropped else container.rank, 0, 0,
                    names[container.parent] if container.parent >= 0 else ROOT])
                entry[1] += 1
            slots = [0] * len(containers)
            for block in blocks:
                entry = found.setdefault(_token("text", block.path, block.text), [
                    TEXT, 0, 0, names[block.inside] if block.inside >= 0 else ROOT])
                entry[1] += 1
                if not block.dropped:
                    entry[2] += len(block.text)
                    found[ROOT][2] += len(block.text)
                    if block.inside >= 0:
                        slots[block.inside] += len(block.text)
            # Inner containers have larger numbers, so one pass backwards adds them to those around them.
            for number in range(len(containers) - 1, -1, -1):
                found[names[number]][2] += slots[number]
                if containers[number].parent >= 0:
                    slots[containers[number].parent] += slots[number]
            hashes = {count: xxhash.xxh64_intdigest(f"{key}:{count}") for _, count, _, _ in found.values()}
            rows += [
                (host, token, rank, hashes[count] & LOW, hashes[count] >> 32, 1, chars, up)
                for token, (rank, count, chars, up) in found.items()
            ]
        yield pa.RecordBatch.from_arrays([
            pa.array(column, kind) for column, kind in zip(
                zip(*rows, strict=True) if rows else [[]] * 8,
                (pa.string(), pa.int64(), pa.int32(), *[pa.int64()] * 5), strict=True)
        ], ["host", "token", "rank", "low", "high", "pages", "chars", "up"])


def _summed(tokens: DataFrame, key: str) -> DataFrame:
    return tokens.groupBy(key, "token").agg(
        F.max("rank").alias("rank"), *(F.sum(c).alias(c) for c in ("low", "high", "pages", "chars")), F.max("up").alias("up"))


def slot_chars(rows: list[dict]) -> tuple[dict[int, int], list[int]]:
    """Characters of slot text in each container of a template, ``ROOT`` being the page, and the containers from outer to inner.

    Slot text is all text outside boilerplate but that of the template.
    """
    slot = {r["token"]: r["chars"] for r in rows if r["rank"] != TEXT}
    up = {r["token"]: r["up"] for r in rows if r["rank"] != TEXT}
    fixed = dict.fromkeys(slot, 0)
    for r in rows:
        if r["rank"] == TEXT and r["valid"] and r["up"] in fixed:
            fixed[r["up"]] += r["chars"]
    waiting = Counter(up.values())
    order = [token for token in slot if not waiting[token]]
    # A container follows all those inside it, while the list grows.
    for token in order:
        slot[token] -= fixed[token]
        around = up[token]
        if around in fixed:
            fixed[around] += fixed[token]
            waiting[around] -= 1
            if not waiting[around]:
                order.append(around)
    return slot, order[::-1]


def main_container(rows: list[dict], pooled: bool = False) -> int | None:
    """Token of the template container that holds the main text.

    Without a name a container counts only if the template has others beside it,
    and only for pages of one host: in a pool of hosts its path says too little.
    """
    slot, order = slot_chars(rows)
    up = {r["token"]: r["up"] for r in rows}
    usable = {r["token"]: r for r in rows if r["valid"] and r["rank"] >= PLAIN and r["chars"] > 0}

    def best(tokens: list[int]) -> int | None:
        return max((t for t in tokens if usable[t]["rank"] > PLAIN), default=None, key=lambda t: (
            usable[t]["rank"], slot[t], usable[t]["chars"], t))

    dominant = [t for t in order if t in usable and 0 < slot[ROOT] * DOMINANT <= slot[t]]
    named = best(dominant)
    if named is not None or not dominant or pooled:
        return best(list(usable)) if named is None else named
    inner, around, within = dominant[-1], set(), {dominant[-1]}
    t = inner
    while t in up:
        around.add(t)
        t = up[t]
    for t in order:
        if up[t] in within:
            within.add(t)
    if all(r["token"] in around or r["token"] in within for r in rows if r["valid"] and r["rank"] >= DROPPED):
        return best(list(usable))
    named = best([t for t in usable if t in within and 2 * slot[t] > slot[ROOT]])
    return inner if named is None else named


def _deduced(group: pa.Table) -> pa.Table:
    """The main container and the template text of one group of pages, from the tokens on enough of them."""
    rows = group.to_pylist()
    text = [r for r in rows if r["valid"] and r["rank"] < PLAIN and r["token"] != ROOT]
    of = rows[0]["of"]
    return pa.table({
        "of": pa.array([of], pa.string()), "main": pa.array([main_container(rows, not of)], pa.int64()),
        "known": pa.array([[r["token"] for r in text]], pa.list_(pa.int64())),
        "fixed": pa.array([[r["token"] for r in text if r["pages"] == r["size"]]], pa.list_(pa.int64())),
    })


def _distinct(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row for all rows of a host with equal html. Only html that occurs more than once is shuffled for it."""
    page = ["host", "page", "other"]
    pages = pages.select("host", "html", F.xxhash64("html").alias("page"), F.xxhash64(F.lit("b"), "html").alias("other"))
    copied = stored(spark, pages.groupBy(page).agg(F.count("*").alias("n")).where("n > 1").select(page), "templates-copied")
    return pages.join(copied, page, "left_anti").unionByName(
        pages.join(copied, page, "left_semi").groupBy(page).agg(F.first("html").alias("html")).select(pages.columns))


def host_templates(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per host: the token of the container of the main text, the tokens of template text, and those on every page."""
    tokens = stored(spark, _summed(
        _distinct(spark, pages).select("host", "html", "page").mapInArrow(_tokens, TOKENS), "host"), "templates")
    sizes = tokens.where(F.col("token") == ROOT).select("host", F.col("pages").alias("size"))
    group = F.when(F.col("size") < MIN_PAGES, F.lit("")).otherwise(F.concat(F.lit("host "), F.col("host")))
    hosts = sizes.select("host", group.alias("of"))
    pooled = stored(spark, _summed(tokens.join(hosts, "host"), "of"), "templates-pooled")
    # Classes: tokens with one vector; valid ones are large enough and on enough pages of the group.
    whole = pooled.where(F.col("token") == ROOT).select("of", F.col("pages").alias("size"))
    vector = ["of", "low", "high"]
    classes = pooled.groupBy(vector).agg((F.count("*") >= MIN_CLASS).alias("valid"), F.max("pages").alias("on"))
    frequent = classes.join(whole, "of").where(F.col("on") >= F.lit(MIN_SHARE) * F.col("size"))
    deduced = pooled.join(frequent, vector).select(
        "of", "token", "rank", "pages", "chars", "up", "size", "valid",
    ).groupBy("of").applyInArrow(_deduced, "of string, main bigint, known array<bigint>, fixed array<bigint>")
    return stored(spark, hosts.join(deduced, "of", "left").select("host", "main", "known", "fixed"), "templates-hosts")


def main_blocks(
    page: str | None, main: int | None, known: frozenset[int], fixed: frozenset[int] = frozenset(),
) -> list[str]:
    """Blocks of the main text: of the main container, or of the page's own best element, or else all slots."""
    containers, blocks = parse(page)
    usable = [k for k, c in enumerate(containers) if not c.dropped]
    chosen = {k for k in usable if main is not None and _token("<", containers[k].path) == main}
    unnamed = all(containers[k].rank == PLAIN for k in chosen)
    if unnamed:
        best = max((containers[k].rank for k in usable), default=PLAIN)
        if best >= MAIN:
            chosen, unnamed = {k for k in usable if containers[k].rank == best}, False
    within = held(containers, chosen)
    if not unnamed:
        return [b.text for b in blocks if not b.dropped and b.inside >= 0 and within[b.inside]]
    if chosen:
        inner = [b for b in blocks if b.inside >= 0 and within[b.inside]]
        if any(not b.dropped and _token("text", b.path, b.text) not in known for b in inner):
            blocks = inner
    usable = [(b, _token("text", b.path, b.text)) for b in blocks if not b.dropped or b.owner >= 0]
    # Template text that would take all slot text is not template there.
    template = known if any(token not in known and not b.dropped for b, token in usable) else fixed
    bare = all(token in template or b.dropped for b, token in usable)
    sizes: dict[int, int] = {}
    for b, token in usable:
        if token not in template:
            sizes[b.owner] = sizes.get(b.owner, 0) + len(b.text)
    # A name alone does not drop what holds most of the text.
    kept = {-1, *(k for k, size in sizes.items() if 2 * size > sum(sizes.values()))}
    return [b.text for b, token in usable if b.owner in kept and (token not in template or bare and not b.dropped)]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        known_of: dict[str, tuple[frozenset[int], frozenset[int]]] = {}
        for page, host, main, known, fixed in zip(
            batch.column("html"), batch.column("host").to_pylist(), batch.column("main").to_pylist(),
            batch.column("known"), batch.column("fixed"), strict=True,
        ):
            if host not in known_of:
                known_of[host] = frozenset(known.as_py() or ()), frozenset(fixed.as_py() or ())
            texts.append("\n".join(main_blocks(page.as_py(), main, *known_of[host])))
        yield pa.RecordBatch.from_arrays([
            batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64()),
        ], ["page_id", "url", "text", "n_chars"])


def host_of(url):
    """Host of a URL in lower case, empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def main_texts(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per page: ``page_id``, ``url``, ``text`` and ``n_chars``."""
    named = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    templates = host_templates(spark, named)
    return named.join(templates, "host", "left").select(
        "page_id", "url", "html", "host", "main", "known", "fixed").mapInArrow(
        _extract, "page_id bigint, url string, text string, n_chars bigint")
