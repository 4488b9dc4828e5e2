import random
import time

import pytest

from parlance.llm import templates

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script>
</head><body class="no-sidebar"><header class="top"><h1>Site</h1></header><nav><ul><li><a href="/a">menu</a><li>two</ul></nav>
<div id="cookie-notice">We use cookies</div><main><article><header><h1>Head &amp; line</h1></header>
<p>One <b>bold</b>
 and	more&nbsp;text<p>Second &lt;para&gt;<br>line<ul><li>first<li>second</ul><aside>Side</aside><form>Name <input></form>
<table><tr><td>c1<td>c2</table><!-- comment --><section class="comments"><p>Reader said</p></section>tail</article></main>
<div class="ad">Buy</div><div class="sidebar">Links</div><footer>&copy; x</footer></body></html>"""
TEXT = "Head & line\nOne bold and more text\nSecond <para> line\nfirst\nsecond\nc1\nc2\ntail"


def test_blocks_of_a_page():
    assert "\n".join(templates.main_blocks(PAGE, None, frozenset())) == TEXT


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<article>x <b>y</article> z", "x y"),
    ("<div>a</div><script>b", "a"), ("<article>a<!-- b", "a"), ("<p>a &amp b &am c &#233; &bogus;</p>", "a & b &am c é &bogus;"),
    ("<body><p>a</p></div></section><p>b</p>", "a\nb"), ("<main>m<article class='comment'>c</article></main>n", "m"),
    ('<div title="a > b">x</div>', "x"), ("<p>a < b</p>", "a < b"), ("<![CDATA[a <b]]>", "a <b"),
])
def test_broken_markup(page, text):
    assert "\n".join(templates.main_blocks(page, None, frozenset())) == text


def page(i, body, extra=""):
    return (i, f"http://h.example/{i}", f"<html><body><div class='x1'>Welcome to h</div><div class='x2'>{body}</div>"
                                         f"<div class='x3'>Legal text</div>{extra}</body></html>", "extra")


SCHEMA = "page_id bigint, url string, html string, host string"


def texts(spark, data):
    found = templates.main_texts(spark, spark.createDataFrame(data, SCHEMA))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert len(rows) == len(data) and all(r["n_chars"] == len(r["text"]) for r in rows)
    return {r["page_id"]: r["text"] for r in rows}


def test_template_text_is_left_out_where_no_element_says_article(spark):
    data = [page(i, f"<p>Story {i}</p><p>More {i}</p>") for i in range(6)]
    assert texts(spark, data) == {i: f"Story {i}\nMore {i}" for i in range(6)}


def test_repeated_text_inside_articles_stays(spark):
    data = [(i, "http://same.example/", "<html><body><nav>m</nav><article><h1>Same</h1><p>text</p></article></body></html>", "")
            for i in range(5)]
    assert set(texts(spark, data).values()) == {"Same\ntext"}


def test_main_container_is_deduced_per_host(spark):
    data = [(i, "http://c.example/", f"<html><body><div class='story'><p>Body {i}</p></div><div class='box'><p>Box {i} "
                                     "with more text than the story has</p></div></body></html>", "") for i in range(4)]
    assert texts(spark, data) == {i: f"Body {i}" for i in range(4)}


def test_odd_pages(spark):
    data = [(1, None, None, "a"), (2, "", "", "b"), (None, "http://x/", PAGE, "c"), (3, "not a url", "<p>t</p>", "d"),
            (4, "HTTPS://User@H.example:8080/x", PAGE, "e"), (4, "HTTPS://User@H.example:8080/x", PAGE, "e")]
    found = texts(spark, data)
    assert found[1] == found[2] == "" and found[None] == TEXT and found[4] == TEXT and found[3] == "t"
    assert templates.main_texts(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_hosts(spark):
    urls = ["http://A.b/c", "https://u:p@x.y:80/", "ftp://z", None, "", "nothing", "http://q?x"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(templates.host_of("url").alias("h")).collect()
    assert [r["h"] for r in rows] == ["a.b", "x.y", "z", "", "", "", "q"]


def test_given_pages(spark, small):
    """The given pages have one template; a pattern for it is the brute-force version."""
    import html
    import re

    rows = spark.read.parquet(f"{small}/pages.parquet").collect()
    found = templates.main_texts(spark, spark.read.parquet(f"{small}/pages.parquet")).collect()
    for row in rows:
        article = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]+>", "", part)).split())
                  for part in re.split(r"</?(?:p|h1)>", re.sub("<br>", " ", article)))
        wanted = "\n".join(b for b in blocks if b)
        assert [r["text"] for r in found if r["page_id"] == row["page_id"]] == [wanted]


@pytest.mark.parametrize(("page", "text"), [
    ("<div class='content-sidebar-wrap'><article>a b</article></div>z", "a b"),
    ("<div class='layout has-sidebar'><main>a b</main></div>z", "a b"),
    ("<article class='post ad-free'>a b</article>z", "a b"), ("<section class='social-news'><p>a b</p></section>", "a b"),
    ("<div class='sidebar'><article>a b</article></div>z", "a b"), ("<form><nav>n</nav><main>a b</main></form>z", "a b"),
    ("<main><article class='widget'>a b</article></main>z", "a b"), ("<span class='ad'><main>a b</main></span>z", "a b"),
    ("<article>a b</article><div class='related'><article>other text that is longer</article></div>", "a b"),
    ("<div class='x'>a story that is longer</div><div class='related'><article>c</article></div>",
     "a story that is longer\nc"),
    ("<div class='widget'><nav>n</nav><p>a b c</p></div>z", "a b c\nz"), ("<p>a b c</p><div class='widget'>z</div>", "a b c"),
])
def test_names_do_not_drop_the_main_text(page, text):
    assert "\n".join(templates.main_blocks(page, None, frozenset())) == text


def test_repeated_rows_are_one_page(spark):
    data = [page(i // 2, f"<p>Story {i // 2}</p><p>More {i // 2}</p>") for i in range(12)]
    assert texts(spark, data) == {i: f"Story {i}\nMore {i}" for i in range(6)}


@pytest.mark.parametrize("extra", ["", "<!-- {} -->", "<div class='sidebar'>Number {}</div>"])
def test_text_of_copies_is_not_template(spark, extra):
    data = [page(i, "<p>Same</p><p>text</p><p>here</p>" if i < 4 else f"<p>Story {i}</p><p>More {i}</p>", extra.format(i))
            for i in range(7)]
    assert texts(spark, data) == {
        i: "Same\ntext\nhere" if i < 4 else f"Story {i}\nMore {i}" for i in range(7)}


def test_pages_that_are_all_alike_keep_their_text(spark):
    data = [page(i, "<p>Same</p>", f"<!-- {i} -->") for i in range(4)]
    assert set(texts(spark, data).values()) == {"Welcome to h\nSame\nLegal text"}


@pytest.mark.parametrize(("page", "text"), [
    ('<article><svg width=1 /><p>Hello main text</p></article>', "Hello main text"),
    ("<article><p title=it's>Hello world</p><p>We don't stop</p></article>", "Hello world\nWe don't stop"),
    ("<article><p>Let <math><mi>x</mi></math> be.</p><svg><text>no</text></svg><p data-a = 'a>b' b=\"c>d\">Two</p></article>", "Let x be.\nTwo"),
    ("<article><p a=\"unclosed>One</p><p>Two</p></article>", "One\nTwo"),
    ("<article><p>One</b></i></div> more</p></article>", "One\nmore"),
])
def test_markup_never_takes_text(page, text):
    assert "\n".join(templates.main_blocks(page, None, frozenset())) == text


def test_large_nested_pages_take_linear_time_and_memory():
    depth = 120_000
    page = "<body><article>" + "<div class=a><i>" * depth + "text" + "</x>" * depth + "</div>" * depth + "<p>end</p></article>"
    started = time.process_time()
    containers, blocks = templates.parse(page)
    assert templates.main_blocks(page, None, frozenset()) == ["text", "end"]
    assert time.process_time() - started < 60
    assert len(page) > 3_000_000 and len(containers) == depth + 2
    assert sum(len(c.path) for c in containers) + sum(len(b.path) for b in blocks) <= 17 * (depth + 5)


NAMES = [("<article>", "<div class='k3'>"), ("</article>", "</div>"), ("<nav>", "<div class='k1'>"), ("</nav>", "</div>"),
         ('<div class="ad">', "<div class='k2'>"), ("<footer>", "<div class='k4'>"), ("</footer>", "</div>")]


def test_templates_find_the_text_without_names(spark, small):
    """The given pages, with every element that names its part made a plain one, as pages of one host."""
    given = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "html").collect()
    wanted = {r["page_id"]: r["text"] for r in templates.main_texts(
        spark, spark.read.parquet(f"{small}/pages.parquet")).collect()}
    plain = []
    for r in given:
        html = r["html"]
        for old, new in NAMES:
            html = html.replace(old, new)
        plain.append((r["page_id"], "http://one.example/", html, ""))
    found = texts(spark, plain)
    assert len(found) > 3 and found == wanted
    # Without the templates nothing tells the parts of such a page.
    assert all("\n".join(templates.main_blocks(html, None, frozenset())) != wanted[i] for i, _, html, _ in plain)


def test_slots_decide_before_names_of_classes(spark):
    """A container with nearly all slot text holds the main text, whatever another one is called."""
    data = [(i, "http://s.example/", f"<html><body><div class='k1'>Head</div><div class='k2'><p>Long story {i} of many words "
                                     f"that fill a page</p><ul><li>one {i}<ul><li>inner {i}</li></ul></li></ul><p>Read more</p>"
                                     f"</div><div class='text'>n {i}</div></body></html>", "") for i in range(5)]
    assert texts(spark, data) == {i: f"Long story {i} of many words that fill a page\none {i}\ninner {i}" for i in range(5)}


def test_pages_of_another_template_keep_their_slots(spark):
    """Three in ten pages of a host have other containers; what the host repeats is left out there too."""
    data = [page(i, f"<p>Story {i} of the first kind</p>") for i in range(7)]
    data += [(i, "http://h.example/", "<html><body><div class='x1'>Welcome to h</div><table><tr><td class='y'>"
                                      f"<p>Other {i}</p><p>more {i}</p></td></tr></table></body></html>", "") for i in (7, 8, 9)]
    assert texts(spark, data) == {i: f"Story {i} of the first kind" if i < 7 else f"Other {i}\nmore {i}" for i in range(10)}


def brute_force(pages):
    """Main container and template text of a host, by comparing whole occurrence vectors and rereading every page."""
    parsed = [templates.parse(p) for p in sorted(set(pages))]
    vectors, rank, length = {}, {}, {}
    for k, (containers, blocks) in enumerate(parsed):
        names = [(c.path, None) for c in containers] + [(b.path, b.text) for b in blocks] + [("", None)]
        for name in names:
            vectors.setdefault(name, [0] * len(parsed))[k] += 1
        for c in containers:
            rank[c.path, None] = max(rank.get((c.path, None), -1), -1 if c.dropped else c.rank)
    classes = {}
    for name, vector in vectors.items():
        classes.setdefault(tuple(vector), []).append(name)
    valid = {n for v, names in classes.items() if len(names) >= 3 and 2 * sum(x > 0 for x in v) >= len(parsed) for n in names}
    known = {n for n in valid if n[1] is not None}
    whole, inside, chars = 0, {}, {}
    for containers, blocks in parsed:
        for b in blocks:
            slot = 0 if b.dropped or (b.path, b.text) in known else len(b.text)
            whole += slot
            k, level = b.inside, []
            while k >= 0:
                level.append(containers[k].path)
                k = containers[k].parent
            for depth, path in enumerate(reversed(level)):
                length[path] = depth
                inside[path] = inside.get(path, 0) + slot
                chars[path] = chars.get(path, 0) + (0 if b.dropped else len(b.text))
    inner = {n[0]: set() for n in rank}  # the containers in each one
    for containers, _ in parsed:
        for c in containers:
            k = c.parent
            while k >= 0:
                inner[containers[k].path].add(c.path)
                k = containers[k].parent
    usable = [n[0] for n in valid if n in rank and rank[n] >= 0 and chars.get(n[0], 0) > 0]

    def best(paths):
        order = sorted((rank[p, None], inside[p], chars[p], p) for p in paths if rank[p, None] > 0)
        found = [p for r, i, c, p in order if order[-1][:3] == (r, i, c)]
        return found[0] if len(found) == 1 else "tie" if found else None

    most = [p for p in usable if whole > 0 and inside[p] >= 0.9 * whole]
    main = best(most)
    if main is None:
        last = max(most, key=length.get, default=None)
        others = [n[0] for n in valid if n in rank and last is not None and n[0] != last
                  and n[0] not in inner[last] and last not in inner[n[0]]]
        if others:
            main = best([p for p in usable if p in inner[last] and 2 * inside[p] > whole]) or last
        else:
            main = best(usable)
    return main, {templates._token("text", *n) for n in known}


def test_deduction_equals_brute_force(spark):
    rng = random.Random(8)
    hosts, data = {}, []
    for h in range(24):
        layout = [(rng.choice(["div", "section", "td", "article", "main", "nav"]),
                   rng.choice(["", "content", "k1", "k2", "k3", "story", "sidebar"])) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(3, 9)):
            parts = []
            for tag, name in layout:
                if rng.random() < 0.1:
                    continue
                inner = "".join(f"<{t}>{rng.choice(['Same words', 'Other', f'Text {rng.random()}'])} {'long ' * rng.randint(0, 9)}</{t}>"
                                for t in rng.choices(["p", "li", "div", "h2"], k=rng.randint(1, 3)))
                parts.append(f"<{tag} class='{name}'><div class='in'>Fixed {name}{inner}</div></{tag}>")
            html = f"<html><body>{''.join(parts)}<div>Imprint</div></body></html>"
            hosts.setdefault(f"h{h}.example", []).append(html)
            data.append((len(data), f"http://h{h}.example/", html))
    frame = spark.createDataFrame(data, "page_id bigint, url string, html string").withColumn("host", templates.host_of("url"))
    found = {r["host"]: r for r in templates.host_templates(spark, frame).collect()}
    compared = 0
    for host, pages in hosts.items():
        if len(set(pages)) < templates.MIN_PAGES:
            continue
        main, known = brute_force(pages)
        assert known <= set(found[host]["known"])
        if main != "tie":
            assert found[host]["main"] == (None if main is None else templates._token("<", main))
            compared += main is not None
    assert compared > 10
