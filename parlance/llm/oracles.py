"""DuckDB twins of the training-data queries that SQL can express."""

from __future__ import annotations

from parlance.llm import mixing
from parlance.llm.rules import MARKS, MAX_REPEAT_PERCENT, MIN_WORDS, STOP_WORDS, SYMBOLS, rules_sql

ORACLES: dict[str, str] = {}

_SPACE = r"[\x20\x09-\x0D]"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_SPACE}+'), lambda w: w <> '')"


def _count(characters: str) -> str:
    quoted = characters.replace("'", "''")
    return f"(length(t) - length(translate(t, '{quoted}', '')))"


_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

ORACLES["op1_quality_rules"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT r, doc_id, t, {_words('t')} AS words,
         list_filter(string_split(t, chr(10)), lambda l: regexp_replace(l, '{_SPACE}', '', 'g') <> '') AS lines,
         {_words(f"translate(lower(t), '{MARKS}', '')")} AS plain
  FROM d),
w AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM w) WHERE c > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
         CAST({_count(SYMBOLS)} AS BIGINT) AS n_symbols, CAST({_count('!')} AS BIGINT) AS n_shouts,
         CAST({_count('ABCDEFGHIJKLMNOPQRSTUVWXYZ')} AS BIGINT) AS n_capitals,
         CAST(len(list_filter(plain, lambda x: x IN ({_STOP}))) AS BIGINT) AS n_stop_words,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)),
b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND {rules_sql()} AS kept FROM b
"""

# All pairs of different sets with a common shingle, then everything reachable by links.
ORACLES["op3_jaccard_join"] = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, {_words("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(list_slice(ws, i, i + 4), ' ') AS s
  FROM (SELECT r, ws, unnest(CASE WHEN len(ws) >= 5 THEN range(1, len(ws) - 3) WHEN len(ws) > 0 THEN [1] ELSE [] END) AS i FROM d)),
sets AS (SELECT r, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS name FROM shingles GROUP BY r),
nodes AS (SELECT name, min(r) AS r, any_value(n) AS n FROM sets GROUP BY name),
parts AS (SELECT nodes.r, n, s FROM nodes JOIN shingles USING (r)),
links AS (
  SELECT a.r AS a, b.r AS b FROM parts a JOIN parts b ON a.s = b.s AND a.r < b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(r, m) AS (SELECT r, r FROM nodes UNION SELECT edges.b, reach.m FROM reach JOIN edges ON edges.a = reach.r),
smallest AS (SELECT nodes.r, min(doc_id) AS doc_id FROM nodes JOIN sets USING (name) JOIN d ON d.r = sets.r GROUP BY nodes.r),
groups AS (SELECT nodes.name, min(smallest.doc_id) AS component_id
  FROM nodes JOIN reach ON reach.r = nodes.r JOIN smallest ON smallest.r = reach.m GROUP BY nodes.name)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       CASE WHEN n IS NULL THEN d.doc_id ELSE component_id END AS component_id
FROM d LEFT JOIN sets USING (r) LEFT JOIN groups USING (name)
"""

_COIN = f"(CAST('0x' || substr(sha256('{mixing.SEED}' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0)"

# The sharing is done literally: in each round, sources above their bound are
# fixed at it and the rest is shared by weight among the others.
ORACLES["op4_mix_sources"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_COIN} AS coin,
         CAST(coalesce(len(list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda w: w <> '')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
shared(source, source_size, w, target, round) AS (
  SELECT source, source_size, CAST(w AS DOUBLE), CAST(-1 AS DOUBLE), 0 FROM s
  UNION ALL
  SELECT source, source_size, w,
         CASE WHEN target >= 0 THEN target WHEN part >= 2.0 * source_size THEN 2.0 * source_size ELSE -1 END, round + 1
  FROM (
    SELECT *, w * (1.5 * sum(source_size) OVER () - coalesce(sum(target) FILTER (target >= 0) OVER (), 0))
              / nullif(sum(w) FILTER (target < 0) OVER (), 0) AS part
    FROM shared)
  WHERE round <= (SELECT count(*) FROM s)),
last AS (
  SELECT source, source_size, CASE WHEN target >= 0 THEN target ELSE
         w * (1.5 * sum(source_size) OVER () - coalesce(sum(target) FILTER (target >= 0) OVER (), 0))
           / sum(w) FILTER (target < 0) OVER () END AS target
  FROM shared WHERE round = (SELECT count(*) FROM s)),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM last),
ranged AS (
  SELECT d.*, p.source_size, p.target, floor(p.rate) AS whole, p.rate - floor(p.rate) AS fraction,
         length(bin(d.size)) AS class, CAST(floor(d.coin * {mixing.BINS}) AS BIGINT) AS place
  FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
bins AS (
  SELECT source, class, place, count(*) AS n, any_value(fraction) AS fraction FROM ranged GROUP BY source, class, place),
filled AS (
  SELECT *, sum(n) OVER (PARTITION BY source, class) AS of_class,
         sum(n) OVER (PARTITION BY source, class) * fraction AS wanted,
         sum(n) OVER (PARTITION BY source, class ORDER BY place) - n AS below
  FROM bins),
bounds AS (
  SELECT source, class, (place + (wanted - below) / n) / {mixing.BINS}.0 AS bound FROM filled
  WHERE below <= wanted AND (wanted < below + n OR below + n = of_class))
SELECT r.doc_id, r.size, r.source_size, r.target,
       CAST(r.size * (r.whole + CASE WHEN r.coin < b.bound THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ranged r JOIN bounds b ON r.source IS NOT DISTINCT FROM b.source AND r.class = b.class
"""

ORACLES["op7_decontaminate"] = """
WITH norm_items AS (
  SELECT DISTINCT item_id, list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS ws
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
wins AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, list_slice(ws, i, i + least(10, len(ws)) - 1) AS win
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM norm_items WHERE len(ws) > 0)),
d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS ws
  FROM documents),
lengths AS (SELECT DISTINCT n FROM wins),
dw AS (
  SELECT r, n, i, list_slice(ws, i, i + n - 1) AS win
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lengths)),
hits AS (SELECT dw.r, dw.i, dw.n, wins.item_id FROM dw JOIN wins ON dw.n = wins.n AND dw.win = wins.win),
hit_words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

ORACLES["op6_repeated_passages"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, min(r0) OVER (PARTITION BY doc_id, t) AS doc, {_words('t')} AS ws
  FROM (
    SELECT row_number() OVER () AS r0, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
w AS (
  SELECT r, doc, i, md5(array_to_string(list_slice(ws, i, i + 49), ' ')) AS win
  FROM (SELECT r, doc, ws, unnest(range(1, len(ws) - 48)) AS i FROM d)),
twice AS (SELECT win FROM w GROUP BY win HAVING min(doc) <> max(doc)),
found AS (SELECT r, i FROM w JOIN twice USING (win)),
islands AS (
  SELECT r, i, sum(CASE WHEN i > before + 50 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS g
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM found)),
spans AS (SELECT r, min(i) - 1 AS a, max(i) + 49 AS b FROM islands GROUP BY r, g)
SELECT doc_id, CAST(a AS BIGINT) AS start_word, CAST(b AS BIGINT) AS end_word, CAST(len(ws) AS BIGINT) AS doc_words
FROM d JOIN spans USING (r)
"""

ORACLES["op12_ranked_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents),
held AS (SELECT r, doc_id, ws, CAST(len(ws) AS BIGINT) AS n FROM d WHERE len(ws) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM held),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM held) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * docs + 2) / (2.0 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
norms AS (SELECT r, doc_id, 50 + (50 * n * docs) // total AS m FROM held, corpus),
scores AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN norms USING (r)
  GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
