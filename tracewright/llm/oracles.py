"""DuckDB SQL of the queries that SQL expresses over whole tables.

The others cannot be told in SQL: fingerprints need seeded XXH64 (1), span classifier, rule engine and models are trained or
procedural (2, 3, 4, 8, 9, 10), token lengths need a tokenizer (6). Their tests use brute force and held-out rows.
"""

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

OP7 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS win
 FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win FROM d, lengths, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS p)),
hit AS (SELECT dw.doc_id, dw.p, dw.n, bw.item_id FROM dw JOIN bw USING (n, win)),
pos AS (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS i FROM (SELECT DISTINCT doc_id, p, n FROM hit)),
nh AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN nh USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


def _fill(k: int, before: str, gap: str) -> str:
    """One round of filling: documents that fit the gap, in seeded order, as long as their running sum does."""
    return f""",
r{k} AS (SELECT x.*, g.gap, x.size <= g.gap AS fits, sum(CASE WHEN x.size <= g.gap THEN x.size ELSE 0 END) OVER (PARTITION BY x.source ORDER BY h, doc_id NULLS FIRST, x.size ROWS UNBOUNDED PRECEDING) AS run
 FROM {before} x JOIN {gap} g ON x.source IS NOT DISTINCT FROM g.source),
t{k} AS (SELECT *, fits AND run <= gap AS taken_now FROM r{k}),
l{k} AS (SELECT doc_id, source, size, h FROM t{k} WHERE NOT taken_now),
g{k} AS (SELECT g.source, g.gap - coalesce(sum(t.size), 0) AS gap FROM {gap} g LEFT JOIN t{k} t ON t.taken_now AND t.source IS NOT DISTINCT FROM g.source GROUP BY g.source, g.gap)"""


OP5 = (
    r"""
WITH docs AS (SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) END AS size, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight, CAST(source_size AS DOUBLE) * 3 AS cap FROM s),
f AS (SELECT *, row_number() OVER o AS k, ((SELECT CAST(sum(source_size) AS DOUBLE) FROM s) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
 FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
lv AS (SELECT arg_min(level, k) AS level FROM f WHERE level * weight <= cap),
p AS (SELECT source, source_size, CASE WHEN lv.level IS NULL THEN cap ELSE least(cap, lv.level * weight) END AS target FROM f, lv),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM p),
g0 AS (SELECT source, target - whole * source_size AS gap FROM plan)"""
    + _fill(1, "docs", "g0")
    + _fill(2, "l1", "g1")
    + _fill(3, "l2", "g2")
    + _fill(4, "l3", "g3")
    + """,
picked AS (SELECT doc_id, source, size, 1 AS once FROM (SELECT doc_id, source, size FROM t1 WHERE taken_now UNION ALL SELECT doc_id, source, size FROM t2 WHERE taken_now UNION ALL SELECT doc_id, source, size FROM t3 WHERE taken_now UNION ALL SELECT doc_id, source, size FROM t4 WHERE taken_now)
 UNION ALL SELECT doc_id, source, size, 0 FROM l4)
SELECT doc_id, size, source_size, target, least(whole + once, 3) AS repetitions, least(whole + once, 3) * size AS taken FROM picked x JOIN plan ON x.source IS NOT DISTINCT FROM plan.source
"""
)

ORACLES: dict[str, str] = {"op5_mixing": OP5, "op7_decontamination": OP7}
