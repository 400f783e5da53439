"""The queries of this subpackage over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabwright.llm import (
    decontaminate, html_text, language, licenses, mix, negatives, pii, quality, secrets, simhash, topk, toxicity,
    trie)
from tabwright.sources.tables import parquet

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {
    "op1_secrets": lambda spark, folder: secrets.secret_report(parquet(spark, folder, "documents")),
    "op2_pii": lambda spark, folder: pii.pii_report(parquet(spark, folder, "documents")),
    "op3_simhash": lambda spark, folder: simhash.group_report(parquet(spark, folder, "documents")),
    "op4_topk": lambda spark, folder: topk.search(parquet(spark, folder, "embeddings")),
    "op5_quality": lambda spark, folder: quality.quality_report(
        parquet(spark, folder, "documents"), parquet(spark, folder, "labels")),
    "op6_licenses": lambda spark, folder: licenses.license_report(parquet(spark, folder, "documents")),
    "op7_decontaminate": lambda spark, folder: decontaminate.contamination_report(
        parquet(spark, folder, "documents"), parquet(spark, folder, "benchmark")),
    "op8_html": lambda spark, folder: html_text.html_report(parquet(spark, folder, "pages")),
    "op9_toxicity": lambda spark, folder: toxicity.toxicity_report(
        parquet(spark, folder, "documents"), parquet(spark, folder, "labels")),
    "op10_mix": lambda spark, folder: mix.mix_report(parquet(spark, folder, "documents")),
    "op11_trie": lambda spark, folder: trie.trie_report(parquet(spark, folder, "conversations")),
    "op12_language": lambda spark, folder: language.language_report(parquet(spark, folder, "documents")),
    "op13_negatives": lambda spark, folder: negatives.negatives_report(parquet(spark, folder, "embeddings")),
}


def _secrets_sql() -> str:
    """Matches and the gaps between them give the positions."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rules = ",\n".join(f"({i}, {quoted(r.kind)}, {quoted(r.pattern)}, {r.least})" for i, r in enumerate(secrets.RULES))
    kinds = " ".join(
        f"WHEN {i} THEN [regexp_extract_all(text, {quoted(r.pattern)}, 0), string_split_regex(text, {quoted(r.pattern)}), "
        f"regexp_extract_all(text, {quoted(r.pattern)}, {r.group})]" for i, r in enumerate(secrets.RULES))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
rules(place, kind, pattern, least) AS (VALUES {rules}),
f AS (SELECT r, place, kind, least, CASE place {kinds} END AS found FROM d, rules),
m AS (SELECT r, place, kind, least, unnest(range(1, len(found[1]) + 1)) AS i, found FROM f),
p AS (SELECT r, place, kind, least, i, length(found[1][i]) AS size, length(found[3][i]) AS value,
  CAST(list_sum(list_transform(found[2][1:i], lambda x: length(x))) AS BIGINT)
   + coalesce(CAST(list_sum(list_transform(found[1][1:i-1], lambda x: length(x))) AS BIGINT), 0) AS pos FROM m),
s AS (SELECT r, place, kind, pos, kind || ':' || pos || ':' || (pos + size) AS span FROM p WHERE value >= least),
g AS (SELECT r, count(*) FILTER (place = 0) AS a, count(*) FILTER (place = 1) AS b, count(*) FILTER (place = 2) AS c,
  string_agg(span, ',' ORDER BY pos, place) FILTER (place < 3) AS base, string_agg(span, ',' ORDER BY pos, place) AS spans FROM s GROUP BY r)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(b, 0) AS BIGINT) AS n_access,
  CAST(coalesce(c, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)"""


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {
    "op1_secrets": _secrets_sql(),
    "op4_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5""",
    "op7_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
b AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS.format('text')} AS w FROM benchmark),
k AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
items AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM k)),
seen AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM items))),
hits AS (SELECT r, i, seen.n, item FROM seen JOIN items USING (n, win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN named USING (r)""",
    "op11_trie": """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
  list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(conv_id AS VARCHAR)[i]) AS BIGINT))),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
   lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 6 AS h FROM t GROUP BY conv_id),
g AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS g FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (SELECT g.conv_id, place AS depth, role, text FROM g JOIN t ON t.conv_id = g.base AND place <= g
  UNION ALL SELECT g.conv_id, place - h + g, role, text FROM g JOIN t ON t.conv_id = g.conv_id AND place > h),
p AS (SELECT conv_id, depth, length(text) AS size, string_agg(sha256(sha256(role) || text), '' ORDER BY depth)
   OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
e AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
nodes AS (SELECT key, min(p.conv_id) AS conv_id, max(p.depth) AS depth, max(size) AS size, count(*) AS n_convs,
  sha256(coalesce(string_agg(e.conv_id, ',' ORDER BY e.conv_id), '')) AS ends_sha256
  FROM p LEFT JOIN e ON e.conv_id = p.conv_id AND e.depth = p.depth GROUP BY key),
up AS (SELECT DISTINCT b.key, a.key AS above, b.depth - a.depth AS far FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
kids AS (SELECT above AS key, count(*) AS n FROM up WHERE far = 1 GROUP BY above),
sums AS (SELECT above AS key, count(*) FILTER (kids.key IS NULL) AS n_leaves, sum((n_convs - 1) * size) AS saved
  FROM up JOIN nodes ON nodes.key = up.key LEFT JOIN kids ON kids.key = up.key GROUP BY above)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children,
  n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums ON sums.key = n.key LEFT JOIN kids ON kids.key = n.key
LEFT JOIN up ON up.key = n.key AND far = 1 LEFT JOIN nodes q ON q.key = up.above""",
    "op13_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE vec_id IS NOT NULL
  AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10""",
}
