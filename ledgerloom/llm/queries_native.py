"""Queries of the operators that use DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.llm.exact_dedup import mark_duplicates
from ledgerloom.llm.registry import query, table
from ledgerloom.llm.secret_scan import BASE, names, scan_secrets, span_text
from ledgerloom.llm.url_filter import judge_urls

RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

URL_SQL = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (
  SELECT row_number() OVER () AS n, page_id,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS after
  FROM pages),
parts AS (
  SELECT n, page_id,
    translate(regexp_extract(after, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(after, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM (
  SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY n
      ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM parts LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
WHERE place = 1
"""

EXACT_SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents),
placed AS (
  SELECT doc_id, content,
    first_value(doc_id) OVER w AS keep_id,
    count(*) OVER (PARTITION BY content) AS group_size,
    row_number() OVER w = 1 AS kept
  FROM rows WINDOW w AS (PARTITION BY content ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, kept, sha256(content) AS text_sha256 FROM placed
"""


@query("op4_url_filters", URL_SQL)
def url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge_urls(table(spark, folder, "pages"), rules)


@query("op9_exact_dedup", EXACT_SQL)
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return mark_duplicates(table(spark, folder, "documents"))


@query("op6_secret_scan")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(i).alias(f"n_{name}") for i, name in enumerate(names())],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
