"""URL rules by hash prefixes. DataFrame functions only.

Each URL is expanded into ``host suffix + path prefix`` expressions, only for label counts and path
lengths that some rule has. An expression meets the rules by an equi-join on the first four bytes of
its SHA-256; then the full digest must be equal, and the longest rule of a URL gives the verdict.
The join's form is Spark's choice by the rules' size: nothing is broadcast by hint, and a hot prefix
can be split, as the join's only follow-up is an exchange by row.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no rule. A
path is compared character by character, so ``/en/1`` fits ``/en/12``. Longest means the most
characters of host and path together, then of the host; of equal rules ``block`` wins. Without a
fitting rule the verdict is ``default``. Repeated rows each get their own result.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.session import materialize

PREFIX_BYTES = 4


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    # Hosts hold no "/", so host and path cannot be confused; a rule's path may be empty.
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256))


def rule_table(rules: DataFrame) -> DataFrame:
    """``rule, verdict, digest, short, weight`` from ``host, path, verdict``; one row per rule."""
    host = F.translate(F.col("host"), ascii_uppercase, ascii_lowercase)
    path = F.coalesce(F.col("path"), F.lit(""))
    weight = (F.char_length(host) + F.char_length(path)) * F.lit(1 << 20).cast("long")
    return (
        rules.where(F.col("host").isNotNull() & (F.col("host") != ""))
        .select(
            host.alias("rule_host"),
            path.alias("rule_path"),
            F.concat(host, path).alias("rule"),
            F.col("verdict"),
            _digest(host, path).alias("digest"),
            (weight + F.char_length(host)).alias("weight"),
        )
        .withColumn("short", F.substring("digest", 1, PREFIX_BYTES))
        .groupBy("rule_host", "rule_path", "rule", "digest", "short", "weight")
        .agg(F.max("verdict").alias("verdict"))
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row; ``rules`` has ``host, path, verdict``."""
    table = materialize(rule_table(rules), "url-rules")
    shape = table.agg(
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.collect_set(F.char_length("rule_path")).alias("lengths"),
    ).first()
    labels, lengths = shape.labels or 0, sorted(shape.lengths or [])
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(page_id).alias("page_id"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    if not labels:
        return rows.select(
            "page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
            F.lit(default).alias("verdict"),
        )
    suffixes = F.array_distinct(
        F.array(*[F.substring_index("host", ".", -n) for n in range(1, labels + 1)])
    )
    heads = F.array(
        *[F.when(F.char_length("path") >= n, F.substring("path", 1, n)) for n in lengths]
    )
    expressions = F.flatten(
        F.transform(
            suffixes,
            lambda h: F.transform(F.filter(heads, lambda p: p.isNotNull()), lambda p: _digest(h, p)),
        )
    )
    expanded = rows.withColumn("expression", F.explode_outer(expressions)).withColumn(
        "begin", F.substring("expression", 1, PREFIX_BYTES)
    )
    fits = (F.col("begin") == F.col("short")) & (F.col("expression") == F.col("digest"))
    best = F.max(F.struct("weight", "verdict", "rule"))
    return (
        expanded.join(table.drop("rule_host", "rule_path"), fits, "left")
        .groupBy("row", "page_id", "host", "path")
        .agg(best.alias("best"))
        .select(
            "page_id",
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )
