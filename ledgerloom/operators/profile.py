"""Corpus statistics. Each is one aggregate over the data; follow-up steps see only its result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as TY

from ledgerloom.functions import dates, text as T
from ledgerloom.operators.lookup import ideal_use
from ledgerloom.session import materialize
from ledgerloom.sources.tables import type_checks

PROFILE_FIELDS = ("title", "summary", "category", "author", "source")

# Distinct values a counter map should hold; more are spread over several rows.
MOST_COUNTED = 10_000
SAMPLE_SIZE = 40


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def date_range(df: DataFrame, stamp: Column) -> DataFrame:
    """First and last instant, and the whole days between them."""
    lo, hi = F.min(stamp), F.max(stamp)
    return df.agg(
        lo.alias("first"), hi.alias("last"), dates.whole_days(lo, hi).alias("span_days")
    )


def parse_rate(df: DataFrame, stamp: Column) -> DataFrame:
    """How many rows have a parsed date, of how many."""
    return df.agg(
        F.count(stamp).alias("parsed"),
        F.count("*").alias("total"),
        F.coalesce(F.try_divide(F.count(stamp), F.count("*")), F.lit(0.0)).alias("rate"),
    )


def per_date(df: DataFrame, stamp: Column) -> DataFrame:
    return frequencies(df, F.to_date(stamp), "date").where("date is not null").orderBy("date")


def per_hour(df: DataFrame, stamp: Column) -> DataFrame:
    return frequencies(df, F.hour(stamp), "hour").where("hour is not null").orderBy("hour")


def frequencies(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count("*").alias("n"))


def with_share(counts: DataFrame) -> DataFrame:
    """Add ``pct``, each count's share of all counts."""
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") / total * 100)


def top(counts: DataFrame, k: int = 10, tie: str | Column | None = None) -> DataFrame:
    """The ``k`` largest counts; equal counts by ``tie`` (default: the value)."""
    by = tie if tie is not None else [c for c in counts.columns if c != "n"][0]
    return counts.orderBy(F.desc("n"), by).limit(k)


def most_common(df: DataFrame, value: Column, order: Column, k: int = 10, name: str = "value") -> DataFrame:
    """The ``k`` most frequent values, equal ones in order of first appearance."""
    counted = df.groupBy(value.alias(name)).agg(
        F.count("*").alias("n"), F.min(order).alias("_first")
    )
    return counted.orderBy(F.desc("n"), "_first").limit(k).drop("_first")


def value_counts(df: DataFrame, values: Mapping[str, Column], order: Column) -> DataFrame:
    """``stat, key, n, first``: all values of several columns counted in one pass; ``first`` is the least
    ``order`` of a value. Keys are text, nulls do not count."""
    cells = [F.struct(F.lit(stat).alias("stat"), c.cast("string").alias("key")) for stat, c in values.items()]
    rows = df.select(order.alias("_order"), F.explode(F.array(*cells)).alias("cell"))
    rows = rows.where(F.col("cell.key").isNotNull())
    return rows.groupBy("cell.stat", "cell.key").agg(F.count("*").alias("n"), F.min("_order").alias("first"))


def counted(counts: DataFrame, stat: str, name: str, kind: str = "string") -> DataFrame:
    """One column's values of ``value_counts``: the value, ``n`` and ``first``."""
    return counts.where(F.col("stat") == stat).select(F.col("key").cast(kind).alias(name), "n", "first")


def most_frequent(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` values counted most, equal ones in order of first appearance."""
    return counts.orderBy(F.desc("n"), "first").limit(k).drop("first")


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Equal-width histogram ``bin, lo, hi, n`` over all bins, the last one closed.

    The values alone are staged; one aggregate finds the limits and one fills the bins, so a task
    shuffles a row per bin however many values differ. Bin edges and ties fall as in numpy.
    """
    values = df.select(value.cast("double").alias("v"), F.lit(1).cast("long").alias("c"))
    return binned(materialize(values.where("v is not null"), "values"), bins)


def binned(counted: DataFrame, bins: int) -> DataFrame:
    """The histogram of values ``v`` that occur ``c`` times; ``counted`` is read twice."""
    flat = F.min("v") == F.max("v")
    first = F.when(flat, F.min("v") - 0.5).otherwise(F.min("v")).alias("first")
    last = F.when(flat, F.max("v") + 0.5).otherwise(F.max("v")).alias("last")
    limits = counted.agg(F.struct(first, last)).scalar()
    first, last = F.col("limits.first"), F.col("limits.last")
    step = (last - first) / bins

    def edge(i: Column) -> Column:
        return F.when(i == bins, last).otherwise(i.cast("double") * step + first)

    guess = F.least(
        F.floor((F.col("v") - first) / (last - first) * bins).cast("int"), F.lit(bins - 1)
    )
    at = F.col("guess")
    placed = (
        F.when(F.col("v") < edge(at), at - 1)
        .when((F.col("v") >= edge(at + 1)) & (at != bins - 1), at + 1)
        .otherwise(at)
    )
    filled = (
        counted.withColumn("limits", limits)
        .withColumn("guess", guess)
        .groupBy(placed.alias("bin"))
        .agg(F.sum("c").alias("n"))
    )
    spine = counted.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    spine = spine.withColumn("limits", limits).where(first.isNotNull())
    return spine.join(filled, "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("lo"),
        edge(F.col("bin") + 1).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def field_measures(fields: Sequence[str] = PROFILE_FIELDS) -> list[Column]:
    """What ``field_profile`` needs of long texts: ``_len_<field>``, the length of non-blank values, and
    ``_cut_<field>``, their beginnings."""
    out = []
    for f in fields:
        value = F.col(f).cast("string")
        kept = F.when(T.non_blank(value), value)
        out += [F.length(kept).alias(f"_len_{f}"), F.substring(kept, 1, SAMPLE_SIZE + 1).alias(f"_cut_{f}")]
    return out


def field_profile(
    df: DataFrame, fields: Sequence[str] = PROFILE_FIELDS, order: Column | None = None
) -> DataFrame:
    """Per field: rows, non-blank rows, fill rate, mean length, and with ``order`` the first
    non-blank value cut to 40 characters.

    All fields are aggregated in one pass without multiplying rows; only the one-row result is
    turned into a row per field.
    """
    others = [order.alias("_order")] if order is not None else []
    measured = df.select(*others, *field_measures(fields))
    return measured_profile(measured, fields, F.col("_order") if others else None)


def measured_profile(
    measured: DataFrame, fields: Sequence[str] = PROFILE_FIELDS, order: Column | None = None
) -> DataFrame:
    """``field_profile`` of a table that has the ``field_measures``."""
    aggregates = [F.count("*").alias("_total")]
    for i, f in enumerate(fields):
        length, cut = F.col(f"_len_{f}"), F.col(f"_cut_{f}")
        aggregates += [F.count(length).alias(f"_n{i}"), F.avg(length).alias(f"_a{i}")]
        if order is not None:
            aggregates.append(F.min_by(cut, F.when(cut.isNotNull(), order)).alias(f"_s{i}"))
    one = measured.agg(*aggregates)

    def row(i: int, f: str) -> Column:
        cells = [
            F.lit(f).alias("field"),
            F.col("_total").alias("total"),
            F.col(f"_n{i}").alias("non_empty"),
            F.coalesce(F.try_divide(F.col(f"_n{i}"), F.col("_total")), F.lit(0.0)).alias("fill_rate"),
            F.coalesce(F.col(f"_a{i}"), F.lit(0.0)).alias("avg_length"),
        ]
        if order is not None:
            sample = F.coalesce(T.preview(F.col(f"_s{i}"), SAMPLE_SIZE), F.lit("N/A"))
            cells.append(sample.alias("sample"))
        return F.struct(*cells)

    return one.select(F.inline(F.array(*[row(i, f) for i, f in enumerate(fields)])))


def completeness(df: DataFrame, required: Sequence[str] = ("title", "published", "link")) -> DataFrame:
    """Share of rows with all required fields, share with a category, and the 0.8 gate."""
    whole = T.non_empty(F.col(required[0]))
    for f in required[1:]:
        whole = whole & T.non_empty(F.col(f))
    one = df.agg(
        F.count("*").alias("total"),
        F.count_if(whole).alias("complete"),
        F.count_if(T.non_blank(F.col("category"))).alias("categorized"),
    )

    def share(c: str) -> Column:
        return F.coalesce(F.try_divide(F.col(c), F.col("total")), F.lit(0.0))

    return one.select(
        "total",
        "complete",
        share("complete").alias("completeness"),
        share("categorized").alias("categorization_rate"),
        (share("complete") > 0.8).alias("suitable"),
    )


def counters(df: DataFrame, columns: Mapping[str, str], default: str = "", most: int = MOST_COUNTED) -> DataFrame:
    """``part`` and per name in ``columns`` (name to column) a map of value counts.

    A column of more than ``most`` values is spread over parts by the values' hashes, about that many
    in each; a value stands in one part only. ``counter_values`` reads the maps again.
    """
    values = {name: F.coalesce(F.col(c), F.lit(default)) for name, c in columns.items()}
    counts = materialize(value_counts(df, values, F.lit(0)).drop("first"), "counters")
    sizes = counts.groupBy("stat").agg(F.count("*").alias("m"))
    parts = max(1, -(-(sizes.agg(F.max("m")).first()[0] or 0) // most))
    maps = [
        F.map_from_entries(F.collect_list(F.when(F.col("stat") == name, F.struct("key", "n")))).alias(name)
        for name in columns
    ]
    part = F.pmod(F.xxhash64("key"), F.lit(parts)).alias("part")
    spread = counts.groupBy(part).agg(*maps)
    empty = F.create_map().cast("map<string,bigint>")
    whole = df.sparkSession.range(parts).select(F.col("id").alias("part")).join(spread, "part", "left")
    return whole.select("part", *[F.coalesce(name, empty).alias(name) for name in columns])


def counter(df: DataFrame, column: str, default: str = "", most: int = MOST_COUNTED) -> DataFrame:
    """One column's map of value counts, in as many rows as ``counters`` gives."""
    return counters(df, {column: column}, default, most).drop("part")


def counter_values(maps: DataFrame, name: str) -> DataFrame:
    """``value, n`` of a counter column, whatever the number of its rows."""
    return maps.select(F.explode(name).alias("value", "n"))


def run_metadata(records: DataFrame, scraped_at: str, most: int = MOST_COUNTED) -> DataFrame:
    """The description of a collection run: one row, whose maps have an entry per source and per
    announcement type. Where there are more than ``most`` of these, further rows hold the rest of
    the maps and nothing else.

    Distinct names are counted exactly by grouping, not by holding them in one place.
    """
    company, ticker = F.col("company_name"), F.col("ticker")
    totals = records.agg(
        F.count("*").alias("total_records"),
        F.count_if(T.non_empty(company)).alias("companies_identified"),
        F.count_if(T.non_empty(ticker)).alias("tickers_identified"),
        F.countDistinct(F.when(company != "", company)).alias("unique_companies"),
        F.countDistinct(F.when(ticker != "", ticker)).alias("unique_tickers"),
    )
    totals = totals.select(F.lit(0).cast("long").alias("part"), F.lit(scraped_at).alias("scraped_at"), "*")
    maps = counters(records, {"sources": "source", "rns_types": "rns_type"}, most=most)
    return maps.join(totals, "part", "left").orderBy("part").select(
        "total_records",
        "scraped_at",
        "sources",
        "rns_types",
        "companies_identified",
        "tickers_identified",
        "unique_companies",
        "unique_tickers",
    )


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, TY.StringType)]


def label_distributions(df: DataFrame, max_values: int = 100) -> DataFrame:
    """``column, value, n`` for every text column with 2 to ``max_values - 1`` distinct values.

    A cheap approximate pass discards columns that are far above the limit; the exact gate then
    works on the grouped counts of the rest.
    """
    names = text_columns(df)
    spark = df.sparkSession
    if names:
        guess = df.agg(
            *[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)]
        ).first()
        names = [c for i, c in enumerate(names) if guess[f"c{i}"] <= 2 * max_values]
    if not names:
        return spark.createDataFrame([], "column string, value string, n bigint")
    long = df.select(*[F.col(f"`{c}`").alias(c) for c in names]).unpivot(
        [], [f"`{c}`" for c in names], "column", "value"
    )
    counts = long.where("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
    gate = counts.groupBy("column").agg(F.count("*").alias("_distinct"))
    kept = gate.where((F.col("_distinct") > 1) & (F.col("_distinct") < max_values))
    return counts.join(kept, "column", "left_semi").select("column", "value", "n")


def tagged_label_distributions(cells: DataFrame, max_values: int = 100) -> DataFrame:
    """``dataset, column, value, n``: :func:`label_distributions` of many datasets at once.

    ``cells`` has ``dataset, column, value``, one row per cell. One pass decides per dataset and column
    by mergeable sketches and type tests, a second counts exactly what these leave.
    """
    keys = ["dataset", "column"]
    tests = type_checks(F.col("value"))
    verdict = cells.groupBy(*keys).agg(
        F.approx_count_distinct("value").alias("about"), *[c.alias(kind) for kind, c in tests.items()]
    )
    text = verdict.where(~F.col("l") & ~F.col("d") & ~F.col("b") & (F.col("about") <= 2 * max_values))
    chosen = materialize(text.select(*keys), "label-columns")
    counts = cells.where("value is not null").join(chosen, keys, "left_semi")
    counts = counts.groupBy(*keys, "value").agg(F.count("*").alias("n"))
    counts = materialize(counts, "label-counts")
    gate = counts.groupBy(*keys).agg(F.count("*").alias("_distinct"))
    kept = gate.where((F.col("_distinct") > 1) & (F.col("_distinct") < max_values))
    return counts.join(kept, keys, "left_semi")


def dataset_cards(
    sizes: DataFrame, base: str, rows: DataFrame, columns: DataFrame, labels: DataFrame
) -> DataFrame:
    """One card per row of ``sizes``. ``rows`` (``dataset, num_rows``), ``columns`` (``dataset, columns``) and
    ``labels`` (``dataset, column, value, n``) have what was read; a dataset that was not profiled by
    its format has no entry on the card."""
    maps = labels.groupBy("dataset", "column").agg(
        F.map_from_entries(F.collect_list(F.struct("value", "n"))).alias("counts")
    )
    maps = maps.groupBy("dataset").agg(
        F.map_from_entries(F.collect_list(F.struct("column", "counts"))).alias("label_distributions")
    )
    cards = sizes.join(rows, "dataset", "left").join(columns, "dataset", "left").join(maps, "dataset", "left")
    kind, name = F.col("format"), F.col("dataset")
    return cards.select(
        name.alias("name"),
        F.concat(F.lit(base.rstrip("/") + "/"), name).alias("path"),
        "size_bytes",
        F.when(kind.isin("csv", "jsonl"), F.coalesce("num_rows", F.lit(0))).cast("long").alias("num_rows"),
        F.when(kind == "csv", F.coalesce("columns", F.array().cast("array<string>"))).alias("columns"),
        F.when(kind == "csv", F.col("label_distributions")).alias("label_distributions"),
        F.when(kind == "jsonl", "jsonl").alias("format"),
        "files",
        ideal_use(name).alias("ideal_use"),
    )
