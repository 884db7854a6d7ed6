"""The jobs a user runs, composed from the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions import dates, text as T
from ledgerloom.operators import clean, dedup, extract, lookup, manifest, profile, relations
from ledgerloom.session import materialize
from ledgerloom.sinks import writers
from ledgerloom.sources import listing, records, tables


@dataclass
class Collection:
    """What a collection run leaves behind."""

    path: str
    counts: DataFrame
    records: DataFrame
    by_source: DataFrame
    by_type: DataFrame
    top_companies: DataFrame
    sample: DataFrame


def collect_announcements(
    pages: Mapping[str, DataFrame],
    out_dir: str,
    feed: DataFrame | None = None,
    sources: Sequence[str] = ("all",),
    limit: int | None = None,
    threshold: float = 0.7,
    scraped_at: Column | None = None,
) -> Collection:
    """Landed pages and feed entries to near-duplicate-free announcement files and a summary."""
    branches = {
        key: extract.announcements_from_pages(df, extract.PAGE_SOURCES[key], limit, scraped_at=scraped_at)
        for key, df in pages.items()
    }
    if feed is not None:
        branches["yahoo"] = extract.announcements_from_feed(feed, scraped_at)
    # Written once: the time stamps in it must be the same for every later reader.
    found = materialize(extract.collect_sources(branches, sources), "announcements")
    status = materialize(dedup.duplicate_status(found, threshold), "status")
    unique = status.where("kept").drop("kept")
    path = writers.write_announcements(unique.drop("ord"), out_dir)
    company = profile.frequencies(
        unique.where(T.non_empty(F.col("company_name"))), F.col("company_name"), "company_name"
    )
    preview = F.concat(
        T.preview(F.col("title"), 80, always=True),
        F.when(F.col("ticker") != "", F.concat(F.lit(" ("), "ticker", F.lit(")"))).otherwise(""),
    )
    return Collection(
        path=path,
        counts=dedup.dedup_counts(status),
        records=unique,
        by_source=profile.frequencies(unique, F.col("source"), "source").orderBy(F.desc("n"), "source"),
        by_type=profile.frequencies(unique, F.col("rns_type"), "rns_type").orderBy(
            F.desc("n"), "rns_type"
        ),
        top_companies=profile.top(company, 10),
        sample=unique.orderBy("ord").limit(5).select("rns_type", preview.alias("preview")),
    )


def announcement_measures(
    df: DataFrame, formats: Sequence[str] = dates.DEFAULT_FORMATS, measured: Sequence[str] = ()
) -> DataFrame:
    """What ``announcement_eda`` counts of every record: dates, lengths, beginnings of texts, and the
    values of its frequency tables, never whole titles or summaries. Row by row.

    Fields named in ``measured`` come with their ``profile.field_measures`` instead of their text, so
    that a caller can measure long texts before a join and need not shuffle them.
    """
    others = [f for f in profile.PROFILE_FIELDS if f not in measured]
    return df.withColumn("_p", dates.parse_published(F.col("published"), formats)).select(
        "ord",
        F.col("_p.ts").alias("ts"),
        F.col("_p.fmt").alias("fmt"),
        *[F.substring(c, 1, 1).alias(c) for c in ("title", "published", "link")],
        *("category", "source", "author"),
        T.link_domain(F.col("link")).alias("domain"),
        *profile.field_measures(others),
        *[f"_{m}_{f}" for f in measured for m in ("len", "cut")],
    )


def announcement_eda(
    df: DataFrame,
    samples: int = 5,
    formats: Sequence[str] = dates.DEFAULT_FORMATS,
    measures: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All statistics of an announcement corpus, one DataFrame each.

    What is staged is narrow, see ``announcement_measures``; ``measures`` is that table of the same
    records, with the same ``ord``, where the caller has it. All frequency tables and length
    histograms come from one pass over it. ``samples`` alone reads the records again, for its few
    rows.
    """
    placed = df if "ord" in df.columns else df.withColumn("ord", F.monotonically_increasing_id())
    stamp, order = F.col("ts"), F.col("ord")
    staged = announcement_measures(placed, formats) if measures is None else measures
    staged = materialize(staged, "eda")
    first = placed
    if "ord" in df.columns:
        # A literal list of the few numbers reaches the scan below any join that made the records.
        few = [r.ord for r in staged.orderBy("ord").limit(samples).select("ord").collect()]
        first = placed.where(F.col("ord").isin(few))
    values = {
        "formats": F.col("fmt"),
        "per_date": F.to_date(stamp),
        "per_hour": F.hour(stamp),
        "title_lengths": F.col("_len_title"),
        "summary_lengths": F.col("_len_summary"),
        "categories": F.coalesce("category", F.lit("Unknown")),
        "sources": F.coalesce("source", F.lit("unknown")),
        "authors": F.coalesce("author", F.lit("unknown")),
        "domains": F.col("domain"),
    }
    counts = materialize(profile.value_counts(staged, values, order), "eda-counts")

    def often(stat: str, name: str, k: int = 10) -> DataFrame:
        return profile.most_frequent(profile.counted(counts, stat, name), k)

    def each(stat: str, name: str, kind: str = "string") -> DataFrame:
        return profile.counted(counts, stat, name, kind).drop("first")

    def lengths(stat: str) -> DataFrame:
        return profile.binned(each(stat, "v", "double").withColumnRenamed("n", "c"), 20)

    return {
        "rows": profile.row_count(staged),
        "parse_rate": profile.parse_rate(staged, stamp),
        "date_range": profile.date_range(staged, stamp),
        "formats": often("formats", "fmt", len(formats)),
        "per_date": each("per_date", "date", "date").orderBy("date"),
        "per_hour": each("per_hour", "hour", "int").orderBy("hour"),
        "fields": profile.measured_profile(staged, order=order),
        "title_lengths": lengths("title_lengths"),
        "summary_lengths": lengths("summary_lengths"),
        "categories": often("categories", "category"),
        "samples": sample_records(first, samples),
        "sources": profile.with_share(each("sources", "source")).orderBy(F.desc("n"), "source"),
        "authors": often("authors", "author"),
        "domains": often("domains", "domain"),
        "completeness": profile.completeness(staged),
    }


def sample_records(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` records with a shortened summary."""
    shown = [F.coalesce(c, F.lit("N/A")).alias(c) for c in ("title", "category", "published", "source")]
    return df.orderBy("ord").limit(n).select(
        *shown,
        F.when(T.non_empty(F.col("summary")), T.preview(F.col("summary"), 200)).alias("summary"),
        F.when(T.non_empty(F.col("link")), F.col("link")).alias("link"),
    )


def clean_company_parts(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    shard_size: int = 200_000,
    columns: Sequence[str] | None = None,
    **options,
) -> str:
    """Zipped company parts to cleaned shards, in part order; ``options`` go to the cleaning."""
    raw = tables.read_zip_csv(spark, in_dir, columns, part_column="_part")
    return writers.write_shards(
        clean.clean_companies(raw, **options), out_dir, shard_size, source="_part"
    )


def company_eda(df: DataFrame, date_format: str = "d/M/yyyy") -> dict[str, DataFrame]:
    """Row count, incorporation dates and name lengths, as far as the columns exist."""
    out = {"rows": profile.row_count(df)}
    if "IncorporationDate" in df.columns:
        stamp = dates.parse_date(F.col("IncorporationDate"), date_format)
        out["date_range"] = profile.date_range(df, stamp)
        out["per_date"] = profile.per_date(df, stamp)
    if "CompanyName" in df.columns:
        out["name_lengths"] = profile.histogram(df, F.length("CompanyName"), 50)
    return out


def label_sentences(df: DataFrame, names: Sequence[str], folder: str, config: str) -> DataFrame:
    """Add label names, write the CSV, and return it as read back."""
    named = df.withColumn("sentiment", lookup.label_name(F.col("label"), names))
    writers.write_phrasebank(named, folder, config)
    return tables.read_phrasebank(df.sparkSession, folder, config)


def profile_datasets(spark: SparkSession, base: str) -> DataFrame:
    """One card per folder of ``base``.

    All datasets are scanned together, each row tagged with its folder, so the number of jobs does not
    grow with them: one scan of all CSV records, one of all JSONL lines, two passes over the cells.
    """
    files = materialize(listing.dataset_files(spark, base), "listing")
    sizes = materialize(listing.dataset_sizes(files), "sizes")
    csvs = sizes.where("format = 'csv'").select("dataset")
    dataset = lambda df: df.withColumn("dataset", listing.dataset_of(spark, base, F.col("file")))
    records_of, names = tables.csv_cells(spark, base)
    names = dataset(names).join(csvs, "dataset", "left_semi")
    cells = materialize(records_of.join(names, "file"), "cells")
    lines = records.jsonl_lines(spark, base)
    jsonl = dataset(lines).groupBy("dataset").agg(F.count("*").alias("num_rows"))
    jsonl = jsonl.join(sizes.where("format = 'jsonl'").select("dataset"), "dataset", "left_semi")
    rows = cells.groupBy("dataset").agg(F.count("*").alias("num_rows")).unionByName(jsonl)
    # Columns in order of first appearance, by file and place.
    placed = names.select("dataset", "file", F.posexplode("names").alias("pos", "column"))
    placed = placed.groupBy("dataset", "column").agg(F.min(F.struct("file", "pos")).alias("at"))
    placed = placed.groupBy("dataset").agg(F.sort_array(F.collect_list(F.struct("at", "column"))).alias("all"))
    columns = placed.select("dataset", F.transform("all", lambda c: c["column"]).alias("columns"))
    own = F.arrays_zip(F.col("names").alias("column"), F.slice("values", F.lit(1), F.size("names")).alias("value"))
    tagged = cells.select("dataset", F.inline(own).alias("column", "value"))
    labels = profile.tagged_label_distributions(tagged)
    return profile.dataset_cards(sizes, base, rows, columns, labels)


# The three configs of the policy dataset.
POLICY_CONFIGS = ("5768", "78516", "944601")


def policy_splits(configs: Mapping[str, Mapping[str, DataFrame]], out_dir: str) -> DataFrame:
    """Union the configs per split, write one directory per split, and count what was written."""
    writers.write_splits(lookup.union_splits(configs), out_dir)
    spark = next(iter(next(iter(configs.values())).values())).sparkSession
    return lookup.rows_per_split(tables.read_split(spark, out_dir))


def snapshot_report(pages: DataFrame, landed: DataFrame) -> dict[str, DataFrame]:
    """The announced parts, those missing, and the totals."""
    parts = manifest.snapshot_manifest(pages)
    return {
        "manifest": parts,
        "missing": manifest.missing_parts(parts, landed),
        "totals": manifest.completeness(parts, landed),
    }


load_relations = relations.load_relations
