"""Company-register cleaning: date range, name length, constant columns. All narrow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import dates


def in_date_range(
    df: DataFrame,
    column: str = "IncorporationDate",
    min_date: str = "1900-01-01",
    as_of: Column | str | None = None,
    date_format: str = "d/M/yyyy",
) -> DataFrame:
    """Keep rows with ``min_date <= date <= as_of``, add ``date`` as ISO text.

    Unparseable dates go; without the column every row stays and ``date`` is null.
    """
    if column not in df.columns:
        return df.withColumn("date", F.lit(None).cast("string"))
    upper = dates.today() if as_of is None else as_of
    upper = F.lit(upper).cast("timestamp") if isinstance(upper, str) else upper
    lower = F.lit(min_date).cast("timestamp")
    # Tested inside an array of one: a filter on the parsed column would parse every date twice.
    parsed = F.array(dates.parse_date(F.col(column), date_format))
    fitting = F.filter(parsed, lambda d: d.between(lower, upper))
    kept = df.select("*", F.explode(fitting).alias("_date"))
    return kept.withColumn("date", dates.iso_date(F.col("_date"))).drop("_date")


def in_length_range(
    df: DataFrame, column: str = "CompanyName", max_len: int = 80, null_name: str | None = "nan"
) -> DataFrame:
    """Keep rows whose text has 1 to ``max_len`` characters.

    A missing text becomes ``null_name`` and stays; with ``None`` it is dropped.
    """
    if column not in df.columns:
        return df
    if null_name is not None:
        df = df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit(null_name)))
    return df.where(F.length(column).between(1, max_len))


def clean_companies(
    df: DataFrame,
    *,
    max_name_len: int = 80,
    min_date: str = "1900-01-01",
    as_of: Column | str | None = None,
    date_format: str = "d/M/yyyy",
    null_name: str | None = "nan",
) -> DataFrame:
    """Date range, then name length, then the constant ``source``."""
    dated = in_date_range(df, "IncorporationDate", min_date, as_of, date_format)
    named = in_length_range(dated, "CompanyName", max_name_len, null_name)
    return named.withColumn("source", F.lit("ch"))
