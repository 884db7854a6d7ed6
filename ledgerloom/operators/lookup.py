"""Small lookups and unions by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# What each kind of dataset is good for; the last key found in a name decides.
IDEAL_USES: Mapping[str, str] = {
    "ch": "filings timeline & belief edits",
    "rns": "announcement parsing & hallucination tests",
    "boe": "macro time-series grounding",
    "px": "price-based trend edits",
    "revisit_llm": "domain pretraining",
    "investing_strat": "signal backtest & RAG",
    "boe_cls": "stance classification & editing",
    "finnli": "NLI reasoning & contradiction tests",
    "transcripts": "speech→text RAG & memory augment",
}


def ideal_use(name: Column, uses: Mapping[str, str] = IDEAL_USES) -> Column:
    """The use of the last key contained in ``name``, null if none is.

    A chain over the fixed keys, tried from the last: no join is needed.
    """
    return F.coalesce(
        *[F.when(F.contains(name, F.lit(k)), F.lit(v)) for k, v in reversed(list(uses.items()))]
    )


def label_name(label: Column, names: Sequence[str]) -> Column:
    """The name at a 0-based label id; null for an id outside the list."""
    return F.get(F.array(*[F.lit(n) for n in names]), label.cast("int"))


def join_label_names(df: DataFrame, labels: DataFrame, on: str = "label") -> DataFrame:
    """The same from a table of names; Spark broadcasts it only while it is small."""
    return df.join(labels, on, "left")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing in one frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_splits(configs: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """All configs' splits as one table with ``config`` and ``split`` columns."""
    frames = [
        df.withColumn("config", F.lit(config)).withColumn("split", F.lit(split))
        for config, splits in configs.items()
        for split, df in splits.items()
    ]
    return union_all(frames)


def rows_per_split(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))
