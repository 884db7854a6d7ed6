"""Quality by a regularised quadratic discriminant over document statistics.

1.  Every whole text becomes one vector of transformed statistics (lengths, shares of character
    kinds, repetition), computed over Arrow batches and written to the shared folder.
2.  All labelled training vectors give class counts, sums and products, added up per task and then
    by Spark, so the fit has no sample and the driver gets a few hundred numbers.
3.  Class covariances shrink towards the pooled one, and that towards its mean variance. Their
    Cholesky factors are inverted once and travel with the scoring tasks; a score is the logistic
    function of the difference of the Mahalanobis log densities.

Defined results: null and empty texts are scored like any text, by their statistics. Rows whose id
is null are never training rows. Labels other than 0 and 1 are ignored; repeated labels count each
time. With training rows of one class only, every score is that class; with none, 1 (nothing is
known against any text). Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.words import TO_LOWER, Hasher, Piece, pieces, word_bounds
from ledgerloom.session import materialize

SHRINK_TO_POOLED = 0.2
SHRINK_TO_SPHERE = 0.02
KEEP_SCORE = 0.7
_EPS = 1e-3
_STEADY = 8


def _kinds() -> list[np.ndarray]:
    def table(of: bytes) -> np.ndarray:
        t = np.zeros(256, bool)
        t[list(of)] = True
        return t

    upper = table(bytes(range(65, 91)))
    lower = table(bytes(range(97, 123)))
    digit = table(bytes(range(48, 58)))
    high = table(bytes(range(128, 256)))
    stops = table(b".,;:'\"()-")
    white = table(b" \t\n\v\f\r")
    line = table(b"\n")
    rest = ~(upper | lower | digit | high | stops | white)
    return [upper, lower, digit, high, stops, white, line, rest]


def _logit(x: np.ndarray) -> np.ndarray:
    x = np.clip(x, 0, 1)
    return np.log((x + _EPS) / (1 - x + _EPS))


def statistics(piece: Piece, hasher: Hasher, kinds: list[np.ndarray]) -> np.ndarray:
    """One row of transformed statistics per text of the piece."""
    data, offsets = piece.data, piece.offsets
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)

    def per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return np.diff(sums[at]).astype(float)

    upper, lower, digit, high, stops, white, line, rest = (per_text(k[data], offsets) for k in kinds)
    starts, ends, first = word_bounds(data, offsets)
    words = np.diff(first).astype(float)
    of_text = np.repeat(np.arange(n), np.diff(first))
    hashes = hasher.ranges(TO_LOWER[data], starts, ends)
    same_text = of_text[1:] == of_text[:-1]
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & same_text
    symbol_end = kinds[7][data[ends - 1]] if len(ends) else np.zeros(0, bool)
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum((kinds[0] | kinds[1] | kinds[3])[data], out=letters[1:])
    wordless = (letters[ends] - letters[starts]) == 0
    lengths = (ends - starts).astype(float)
    distinct, most, pairs = np.zeros(n), np.zeros(n), np.zeros(n)
    two = hasher.windows(hashes, 2)
    for i, (low, high_) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if high_ > low:
            own = np.sort(hashes[low:high_])
            change = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
            distinct[i], most[i] = len(change) - 1, np.diff(change).max()
        if high_ > low + 1:
            pairs[i] = len(np.unique(two[low : high_ - 1]))
    some = np.maximum(words, 1)
    steady = words + _STEADY  # a few words alone make no extreme share
    signs = np.maximum(size - white, 1)
    mean = per_sum(lengths, first) / some
    spread = np.sqrt(np.maximum(per_sum(lengths**2, first) / some - mean**2, 0))
    return np.column_stack(
        [
            np.log1p(words),
            np.log1p(mean),
            np.log1p(spread),
            _logit(upper / np.maximum(upper + lower, 1)),
            _logit(digit / signs),
            _logit(high / signs),
            _logit(stops / signs),
            _logit(rest / signs),
            _logit(line / some),
            _logit(per_text(again, first) / steady),
            _logit(per_text(symbol_end, first) / steady),
            _logit(per_text(wordless, first) / steady),
            _logit(np.maximum(most - 1, 0) / steady),
            np.log1p(distinct) / np.log1p(some),
            np.log1p(pairs) / np.log1p(np.maximum(some - 1, 1)),
        ]
    )


def per_sum(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[at])


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, x`` per row; ``x`` is the vector of transformed statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, kinds = Hasher(), _kinds()
        for batch in batches:
            for piece in pieces(batch.column(2)):
                x = statistics(piece, hasher, kinds)
                at = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(piece.begin, piece.end - piece.begin) for c in batch.columns[:2]),
                        pa.ListArray.from_arrays(at, x.ravel()),
                    ],
                    ["doc_id", "held_out", "x"],
                )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        held_out(F.col(doc_id)).alias("held_out"),
        F.col(text).cast("string").alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, x array<double>")


def held_out(doc_id: Column) -> Column:
    """Whether a document never takes part in learning: a quarter, by its id alone."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Discriminant:
    """A fitted model. ``None`` factors mean that one class, or both, had no training rows."""

    def __init__(self, moments: dict[int, np.ndarray], pooled: float, sphere: float) -> None:
        d = int(round((len(next(iter(moments.values()))) - 1) ** 0.5 - 0.5)) if moments else 0
        self.constant = 0.0 if set(moments) == {0} else 1.0
        self.parts = None
        if len(moments) < 2:
            return
        counts = {k: m[0] for k, m in moments.items()}
        means = {k: m[1 : d + 1] / m[0] for k, m in moments.items()}
        own = {
            k: m[d + 1 :].reshape(d, d) / m[0] - np.outer(means[k], means[k])
            for k, m in moments.items()
        }
        total = sum(counts.values())
        common = sum(counts[k] * own[k] for k in own) / total
        self.parts = []
        for k in (0, 1):
            cov = (1 - pooled) * own[k] + pooled * common
            cov = (1 - sphere) * cov + (sphere * np.trace(common) / d + 1e-9) * np.eye(d)
            factor = np.linalg.cholesky(cov)
            offset = np.log(counts[k] / total) - np.log(np.diag(factor)).sum()
            self.parts.append((means[k], np.linalg.inv(factor).T, offset))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.parts is None:
            return np.full(len(x), self.constant)
        density = [c - 0.5 * (((x - m) @ f) ** 2).sum(axis=1) for m, f, c in self.parts]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def fit(
    statistics_of: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    label: str = "quality",
    pooled: float = SHRINK_TO_POOLED,
    sphere: float = SHRINK_TO_SPHERE,
) -> Discriminant:
    """Class moments of all labelled rows that are not held out."""
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1))
    rows = statistics_of.where(~F.col("held_out")).join(known, "doc_id").select("label", "x")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            label_of = batch.column(0).to_numpy(zero_copy_only=False)
            if not len(label_of):
                continue
            x = batch.column(1).flatten().to_numpy().reshape(len(label_of), -1)
            for k in np.unique(label_of):
                own = x[label_of == k]
                part = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                sums[int(k)] = sums.get(int(k), 0) + part
        for k, part in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(part)), pa.array(range(len(part))), pa.array(part)],
                ["label", "i", "part"],
            )

    parts = rows.mapInArrow(moments, "label long, i long, part double")
    found = parts.groupBy("label", "i").agg(F.sum("part").alias("part")).collect()
    by_label: dict[int, dict[int, float]] = {}
    for r in found:
        by_label.setdefault(r.label, {})[r.i] = r.part
    arrays = {k: np.array([v[i] for i in range(len(v))]) for k, v in by_label.items()}
    return Discriminant(arrays, pooled, sphere)


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    keep_score: float = KEEP_SCORE,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``."""
    vectors = materialize(document_statistics(docs, doc_id, text), "document-statistics")
    model = fit(vectors, labels, doc_id, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column(2).flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(model.score(x) if n else np.zeros(0))],
                ["doc_id", "held_out", "score"],
            )

    scored = vectors.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= keep_score).cast("int"))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    keep_score: float = KEEP_SCORE,
) -> DataFrame:
    """The rows of ``docs`` that score ``keep_score`` or more, all columns as they were.

    The vectors are computed again where the rows are, so no text is shuffled.
    """
    vectors = materialize(document_statistics(docs, doc_id, text), "document-statistics")
    model = fit(vectors, labels, doc_id, label)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, kinds = Hasher(), _kinds()
        for batch in batches:
            for piece in pieces(batch.column(at).cast(pa.string())):
                good = model.score(statistics(piece, hasher, kinds)) >= keep_score
                yield batch.slice(piece.begin, len(good)).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
