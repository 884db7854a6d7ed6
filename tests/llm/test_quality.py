import zlib

import duckdb
import numpy as np

from ledgerloom.llm import quality as op
from ledgerloom.llm.registry import table
from tests.llm.conftest import ODD

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    scored = op.score_documents(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{FOLDER}/labels.parquet'").df()
    assert len(scored) == 10_000 and scored.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(scored.doc_id, scored.held_out))
    assert ((scored.score >= 0.7) == scored.predicted).all()
    tested = scored[scored.held_out].merge(labels, on="doc_id")
    assert (tested.predicted == tested.quality).mean() > 0.98


def test_density_ratio_equals_the_formula():
    rng = np.random.default_rng(4)
    x = {0: rng.normal(size=(300, 3)) * [1, 2, 3], 1: rng.normal(size=(500, 3)) + 1}
    moments = {k: np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()]) for k, v in x.items()}
    model = op.Discriminant(moments, 0.2, 0.02)
    own = {k: np.cov(v.T, bias=True) for k, v in x.items()}
    common = (300 * own[0] + 500 * own[1]) / 800
    at = rng.normal(size=(20, 3))
    log = {}
    for k, v in x.items():
        cov = 0.98 * (0.8 * own[k] + 0.2 * common) + (0.02 * np.trace(common) / 3 + 1e-9) * np.eye(3)
        d = at - v.mean(0)
        log[k] = np.log(len(v) / 800) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)
    assert np.allclose(model.score(at), 1 / (1 + np.exp(log[0] - log[1])))


def test_labels_of_one_class_or_none(spark, odd, labels):
    assert {r.score for r in op.score_documents(odd, labels).collect()} == {1.0}
    for value in (0, 1):
        one = spark.createDataFrame([(4, value, 0), (5, value, 0), (6, None, 0), (7, 9, 0)], labels.schema)
        assert {r.score for r in op.score_documents(odd, one).collect()} == {float(value)}


def test_odd_rows(spark, odd, labels, none):
    known = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 11)] * 2, labels.schema)
    scored = op.score_documents(odd, known).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    kept = op.keep_good(odd, known)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r.predicted for r in scored)
    assert op.score_documents(none, known).count() == op.keep_good(none, known).count() == 0
