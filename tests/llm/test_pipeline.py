import hashlib
import re

import pytest

import __spark_entry__
import corpus_pipeline
from ledgerloom.llm.registry import table
from ledgerloom.session import materialize
from tests.llm.test_jaccard_join import brute as components

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = list(__spark_entry__.queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert {"op4_url_filters", "op9_exact_dedup"} <= set(__spark_entry__.oracle_sql())


def test_stages(spark):
    steps, docs = [], table(spark, FOLDER, "documents")
    steps.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = materialize(stage(spark, docs, FOLDER), "stage")
        steps.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before
    raw, good, unique, single, mixed, coded = steps
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    left = {r.doc_id for r in good}
    wrong = [i for i, q in labels.items() if (i in left) != bool(q)]
    assert len(wrong) <= 0.02 * len(labels)
    key = lambda r: re.sub(r"[\x20\x09-\x0D]", "", r.text)
    best = {}
    for r in sorted(good, key=lambda r: (-len(r.text), r.doc_id)):
        best.setdefault(key(r), r.doc_id)
    assert {r.doc_id for r in unique} == set(best.values())
    found = components([(r.doc_id, r.text) for r in unique])
    assert {r.doc_id for r in single} == {c for _, _, c in found}
    total = sum(len(r.text.split()) for r in single)
    assert sum(len(r.text.split()) for r in mixed) == pytest.approx(total, rel=0.05)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((r.doc_id, r.decoded_sha256) for r in coded) == sorted((r.doc_id, digest(r.text)) for r in mixed)
    assert corpus_pipeline.run(spark, FOLDER).count() == len(coded)


def test_stages_take_odd_documents(spark, odd, none):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd.select(columns), none):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, FOLDER), "stage")
        assert docs.columns[0] == "doc_id"
