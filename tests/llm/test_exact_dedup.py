import hashlib
import re

from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup as op
from tests.llm.conftest import ODD


def brute(rows):
    """Per row (in order): keep_id and size of its class, and the class's text."""
    def key(t):
        return re.sub(r"[\x20\x09-\x0D]", "", t or "")

    classes = {}
    for i, t in rows:
        classes.setdefault(key(t), []).append((i, t or ""))
    out = []
    for i, t in rows:
        own = classes[key(t)]
        best = min(own, key=lambda x: (-len(x[1]), x[0] is None, x[0] or 0))
        out.append((i, best[0], len(own), hashlib.sha256(key(t).encode()).hexdigest()))
    return out


def check(df, rows):
    found = df.collect()
    order = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=order) == sorted(
        brute(rows), key=order
    )
    kept = [(r.text_sha256, r.doc_id) for r in found if r.kept]
    assert len(kept) == len({k for k, _ in kept}) == len({b[3] for b in brute(rows)})
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_odd_rows(odd):
    check(op.mark_duplicates(odd), ODD)


def test_hot_group_and_ties(spark):
    rows = [(i, "a b" if i % 3 else f"c {i}") for i in range(600)] + [(700, "ab"), (701, " a  b ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check(op.mark_duplicates(df), rows)


def test_clashing_digests_compare_content(spark):
    rows = [(i, "abcdef"[i % 6] * (1 + i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    weak = lambda text: F.unhex(F.hex(F.length(text)))
    check(op.mark_duplicates(df, digest=weak), rows)


def test_remove_keeps_columns(odd):
    kept = op.remove_duplicates(odd)
    assert kept.columns == odd.columns
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({b[3] for b in brute(ODD)})


def test_empty(none):
    assert op.mark_duplicates(none).count() == op.remove_duplicates(none).count() == 0


def test_is_native(odd):
    plan = op.mark_duplicates(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
