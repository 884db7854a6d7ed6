import os

import pytest

from ledgerloom import session


def test_materialized_tables_live_in_the_configured_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_root", lambda s: str(tmp_path))
    other = tmp_path / "other"
    other.mkdir()
    df = session.materialize(spark.range(5), "numbers")
    assert df.count() == 5 and str(tmp_path) in df.inputFiles()[0]
    assert session.drop_scratch(spark)
    assert os.listdir(tmp_path) == ["other"]


def test_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = session.checkpoint_root(spark)
    assert root == configured.rstrip("/") if configured else os.path.isdir(root)


@pytest.mark.parametrize("master", ["local[8]"])
def test_session_defaults(spark, master):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.sparkContext.master == master
