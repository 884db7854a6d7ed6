"""Every query against its SQL on the smallest tables, and the driver contract."""

import duckdb
import pytest

import __spark_entry__
from ledgerloom.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# The queries of ``ledgerloom.llm`` have their own tests.
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: round(v, 5) if isinstance(v, float) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    found = df.collect()
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, found) == rows(names, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(__spark_entry__.queries())


def test_whole_feeds_and_pages(spark, duck):
    """No entry of a long feed file is left out, and every capped row has its whole form."""
    customers = duck.execute("SELECT count(*) FROM customer").fetchone()[0]
    assert QUERIES["s13_feed_announcements_whole"](spark, FOLDER).count() == customers
    assert QUERIES["s13_feed_announcements"](spark, FOLDER).count() < customers
    for name in (
        "s10_p11_announcements s11_announcements s12_announcements u1_union_sources "
        "q1_w3_unique_announcements q1_collection_job"
    ).split():
        assert "least(" in ORACLES[name] and "least(" not in ORACLES[f"{name}_whole"]


def test_eda_job_is_whole(spark):
    """Every frame of the job is in the query, and every domain of the small table."""
    frames = "rows parse_rate date_range formats per_date per_hour fields title_lengths summary_lengths categories"
    frames += " samples sources authors domains completeness"
    found = QUERIES["q2_announcement_eda_job"](spark, FOLDER).collect()
    assert {r.stat for r in found} == set(frames.split())
    assert sum(r.stat == "domains" for r in found) > 1


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and df.schema == __spark_entry__.entry(spark).schema


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_scanned(spark):
    text = plan(QUERIES["f8_link_domains"](spark, FOLDER))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in text
    text = plan(QUERIES["f5_previews"](spark, FOLDER))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


@pytest.mark.parametrize("name", ["s10_p11_announcements", "f3_extract_ticker", "p2_optional_columns"])
def test_row_wise_work_needs_no_hash_shuffle(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "hashpartitioning" not in text and "Python" not in text
