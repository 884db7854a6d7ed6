"""The operators that SQL can express, against SQL on the small tables."""

import duckdb
import pytest

import __spark_entry__

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op4_url_filters", "op5_ngram_jaccard", "op9_exact_dedup", "op12_prefix_trie"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = __spark_entry__.queries()[name](spark, FOLDER)
    cursor = con.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(map(tuple, cursor.fetchall()), key=repr)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == want
