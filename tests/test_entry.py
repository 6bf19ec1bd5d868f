"""The driver's contract: names fit, the SQL agrees on the smallest tables where they are there."""

import os

import pytest

import __spark_entry__ as entry
from fjordfacts.plans import cases

SF = "/root/testdata/sf0.001"


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {f"p{n}_found" for n in (2, 3, 4, 6)} <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", ["p3_found", "p6_found", "f1_all_fields", "f8_setup", "h1_manifest", "j2_summary", "k6_field_rates", "k13_statement_flow", *cases.QUERIES])
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    got = entry.queries()[name](spark, SF)
    cols = sorted(got.columns)
    con_rows = con.execute(f"select {', '.join(cols)} from ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(repr, con_rows))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_queries_on_empty_tables(spark, tmp_path):
    for f in os.listdir(SF):
        spark.read.parquet(f"{SF}/{f}").limit(0).write.parquet(f"{tmp_path}/{f}")
    for name, query in entry.queries().items():
        if name not in cases.QUERIES:
            assert query(spark, str(tmp_path)).count() >= 0, name
