"""The driver contract."""

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ("c4_not_in_keeps_null", "f2_diagnosis_counts", "h3_stratified_folds", "j9_roc_curve", "e12_medians")


def test_keys():
    names, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(names) and len(sql) > 55
    assert all(callable(q) for q in names.values())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["diag_1_category", "n"] and result.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_sample_of_queries_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("orders", "customer", "lineitem", "events"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    mine = contract.queries()[name](spark, FOLDER)
    other = con.sql(contract.oracle_sql()[name])
    order = sorted(mine.columns)
    assert order == sorted(other.columns)
    theirs = [tuple(row[other.columns.index(c)] for c in order) for row in other.fetchall()]
    rows = [tuple(r) for r in mine.select(*order).collect()]
    assert sorted(rows, key=str) == sorted(theirs, key=str)
