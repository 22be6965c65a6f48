"""The suffix-array operator is registered, and gives what its SQL gives."""

import __spark_entry__ as entry

import duckdb

DIR = "/root/testdata/sf0.001"


def test_op3_is_registered_and_agrees_with_its_sql(spark):
    got = entry.queries()["op3_suffix_array_dedup"](spark, DIR).collect()
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
        want = con.sql(entry.oracle_sql()["op3_suffix_array_dedup"]).fetchall()
    assert want and sorted(map(tuple, got)) == sorted(want)
