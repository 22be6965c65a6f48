"""Queries on rows that the smallest tables lack give what their SQL gives."""

import duckdb
import pytest

from lexspark import queries as registered


def same(spark, folder, name, table, rows, schema):
    """The query's rows over a table of these rows, and those of its SQL, in one order."""
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
        want = con.execute(f"SELECT * FROM ({registered.oracle_sql()[name]})").to_arrow_table()
    got = registered.queries()[name](spark, str(folder)).select(*want.column_names).toArrow()
    return [sorted(map(repr, x.to_pylist())) for x in (got, want)]


@pytest.mark.parametrize("rows", [
    [(1, "a"), (2, "a\u00a0"), (3, "\u3000a"), (4, "a\t"), (5, " a "), (6, "a")],
    [(1, ""), (2, " "), (3, "\u00a0 "), (4, "a")],
    [(1, None), (2, None), (3, "a")],
    [(None, "a"), (2, "a"), (3, "a"), (None, None), (None, "b")],
], ids=["spaces", "blank", "null text", "null id"])
def test_dedupe_hash(spark, tmp_path, rows):
    got, want = same(spark, tmp_path, "dedupe_hash", "documents", rows, "doc_id long, text string")
    assert got == want


def test_theme_pages(spark, tmp_path):
    heads = ["A &amp;&amp", "B &amp;lt;", "C &am", "D & E", "F &ampx;", "G &lt;&gt;&quot;&amp;", "H &lt", "I &copy", "J\ue000&amp"]
    rows = [(i, f"<html><title>t</title><body class='x&amp'><h1>{h}</h1></body></html>") for i, h in enumerate(heads)]
    got, want = same(spark, tmp_path, "theme_pages", "pages", rows, "page_id long, html string")
    assert got == want


def plan(df):
    """The physical plan, bottom up, an operator a line."""
    return df._jdf.queryExecution().executedPlan().toString().splitlines()[::-1]


DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["malformed_summary", "repair_stats"])
def test_tasks_sort_no_rows(spark, name):
    """The rows of a compact table are dealt to all tasks, which count them without sorting them."""
    lines = plan(registered.queries()[name](spark, DIR))
    assert any("Exchange hashpartitioning(p_partkey" in x for x in lines)
    counted = next(i for i, x in enumerate(lines) if "HashAggregate(keys=[tag" in x)
    assert not any("SortAggregate" in x or "Sort [" in x for x in lines[:counted])


def test_html_repair_steps(spark):
    """The rows of a compact table are dealt to all tasks, and each step of the repair is computed once."""
    lines = plan(registered.queries()["html_repair"](spark, DIR))
    assert any("Exchange hashpartitioning(p_partkey" in x for x in lines)
    assert sum(x.count("<b9bl>") for x in lines) <= 12


def test_heads_reflexes_numbers(spark):
    """No task numbers all rows of an abbreviation: there are three in this table, however many rows."""
    numbers = [x for x in plan(registered.queries()["heads_reflexes"](spark, DIR)) if "row_number()" in x]
    assert numbers and all("__bucket" in x for x in numbers)
