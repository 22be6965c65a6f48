"""Every registered query with SQL gives what DuckDB gives, at the smallest scale; the others run."""

import duckdb
import pytest

import __spark_entry__ as entry
from lexspark import queries as registered

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    with duckdb.connect() as con:
        con.execute("SET TimeZone = 'UTC'")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
        yield con


def plain(table):
    cols = sorted(table.column_names)
    return cols, sorted(tuple(f"{v:.9g}" if isinstance(v, float) else repr(v) for v in (r[c] for c in cols)) for r in table.select(cols).to_pylist())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, duck, name):
    got = registered.queries()[name](spark, DIR).toArrow()
    sql = registered.oracle_sql().get(name)
    assert got.num_rows >= 0
    if sql:
        assert plain(got) == plain(duck.sql(sql).to_arrow_table())


def test_entry(spark):
    assert entry.entry(spark).columns == ["tag", "type", "fix", "n", "first_page"]
