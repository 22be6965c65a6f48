"""The windows of one shard are held at a time, however few partitions there are; many small shards and rows give what the SQL gives."""

import __spark_entry__ as entry

import duckdb
import numpy as np
import pyarrow as pa

from lexspark.llm import substring_dedup

DIR = "/root/testdata/sf0.001"


def test_many_small_shards_agree_with_sql(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD", 5_000)
    monkeypatch.setattr(substring_dedup, "ROW", 7)
    monkeypatch.setattr(substring_dedup, "GATHER", 3_000)
    got = substring_dedup.op1_substring_dedup(spark, DIR).collect()
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
        want = con.sql(entry.oracle_sql()["op1_substring_dedup"]).fetchall()
    assert want and sorted(map(tuple, got)) == sorted(want)


def test_a_partition_is_held_shard_by_shard():
    h = np.arange(10_000, dtype=np.uint64)
    rows = substring_dedup._row(0, substring_dedup._split((h % 10).astype(np.int64), h, h.astype(np.int64), h.astype(np.int32)))
    assert rows.num_rows > 10 and max(len(x.as_py()) for x in rows.column(2)) <= 8 * substring_dedup.ROW
    cut = [rows.slice(at, 3) for at in range(0, rows.num_rows, 3)]
    held = list(substring_dedup.by_shard(iter([rows.slice(0, 0), *cut])))
    assert [pa.compute.unique(x.column(0)).to_pylist() for x in held] == [[k] for k in range(10)]
    for k, x in enumerate(held):
        assert (substring_dedup.unpacked(x, 2, np.uint64) == h[k::10]).all() and (substring_dedup.unpacked(x, 4, np.int32) == h[k::10]).all()
        assert not len(substring_dedup.unpacked(x, 5, np.int32))
    assert list(substring_dedup.by_shard(iter([]))) == []
