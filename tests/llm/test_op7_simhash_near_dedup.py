"""Near duplicates by SimHash: recall of the search at its threshold, and the groups, against brute force."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lexspark.llm import simhash
from lexspark.llm.simhash import BITS, NEAR, apart, fingerprints, golay, near_duplicates, search_keys
from lexspark.llm.textnp import utf8


def test_recall_at_the_threshold():
    random = np.random.default_rng(1)
    a = np.zeros((1000, 24), np.uint8)
    a[:, :23] = random.integers(0, 256, (1000, 23))
    b = a.copy()
    for row in b:
        for bit in random.choice(BITS, NEAR, replace=False):
            row[bit // 8] ^= 128 >> bit % 8
    code = golay()
    got = [set(zip(*(x.tolist() for x in search_keys(w.view(np.uint64), code)))) for w in (a, b)]
    assert NEAR >= 33 and len({row for _, row in got[0] & got[1]}) >= 900


def test_groups_as_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = docs.where("doc_id is not null").toArrow()
    ids = rows["doc_id"].to_numpy()
    fp, any_ = fingerprints(*utf8(rows["text"]))
    ids, fp = ids[any_], fp[any_]
    root = ids.copy()
    for i in range(len(ids)):
        close = np.flatnonzero(apart(fp, i, np.arange(len(ids))) <= NEAR)
        joined = np.isin(root, root[close])
        root[joined] = root[joined].min()
    want = set(zip(ids[root != ids].tolist(), root[root != ids].tolist()))
    got = {(r["doc_id"], r["duplicate_of"]) for r in near_duplicates(docs).collect()}
    assert want and len({x for x, _ in want} & {x for x, _ in got}) >= 0.9 * len(want) and {x for x, _ in got} <= {x for x, _ in want}


def test_a_hot_key_is_compared_in_shards_of_bounded_size(spark):
    random = np.random.default_rng(2)
    fp = np.zeros((9000, 24), np.uint8)
    fp[:, :23] = random.integers(0, 256, (9000, 23))
    fp[:, :6] = 0  # two segments that all share: one key, and leads, with every document
    for i in range(0, 600, 2):
        fp[i + 1] = fp[i]
        for bit in random.choice(np.arange(48, BITS), 30, replace=False):
            fp[i + 1, bit // 8] ^= 128 >> bit % 8
    w = fp.view(np.int64)
    reps = spark.createDataFrame([(i, *map(int, x)) for i, x in enumerate(w)], "id long, f0 long, f1 long, f2 long")
    shards = simhash._packed(reps, simhash._plan(reps, 1)).groupBy("shard").agg(F.sum(F.length("k") / 4).alias("n"))
    assert shards.agg(F.max("n")).first()[0] <= 2 * simhash.AT_ONCE
    got = {(max(r), min(r)) for r in simhash._candidates(reps).collect()}
    assert got == {(i + 1, i) for i in range(0, 600, 2)}


def test_partitions_hold_equally_many_shards(spark, monkeypatch):
    # hashed to partitions, some would hold several times SPREAD shards
    monkeypatch.setattr(simhash, "AT_ONCE", 2000)
    random = np.random.default_rng(4)
    w = random.integers(-(1 << 62), 1 << 62, (2000, 3))
    w[:, 2] &= ~0xFF
    reps = spark.createDataFrame([(i, *map(int, x)) for i, x in enumerate(w)], "id long, f0 long, f1 long, f2 long")
    plan = simhash._plan(reps, 1)
    of = simhash._dealt(simhash._packed(reps, plan), plan[0]).groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("shard").alias("shards"), F.sum(F.length("k") / 4).alias("n")).collect()
    assert plan[0] > 20 and max(r["shards"] for r in of) <= 2 * simhash.SPREAD and max(r["n"] for r in of) <= 3 * simhash.SPREAD * simhash.AT_ONCE


def test_hashing_holds_little_at_once():
    text = " ".join(f"word{i}" for i in range(1000))
    batch = pa.RecordBatch.from_pydict({"id": list(range(1000)), "t": [text] * 1000})
    tracemalloc.start()
    rows = sum(part.num_rows for part in simhash._hashed(batch, "t"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1000 and peak < 100e6  # 28 MB when measured; in pieces of 4 MB and 65,536 tokens 143 MB
