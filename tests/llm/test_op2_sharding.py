"""Best-fit decreasing against the plain version, over ties, zeros, large groups and several parts."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lexspark.llm.sharding import Tree, best_fit, shards, sharded


def plain(sizes, capacity):
    room, out = [], []
    for size in sizes:
        fits = [(r, i) for i, r in enumerate(room) if r >= size] if size <= capacity else []
        if fits:
            _, i = min(fits)
            room[i] -= size
            out.append(i)
        else:
            room.append(capacity - size if size <= capacity else -1)
            out.append(len(room) - 1)
    return out


def expanded(items, capacity):
    out, classes = [], [(k, len(list(g))) for k, g in itertools.groupby(items)]
    runs = list(best_fit(classes, capacity))
    for size, number in classes:
        own = [r for r in runs if r[0] == size]
        for nth in range(number):
            _, rank, each, bin_ = [r for r in own if r[1] <= nth][-1]
            out.append(bin_ + (nth - rank) // each)
    return out


def test_runs_are_the_plain_packing():
    rnd = random.Random(5)
    for _ in range(500):
        capacity = rnd.choice([5, 10, 64, 200])
        items = sorted((min(rnd.randint(0, capacity + 2), capacity + 1) for _ in range(rnd.randint(0, 60))), reverse=True)
        assert expanded(items, capacity) == plain(items, capacity)


def test_tree_finds_the_least():
    rnd, tree, have = random.Random(2), Tree(5000), set()
    for _ in range(3000):
        x = rnd.randint(0, 5000)
        tree.add(x) if x not in have else tree.remove(x)
        have ^= {x}
        y = rnd.randint(0, 5000)
        assert tree.least(y) == min((z for z in have if z >= y), default=None)


@pytest.mark.parametrize("capacity", [50, 1000])
def test_shards_as_by_the_plain_version(spark, capacity):
    rnd = random.Random(9)
    rows = [(i, rnd.choice([7, 7, 7, 0, 13, 29, 48, 60, 2000])) for i in range(3000)] + [(i, 5) for i in range(0, 300, 3)] + [(None, 4), (5000, None), (5001, -3)]
    df = spark.createDataFrame(rows, "doc_id long, n_chars long")
    got = shards(df, capacity=capacity).collect()
    size = {}
    for k, n in rows:
        size[k] = size.get(k, 0) + max(n or 0, 0)
    assert {(r["doc_id"], r["size"]) for r in got} == set(size.items()) and len(got) == len(size)
    bins = plain(sorted((min(x, capacity + 1) for x in size.values()), reverse=True), capacity)
    assert {r["shard"] for r in got} == set(range(max(bins) + 1))
    load, want = {}, {}
    for r in got:
        load[r["shard"]] = load.get(r["shard"], 0) + min(r["size"], capacity + 1)
    for b, x in zip(bins, sorted((min(x, capacity + 1) for x in size.values()), reverse=True)):
        want[b] = want.get(b, 0) + x
    assert load == want


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, n_chars long, text string")
    assert shards(none).collect() == [] and sharded(none).collect() == []
    rows = spark.createDataFrame([("a", 3, "x", 9), ("a", 3, "x", 9), (None, 1, "y", 8)], "doc_id string, n_chars long, text string, shard int")
    out = sharded(rows).collect()
    assert len(out) == 3 and {r["shard"] for r in out} == {0} and set(out[0].asDict()) == {"doc_id", "n_chars", "text", "shard"}
    with pytest.raises(ValueError):
        shards(rows.withColumn("size", F.lit(1)), group="size")
