"""Sharding by best-fit-decreasing bin packing of indivisible groups, over all groups at once.

Groups of one size are alike, and so are bins with one room left, so the packing runs over sizes with their numbers and rooms
with their bins: both have at most as many values as a shard has characters, however many groups there are. What comes out
are runs (so many groups of this size, from this rank on, fill these bins); each group finds its run by its rank among equals.
"""

import sys
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.llm.storage import written

#: Characters that fit into one shard, and parts that the groups of one size are ranked in.
CAPACITY, PARTS = 1 << 20, 256


class Tree:
    """A balanced search tree over the numbers 0 to most: each node has a bit for each of its 64 children that holds something."""

    def __init__(self, most: int):
        self.levels, n = [], most + 1
        while True:
            n = -(-n // 64)
            self.levels.append([0] * n)
            if n == 1:
                break

    def add(self, x: int) -> None:
        for level in self.levels:
            x, bit = divmod(x, 64)
            level[x] |= 1 << bit

    def remove(self, x: int) -> None:
        for level in self.levels:
            x, bit = divmod(x, 64)
            level[x] &= ~(1 << bit)
            if level[x]:
                return

    def least(self, x: int) -> int | None:
        """The smallest number of at least x; None if there is none."""
        for up, level in enumerate(self.levels):
            x, bit = divmod(x, 64)
            here = level[x] >> bit << bit if x < len(level) else 0
            if here:
                x = x * 64 + (here & -here).bit_length() - 1
                for below in reversed(self.levels[:up]):
                    x = x * 64 + (below[x] & -below[x]).bit_length() - 1
                return x
            x += 1
        return None


def best_fit(sizes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """Runs (size, first rank, groups to a bin, first bin) for sizes with their numbers, which come largest first.

    Each group goes to the bin with the least room that is enough, the earlier one of equals, or to a new bin. A bin that took
    one then has less room than all others that are enough, so it takes the next ones as well until it has too little: bins of
    one room are filled one after another by equal numbers of groups. A size above the capacity takes a bin for each group.
    """
    tree, bins = Tree(capacity), 0
    rooms: dict[int, list[tuple[int, int]]] = {}  # ranges of bins with this room, as a heap

    def put(room: int, begin: int, end: int) -> None:
        if room not in rooms:
            rooms[room] = []
            tree.add(room)
        heappush(rooms[room], (begin, end))

    for size, number in sizes:
        if size > capacity:
            yield size, 0, 1, bins
            bins += number
            continue
        rank = 0
        while rank < number:
            left = number - rank
            room = tree.least(size)
            if room is None:
                room = capacity
                begin, end = bins, bins + (1 if not size else -(-left // (capacity // size)))
                bins = end
            else:
                begin, end = heappop(rooms[room])
                if not rooms[room]:
                    del rooms[room]
                    tree.remove(room)
            each = room // size if size else left
            whole = min(end - begin, left // each) if each else 0
            yield size, rank, each, begin
            if whole:
                put(room - each * size, begin, begin + whole)
                rank += whole * each
            begin += whole
            if begin < end and rank < number:
                put(room - (number - rank) * size, begin, begin + 1)
                rank = number
                begin += 1
            if begin < end:
                put(room, begin, end)


def shards(docs: DataFrame, group: str = "doc_id", size: str = "n_chars", capacity: int = CAPACITY) -> DataFrame:
    """(group, size, shard): one row for each group of rows with the same value, never divided; sizes of its rows add up.

    Best-fit decreasing over all groups; equal sizes come in the order of a hash of the group, then the group. Shards are
    numbered from 0 without gaps. A null or negative size counts 0, a null group is a group, a group above the capacity is
    alone in its shard, an empty table gives no row. Other columns don't matter; the group column must not be named size or
    shard. No task sees all groups: only the numbers of groups of each size, at most capacity + 2 rows, come together. A size
    that very many groups have is ranked in PARTS parts.
    """
    if group in ("size", "shard"):
        raise ValueError("the group column's name is one of the result's")
    amount = F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0))
    sums = docs.select(F.col(group).alias("g"), amount.alias("size")).groupBy("g").agg(F.sum("size").alias("size"))
    # all sizes above the capacity are one class
    groups = written(sums.select("g", "size", F.least("size", F.lit(capacity + 1)).alias("c"), F.pmod(F.xxhash64("g"), F.lit(PARTS)).alias("part")), "groups")
    parts = written(groups.groupBy("c", "part").agg(F.count("*").alias("n")), "group-counts")
    before = Window.partitionBy("c").orderBy("part")
    offsets = parts.select("c", "part", "n", (F.sum("n").over(before) - F.col("n")).alias("first"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("c", "descending")])
        got = list(zip(*best_fit(zip(table["c"].to_pylist(), table["n"].to_pylist()), capacity))) or [()] * 4
        return pa.table([pa.array(x, pa.int64()) for x in got], ["c", "rank", "each", "bin"])

    runs = written(parts.groupBy("c").agg(F.sum("n").alias("n")).groupBy().applyInArrow(pack, "c long, rank long, each long, bin long"), "shard-runs")
    # a run that goes over several parts is given to each of them
    upto = F.coalesce(F.lead("rank").over(Window.partitionBy("c").orderBy("rank")), F.lit((1 << 63) - 1))
    spans = runs.withColumn("upto", upto).withColumnRenamed("c", "rc").join(offsets, (F.col("rc") == F.col("c")) & (F.col("rank") < F.col("first") + F.col("n")) & (F.col("upto") > F.col("first")))
    starts = spans.select("c", "part", F.greatest("rank", "first").alias("at"), F.struct("rank", "each", "bin").alias("run"), F.lit(None).cast(docs.schema[group].dataType).alias("g"), F.lit(None).cast("long").alias("size"), F.lit(0).alias("kind"))
    inside = Window.partitionBy("c", "part").orderBy("g")
    ranked = groups.withColumn("nth", F.row_number().over(inside) - 1).join(offsets.select("c", "part", "first"), ["c", "part"])
    items = ranked.select("c", "part", (F.col("first") + F.col("nth")).alias("at"), F.lit(None).cast("struct<rank:bigint,each:bigint,bin:bigint>").alias("run"), "g", "size", F.lit(1).alias("kind"))
    held = F.last("run", ignorenulls=True).over(Window.partitionBy("c", "part").orderBy("at", "kind"))
    placed = starts.unionByName(items).withColumn("held", held).where("kind = 1")
    shard = (F.col("held.bin") + F.floor((F.col("at") - F.col("held.rank")) / F.col("held.each"))).cast("long")
    return placed.select(F.col("g").alias(group), "size", shard.alias("shard"))


def sharded(docs: DataFrame, group: str = "doc_id", size: str = "n_chars", capacity: int = CAPACITY) -> DataFrame:
    """The rows, in all their columns, with the shard of their group (a column named shard is replaced)."""
    of = shards(docs, group, size, capacity).select(F.col(group).alias("__group"), F.col("shard").alias("__shard"))
    rows = docs.drop("shard") if "shard" in docs.columns else docs
    return rows.join(of, rows[group].eqNullSafe(of["__group"])).drop("__group").withColumnRenamed("__shard", "shard")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))


register_pickle_by_value(sys.modules[__name__])
