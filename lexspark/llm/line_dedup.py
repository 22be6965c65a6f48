"""Line deduplication with levelled sorted runs of line hashes."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lexspark.llm.storage import written

#: Batches that a table is taken in, and runs of a level that are compacted into one of the next level.
BATCHES, FANOUT = 4, 3
HASH = ["h1", "h2"]
TRIM = " \t\r"


class LineIndex:
    """The hashes of all lines seen, as sorted runs in levels.

    add() takes a batch of (h1, h2, ...), keeps the first row of each hash by the remaining columns' order, drops by a merge
    anti-join those that a run has, writes the rest as a run of level 0 and returns it. A level of FANOUT runs is compacted.
    """

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def add(self, batch: DataFrame) -> DataFrame:
        rest = [c for c in batch.columns if c not in HASH]
        own = batch.groupBy(*HASH).agg(F.min(F.struct(*rest)).alias("first")).select(*HASH, "first.*")
        for run in self.runs():
            own = own.join(run.select(*HASH).hint("merge"), HASH, "left_anti")
        run = written(own.sortWithinPartitions(*HASH), "lines-run")
        self._push(run, 0)
        return run

    def _push(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            # runs share no hash, so compaction is a merge without any comparison of rows
            whole = reduce(DataFrame.unionByName, self.levels[level]).repartition(*HASH).sortWithinPartitions(*HASH)
            self.levels[level] = []
            self._push(written(whole, "lines-run"), level + 1)


def _bounds(known: DataFrame, batches: int) -> list:
    """Keys that part the batches: quantiles, for keys that are no numbers of a thousand of them that a hash picks."""
    if batches < 2:
        return []
    if isinstance(known.schema["k"].dataType, NumericType):
        return known.agg(F.percentile_approx("k", [i / batches for i in range(1, batches)], 10_000)).first()[0] or []
    some = sorted(r[0] for r in known.select("k").distinct().orderBy(F.xxhash64("k")).limit(1000).collect())
    return [some[len(some) * i // batches] for i in range(1, batches)] if some else []


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES) -> DataFrame:
    """(key, text, removed): each document without the lines that an earlier line of the corpus equals, and how many went.

    Lines are compared without white space at their ends. Earlier is by key, then place. Blank lines stay and count for
    nothing. A document that loses all lines stays with an empty text. Rows with a null key or text stay as they are
    (removed is 0). Rows that repeat key and text are one document; other rows of one key are ordered by a hash of the text.
    Batches are ranges of the key, so their number doesn't change the result. Hashes have 128 bits.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    known = base.where("k is not null and t is not null")
    bounds = _bounds(known, batches)
    batch = sum(((F.col("k") > F.lit(b)).cast("int") for b in bounds), F.lit(0))
    line = F.explode(F.transform(F.split("t", "\n"), lambda x, i: F.struct(i.alias("i"), F.trim(x, F.lit(TRIM)).alias("x"))))
    cut = known.select("k", F.xxhash64("t").alias("th"), batch.alias("batch"), line.alias("l")).where("l.x <> ''")
    hashed = cut.select("k", "th", F.col("l.i").alias("i"), F.xxhash64("l.x").alias("h1"), F.xxhash64(F.lit("second"), "l.x").alias("h2"), "batch")
    # one scan of the texts; each batch then scans the written hashes
    lines = written(hashed, "lines")
    index = LineIndex()
    kept = [index.add(lines.where(F.col("batch") == n).select(*HASH, "k", "th", "i")) for n in range(batches)]
    first = reduce(DataFrame.unionByName, kept).select("k", "th", "i")
    gone = lines.select("k", "th", "i").join(first, ["k", "th", "i"], "left_anti").groupBy("k", "th").agg(F.collect_set("i").alias("gone"))
    whole = base.withColumn("th", F.xxhash64("t"))
    both = whole.join(gone.hint("shuffle_hash"), ["k", "th"], "left")
    left = F.array_join(F.filter(F.split("t", "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    return both.select(F.col("k").alias(key), F.when(F.col("gone").isNull(), F.col("t")).otherwise(left).alias(text), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("removed"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM documents),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) = '' OR row_number() OVER (PARTITION BY trim(line, ' ' || chr(9) || chr(13)) ORDER BY doc_id, i) = 1 AS keep FROM l)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keep), '') AS text, count(*) FILTER (NOT keep) AS removed FROM k GROUP BY doc_id
"""
