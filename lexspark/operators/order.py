"""Global row numbers, batches and ids without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_row_number(df: DataFrame, key: str, name: str = "rn", start: int = 1) -> DataFrame:
    """Rows numbered from `start` by `key`, which must be unique and not null.

    Boundaries between buckets come from percentile_approx or, for other types than numbers, from hash-chosen keys (as many as
    shuffle partitions, a proven bound on what the driver holds). Each bucket is numbered in its own task, and the counts
    of the buckets before it (one row a bucket, broadcast) are added: no task sees all rows, and the result is exact.
    An empty table gives no rows. Repeated keys are numbered in no defined order among themselves.
    """
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    if dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint", "float", "double"):
        cuts = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 10000)).first()[0] or []
    else:
        cuts = [r[0] for r in df.select(key).orderBy(F.xxhash64(key)).limit(n - 1).collect()]
    cuts = sorted({c for c in cuts if c is not None})
    bucket = sum((F.when(F.col(key) > F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    rows = df.withColumn("__bucket", bucket)
    counts = rows.groupBy("__bucket").count()
    before = counts.select("__bucket", (F.sum("count").over(Window.orderBy("__bucket")) - F.col("count")).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__bucket").orderBy(key)).cast("bigint")
    joined = rows.withColumn("__in", inside).join(F.broadcast(before), "__bucket")
    return joined.withColumn(name, F.col("__in") + F.col("__before") + (start - 1)).drop("__bucket", "__in", "__before")


def batches(df: DataFrame, key: str, size: int) -> DataFrame:
    """Batch numbers from 1, `size` rows each, by key order."""
    return with_row_number(df, key).withColumn("batch", F.floor((F.col("rn") - 1) / size).cast("bigint") + 1)


def batch_manifest(batched: DataFrame, prefix: str) -> DataFrame:
    """K7: one row a batch with its entry range and file name (the total number of batches is part of the name)."""
    per = batched.groupBy("batch").agg(F.count("*").alias("entries"), F.min("rn").alias("first"), F.max("rn").alias("last"))
    total = per.agg(F.max("batch").alias("batches"))
    name = F.format_string("%s_%02d_of_%02d_entries_%d-%d", F.lit(prefix), "batch", "batches", "first", "last")
    return per.crossJoin(F.broadcast(total)).select("batch", "entries", "first", "last", name.alias("file"))


def positional_slice(df: DataFrame, key: str, start: int, end: int) -> DataFrame:
    """Rows start (0-based, counted) to end (not counted) by key order."""
    return with_row_number(df, key, start=0).filter(F.col("rn").between(start, end - 1)).drop("rn")


def running_ids(df: DataFrame, group: Column, abbreviation: Column, key: str, width: int = 3) -> DataFrame:
    """{abbreviation}{number}, counted by `key` within each abbreviation (two groups that share one don't collide)."""
    w = Window.partitionBy("__abbr").orderBy(key)
    out = df.withColumn("__group", group).withColumn("__abbr", abbreviation)
    return out.withColumn("id", F.format_string(f"%s%0{width}d", "__abbr", F.row_number().over(w))).drop("__group", "__abbr")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """N rows chosen by a seeded hash of the key: the same rows for any partitioning."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)
