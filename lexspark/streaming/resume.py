"""Work that stops and goes on, by Structured Streaming's own checkpoints instead of cursor files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def run_available(source: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hands every batch of new input to `sink` and returns when none is left; a second run sees only what came since.

    The checkpoint must lie in shared storage. A batch that fails is given again with the same number, so the sink should write by it.
    """
    q = source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def stream_parquet(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 10) -> DataFrame:
    """Files of a folder as a stream, a bounded number a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def unseen(source: DataFrame, hash_col: str) -> DataFrame:
    """Rows whose hash no batch had before; the hashes are the query's state, kept with its checkpoint (and growing with them)."""
    return source.dropDuplicates([hash_col])


def windowed_counts(source: DataFrame, at: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by time window and group, late rows within the watermark counted."""
    return source.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def write_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A sink for run_available: one folder a batch, replaced if the batch comes again."""
    return lambda df, i: df.write.mode("overwrite").parquet(f"{path}/batch={i}")
