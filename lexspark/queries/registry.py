"""Registration of queries: a name, a function of (session, folder), and the SQL for the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str, key: str) -> DataFrame:
        """The table's rows, dealt to all tasks by the key: a compact table is read by few tasks, which would do all that its rows want."""
        return self.__getattr__(name).repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), key)


def widened(df: DataFrame) -> DataFrame:
    """Integers as bigint, so that both engines give one type."""
    return df.select([F.col(f"`{c}`").cast("bigint").alias(c) if t in ("int", "smallint", "tinyint") else F.col(f"`{c}`") for c, t in df.dtypes])


def query(name: str, sql: str | None = None):
    def put(fn: Callable[[Tables], DataFrame]):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return widened(fn(Tables(spark, sf_dir)))
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn
    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
