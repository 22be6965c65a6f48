"""Constraint checks as violation frames, profiles and counts."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.nulls import is_blank


def fk_violations(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Distinct child keys without a parent; null keys are no violation. Spark picks the join by measured sizes."""
    keys = child.select(F.col(child_key).cast("string").alias("key")).filter("key is not null").distinct()
    parents = parent.select(F.col(parent_key).cast("string").alias("key"))
    return keys.join(parents, "key", "left_anti").select(F.lit(name).alias("check"), "key")


def missing_both_ways(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of one side only, with the side that has them."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").withColumn("only_in", F.lit("left")).unionByName(y.join(x, key, "left_anti").withColumn("only_in", F.lit("right")))


def check_violations(df: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """One row for each row and check that doesn't hold (null counts as not holding); one pass."""
    bad = [F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()]
    return df.select(F.col(key).cast("string").alias("key"), F.explode(F.array_compact(F.array(*bad))).alias("check"))


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def blank_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """A2: one row a column with its number of blank cells; one pass."""
    one = df.agg(*[F.count_if(is_blank(F.col(f"`{c}`"))).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "blank")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A1."""
    each = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in tables.items()]
    return functools.reduce(DataFrame.unionByName, each)


def profile(df: DataFrame) -> DataFrame:
    """Filled, null, null percent, distinct (nulls aside) and type of every column.

    Filled counts are one pass; the distinct counts, exact, are one grouping over (column, value) pairs, so no column's set of
    values has to fit one task.
    """
    types = dict(df.dtypes)
    cells = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]).unpivot([], df.columns, "column", "value")
    distinct = cells.groupBy("column", "value").agg(F.count("*").alias("n"))
    out = distinct.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("unique"))
    pairs = [x for c in df.columns for x in (F.lit(c), F.lit(types[c]))]
    return out.select("column", "non_null", "nulls", F.round(F.col("nulls") * 100.0 / (F.col("non_null") + F.col("nulls")), 2).alias("null_pct"), "unique", F.element_at(F.create_map(*pairs), F.col("column")).alias("dtype"))


def stage_consistency(base: str, stages: dict[str, DataFrame]) -> DataFrame:
    """Row counts by stage and whether they equal the base stage's; a mismatch is a failure."""
    counts = table_counts(stages)
    first = counts.filter(F.col("table") == base).select(F.col("rows").alias("__base"))
    return counts.crossJoin(F.broadcast(first)).select("table", "rows", (F.col("rows") == F.col("__base")).alias("consistent"))


def added_columns(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns of the result, original or added during processing."""
    rows = [(c, "Original" if c in before.columns else "Added_During_Processing") for c in after.columns]
    return after.sparkSession.createDataFrame(rows, "column string, origin string")
