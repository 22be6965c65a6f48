"""A training corpus from `documents`: language ID, SimHash near-dedup, decontamination, source mixing, sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexspark.llm import decontaminate, language_id, mixing, sharding, simhash, storage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language some profile accepts; the profiles are trained on labelled rows of the input.

    Null and empty texts and texts without letters are rejected. Repeated rows are judged alike, null keys stay, an empty table
    stays empty (and trains no profile).
    """
    return language_id.accepted(docs, language_id.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest key; of repeated rows one.

    Texts without a word and rows with a null key are in no group and stay. An empty table stays empty.
    """
    return simhash.without_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of `benchmark`. Null and empty texts stay, as does everything if `benchmark` is empty."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks drawn to the sources' target weights, each as a document with the columns of the one in which it starts.

    Null and empty texts give no block; a null source is a source, a null key stays null; an empty table stays empty.
    """
    return mixing.as_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard; the blocks of one key stay together (null keys too), whatever their size."""
    return sharding.sharded(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", mixture),
    ("sharding", shards),
]

#: Fingerprints, permutations and bin packing have no SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, each written as Parquet and read again; what a stage wrote besides is deleted after it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before = list(storage.MADE)
        docs = storage.written(stage(spark, docs, sf_dir), name)
        storage.release(spark, [x for x in storage.MADE[:-1] if x not in before])
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
