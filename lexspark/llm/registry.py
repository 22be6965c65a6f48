"""The queries of this subpackage, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexspark.llm import decontaminate, edit_embedding, language_id, line_dedup, mixing, sharding, simhash, substring_dedup, suffix_dedup, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": substring_dedup.op1_substring_dedup,
        "op2_sharding": sharding.op2_sharding,
        "op3_suffix_array_dedup": suffix_dedup.op3_suffix_array_dedup,
        "op4_line_dedup": line_dedup.op4_line_dedup,
        "op5_document_fingerprints": edit_embedding.op5_document_fingerprints,
        "op6_language_id": language_id.op6_language_id,
        "op7_simhash_near_dedup": simhash.op7_simhash_near_dedup,
        "op8_benchmark_decontamination": decontaminate.op8_benchmark_decontamination,
        "op9_source_mixing": mixing.op9_source_mixing,
        "op10_toxicity": toxicity.op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": substring_dedup.SQL,
        "op3_suffix_array_dedup": suffix_dedup.SQL,
        "op4_line_dedup": line_dedup.SQL,
        "op6_language_id": language_id.SQL,
        "op8_benchmark_decontamination": decontaminate.SQL,
    }
