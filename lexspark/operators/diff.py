"""Field-by-field comparison of two versions of a table, and what follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions import text as T


def pairs(new: DataFrame, old: DataFrame, fields: dict[str, str], key: Column | str, old_key: Column | str) -> DataFrame:
    """One row for each key on both sides and field: key, field, new_value, old_value (texts). A shuffle for the join, none after."""
    k, ok = (F.col(x) if isinstance(x, str) else x for x in (key, old_key))
    a = new.select(k.cast("string").alias("key"), *[F.col(f"`{n}`").cast("string").alias(f"n{i}") for i, n in enumerate(fields)])
    b = old.select(T.key_strip(ok.cast("string")).alias("key"), *[F.col(f"`{o}`").cast("string").alias(f"o{i}") for i, o in enumerate(fields.values())])
    cells = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"n{i}").alias("new_value"), F.col(f"o{i}").alias("old_value")) for i, n in enumerate(fields)])
    return a.join(b, "key").select("key", F.inline(cells))


def compare(cells: DataFrame) -> DataFrame:
    """For each field the pairs, the equal ones, the differing ones, and those with a blank on one side."""
    same = T.same_text(F.col("new_value"), F.col("old_value"))
    new_blank, old_blank = (F.trim(F.coalesce(c, F.lit(""))) == "" for c in ("new_value", "old_value"))
    return cells.groupBy("field").agg(F.count("*").alias("compared"), F.count_if(same).alias("matching"), F.count_if(~same).alias("differing"),
                                      F.count_if(new_blank & ~old_blank).alias("only_old"), F.count_if(old_blank & ~new_blank).alias("only_new"))


def discrepancies(cells: DataFrame) -> DataFrame:
    return cells.filter(~T.same_text(F.col("new_value"), F.col("old_value")))


def sample_discrepancies(cells: DataFrame, n: int = 5, width: int = 100) -> DataFrame:
    """The n first differing keys of each field, texts cut to `width` for display."""
    from pyspark.sql import Window
    d = discrepancies(cells).withColumn("__salt", F.pmod(F.xxhash64("key"), F.lit(64)))
    few = d.withColumn("__r", F.row_number().over(Window.partitionBy("field", "__salt").orderBy("key"))).filter(F.col("__r") <= n)
    top = few.withColumn("__r", F.row_number().over(Window.partitionBy("field").orderBy("key"))).filter(F.col("__r") <= n)
    return top.select("field", "key", F.left("new_value", F.lit(width)).alias("new_value"), F.left("old_value", F.lit(width)).alias("old_value"))


def update_frame(cells: DataFrame) -> DataFrame:
    """One row for each differing field, with the value to write and the kind of change."""
    d = discrepancies(cells)
    blank = F.trim(F.coalesce("old_value", F.lit(""))) == ""
    return d.select("key", "field", F.col("old_value").alias("current_value"), "new_value", F.when(blank, "fill").when(F.trim(F.coalesce("new_value", F.lit(""))) == "", "clear").otherwise("update").alias("action"))


def mismatch_report(cells: DataFrame) -> DataFrame:
    """C11: differing pairs with item difference, length difference, first place, context, and what to do."""
    n, o = F.col("new_value"), F.col("old_value")
    return discrepancies(cells).select("key", "field", n, o, T.punctuation_only(n, o).alias("punctuation_only_diff"), T.recommended_action(n, o).alias("recommended_action"),
                                       T.item_diff(n, o).alias("item_diff"), T.length_diff(n, o).alias("char_length_diff"), T.first_diff(n, o).alias("first_diff_at"), T.diff_context(n, o).alias("diff_context"))
