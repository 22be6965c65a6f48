"""Keyed updates, upserts, literal replacement and reviewed decisions, each as a rewrite by join."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.nulls import is_blank


def apply_updates(df: DataFrame, updates: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Rows with the new values of `updates` (key, field, new_value); several for one cell: the greatest wins.

    The updates are pivoted first, so the table is joined once and each row is written once.
    """
    wide = updates.filter(F.col("field").isin(fields)).groupBy(F.col("key").alias("__key")).agg(
        *[F.max(F.when(F.col("field") == f, F.struct(F.lit(1).alias("hit"), F.col("new_value").alias("v")))).alias(f"__u{i}") for i, f in enumerate(fields)])
    joined = df.join(wide, F.col(key).cast("string") == F.col("__key"), "left")
    at = {f: i for i, f in enumerate(fields)}
    types = dict(df.dtypes)
    return joined.select([F.when(F.col(f"__u{at[c]}").isNotNull(), F.col(f"__u{at[c]}").v.try_cast(types[c])).otherwise(F.col(c)).alias(c) if c in at else F.col(c) for c in df.columns])


def update_stats(updates: DataFrame) -> DataFrame:
    """Number of updates by field (what a dry run reports)."""
    return updates.groupBy("field").agg(F.count("*").alias("updates"), F.count_distinct("key").alias("rows"))


def upsert(current: DataFrame, changes: DataFrame, key: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """The table after the changes and the log of them.

    A key there and a filled value: update; there and blank: delete; not there and filled: insert; not there and blank: nothing.
    `changes` must hold each key once. The log has key, action, old_value, new_value.
    """
    a = current.select(*key, F.col(value).alias("__old"), F.lit(True).alias("__in"))
    b = changes.select(*key, F.col(value).alias("__new"), F.lit(True).alias("__ch"))
    j = a.join(b, key, "full_outer")
    blank = is_blank(F.col("__new"), none_literal=True)
    action = (F.when(F.col("__ch").isNull(), "keep").when(F.col("__in").isNotNull() & blank, "delete").when(F.col("__in").isNotNull(), "update")
              .when(blank, "skip").otherwise("insert"))
    j = j.withColumn("action", action)
    after = j.filter(~F.col("action").isin("delete", "skip")).select(*key, F.when(F.col("action") == "keep", F.col("__old")).otherwise(F.col("__new")).alias(value))
    log = j.filter(F.col("action").isin("delete", "update", "insert")).select(*key, "action", F.col("__old").alias("old_value"), F.col("__new").alias("new_value"))
    return after, log


def scoped_replace(df: DataFrame, find: str, put: str, column: str | None = None, rows: Column | None = None) -> DataFrame:
    """A literal replaced everywhere, in one column, in the rows of a predicate, or in both; nulls stay null."""
    where = F.lit(True) if rows is None else rows
    def cell(c):
        hit = dict(df.dtypes)[c] == "string" and column in (None, c)
        return F.when(where, F.replace(F.col(f"`{c}`"), F.lit(find), F.lit(put))).otherwise(F.col(f"`{c}`")).alias(c) if hit else F.col(f"`{c}`")
    return df.select(*[cell(c) for c in df.columns])


def replace_all(c: Column, pairs: dict[str, str]) -> Column:
    """Literals replaced in the order given."""
    return functools.reduce(lambda t, kv: F.replace(t, F.lit(kv[0]), F.lit(kv[1])), pairs.items(), c)


def batch_replace(df: DataFrame, pairs: dict[str, str], columns: list[str]) -> DataFrame:
    """The columns rewritten, and `changed_cells` with the number of them that changed in the row."""
    changed = sum((F.when(replace_all(F.col(c), pairs) != F.col(c), 1).otherwise(0) for c in columns), F.lit(0))
    return df.select(*[replace_all(F.col(c), pairs).alias(c) if c in columns else F.col(c) for c in df.columns], changed.alias("changed_cells"))


def remaining_tags(df: DataFrame, key: str, column: str, tags: list[str]) -> DataFrame:
    """For each tag of a dictionary its occurrences, the rows that hold it, and the first of them."""
    from lexspark.functions.markup import occurrences
    rows = df.select(key, F.inline(F.filter(F.array(*[F.struct(F.lit(t).alias("tag"), occurrences(F.col(column), t).alias("n")) for t in tags]), lambda x: x.n > 0)))
    return rows.groupBy("tag").agg(F.sum("n").cast("bigint").alias("occurrences"), F.count("*").alias("rows"), F.min(key).alias("first_row"))


def grep(df: DataFrame, key: str, columns: list[str], needle: str, width: int = 200) -> DataFrame:
    """P10: cells that contain the text, with a cut view of them; a regular expression isn't meant."""
    cells = df.select(key, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("cell")) for c in columns])))
    view = F.when(F.length("cell") > width, F.concat(F.left("cell", F.lit(width)), F.lit("..."))).otherwise(F.col("cell"))
    return cells.filter(F.contains("cell", F.lit(needle))).select(key, "column", view.alias("context"))


#: (all of these parts, action): the first row that holds decides.
RULES = [
    (("use scraped", "update local"), "use_scraped_update_local"),
    (("scraped value is the correct", "update local"), "use_scraped_update_local"),
    (("use scraped to update both",), "update_both_from_scraped"),
    (("update both", "based off scraped"), "update_both_from_scraped"),
    (("use local", "update scraped"), "use_local_update_scraped"),
    (("local value is the correct", "update scraped"), "use_local_update_scraped"),
    (("local value is incorrect",), "use_scraped_update_local"),
    (("update both", "based off local"), "update_both_from_local"),
    (("update local dataset value with current local",), "use_local_update_scraped"),
    (("local will have", "value deleted"), "delete_local"),
    (("actual value in both is none",), "delete_local"),
]


def decision_action(decision: Column) -> Column:
    """one of six actions; 'skip' for null, blank and unknown decisions."""
    low = F.lower(F.trim(F.coalesce(decision, F.lit(""))))
    hit = [functools.reduce(lambda a, b: a & b, [F.contains(low, F.lit(p)) for p in parts]) for parts, _ in RULES]
    return functools.reduce(lambda w, x: (F if w is None else w).when(x[0], x[1][1]), zip(hit, RULES), None).otherwise("skip")


def checks_spanish(decision: Column) -> Column:
    """whether the Spanish attestation is to be looked at as well."""
    low = F.lower(F.coalesce(decision, F.lit("")))
    return F.contains(low, F.lit("spanish attestation")) | F.contains(low, F.lit("spanish one"))


def decision_updates(report: DataFrame, decision: str) -> DataFrame:
    """The updates that reviewed rows (key, field, new_value, old_value) ask for: target table, field, value, action.

    Deletion is a null value. Skipped rows give none.
    """
    d = report.withColumn("action", decision_action(F.col(decision)))
    def put(target, value):
        return F.struct(F.lit(target).alias("target"), value.alias("value"))
    none = F.lit(None).cast("string")
    new, old = F.col("new_value"), F.col("old_value")
    puts = (F.when(F.col("action") == "use_scraped_update_local", F.array(put("local", new)))
            .when(F.col("action") == "use_local_update_scraped", F.array(put("scraped", old)))
            .when(F.col("action") == "update_both_from_scraped", F.array(put("local", new), put("scraped", new)))
            .when(F.col("action") == "update_both_from_local", F.array(put("local", old), put("scraped", old)))
            .when(F.col("action") == "delete_local", F.array(put("local", none))))
    return d.select("key", "field", "action", F.inline(puts))


def decision_stats(report: DataFrame, decision: str, by: str) -> DataFrame:
    """Decisions by category and action, with those that ask for the Spanish attestation."""
    return report.groupBy(F.col(by).alias("category"), decision_action(F.col(decision)).alias("action")).agg(F.count("*").alias("n"), F.count_if(checks_spanish(F.col(decision))).alias("spanish"))


def resolve(choices: DataFrame, sources: dict[str, tuple[DataFrame, str, str]], key: str, choice: str) -> DataFrame:
    """The value of the source that each row chose. `sources` maps a choice to (table, key, value); tables are reduced to
    one row a key (the smallest value) before the join. Unknown choices and missing keys give null."""
    out, value = choices, F.lit(None).cast("string")
    for i, (name, (df, k, v)) in enumerate(sources.items()):
        one = df.groupBy(F.col(k).alias(f"__k{i}")).agg(F.min(F.col(v).cast("string")).alias(f"__v{i}"))
        out = out.join(one, F.col(key) == F.col(f"__k{i}"), "left")
        value = F.when(F.col(choice) == name, F.col(f"__v{i}")).otherwise(value)
    return out.select(*choices.columns, value.alias("source_value"))


def adjudicate(new: Column, old: Column, manual: Column) -> Column:
    """A deterministic choice among three versions: a filled manual one, else the only filled one, else the scraped one if the
    two agree or differ in punctuation alone, else the longer."""
    from lexspark.functions.text import punctuation_only, same_text
    return (F.when(~is_blank(manual), "manual").when(is_blank(new) & is_blank(old), "none_match").when(is_blank(new), "local").when(is_blank(old), "scraped")
            .when(same_text(new, old) | punctuation_only(new, old), "scraped").when(F.length(new) >= F.length(old), "scraped").otherwise("local"))
