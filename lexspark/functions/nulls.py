"""The null model: SQL NULL inside, blanks and null tokens recognised at the edges, no 'nan' ever made."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Cell texts that a CSV scan reads as null (the empty cell too).
NA_TOKENS = sorted({"", "NA", "N/A", "n/a", "NULL", "null", "NaN", "nan", "-nan", "-NaN", "None", "<NA>", "#N/A", "#NA", "#N/A N/A", "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN"})


def is_blank(c: Column, none_literal: bool = False) -> Column:
    """True for null, '' and white space; with `none_literal` for the text 'None' too. Never null."""
    t = F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)\s+", " "))
    blank = t == ""
    return blank | (t == "None") if none_literal else blank


def null_if_blank(c: Column, none_literal: bool = False) -> Column:
    return F.when(~is_blank(c, none_literal), c)


def null_tokens(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NA tokens of the string columns (or of those named) become null, whole cells only."""
    names = set(columns or [f.name for f in df.schema if isinstance(f.dataType, StringType)])
    return df.select([F.when(~F.col(f"`{n}`").isin(NA_TOKENS), F.col(f"`{n}`")).alias(n) if n in names else F.col(f"`{n}`") for n in df.columns])


def coerce_int(c: Column) -> Column:
    """An integer, 0 where the text isn't a number; fractions are cut."""
    return F.coalesce(F.trim(c.cast("string")).try_cast("double").cast("bigint"), F.lit(0).cast("bigint"))


def fill_blank(df: DataFrame) -> DataFrame:
    """Null strings become ''."""
    return df.na.fill("")
