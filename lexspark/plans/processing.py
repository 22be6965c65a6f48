"""The wide table's processing: markup analysis and repair, citations, cross-references, reports, import and export.

Everything is one lazy frame; the content columns are rewritten in a single select (no shuffle), reports unpivot them.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark import schemas
from lexspark.functions import markup as M
from lexspark.functions import nested as N
from lexspark.functions.text import items
from lexspark.operators.validate import check_violations, fk_violations


def cells(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row a cell: key, column, cell (nulls kept out)."""
    rows = df.select(key, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("cell")) for c in columns])))
    return rows.filter("cell is not null")


def rewrite(df: DataFrame, columns: list[str], fn) -> DataFrame:
    return df.select(*[fn(F.col(f"`{c}`")).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def malformed_rows(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row for each cell and pattern: literals with their fix, unequal counts, doubled brackets."""
    c = F.col("cell")
    def row(tag, fix, n):
        return F.struct(tag.alias("tag"), fix.alias("suggestion"), n.alias("n"))
    literal = [row(F.lit(a), F.lit(b), M.occurrences(c, a)) for a, b in M.LITERALS]
    regex = [row(F.lit(f"REGEX:{n}"), F.lit(fix), F.regexp_count(c, F.lit(p))) for n, p, fix in (("double_open", r"<<[A-Za-z0-9_]+>", "<tag>"), ("double_close", r"<[A-Za-z0-9_]+>>", "<tag>"))]
    uneven = F.transform(M.mismatches(c), lambda m: row(F.concat(F.lit("<"), m.tag, F.lit(">")), m.issue, F.lit(1)))
    found = F.concat(F.filter(F.array(*literal, *regex), lambda r: r.n > 0), uneven)
    return cells(df, key, columns).select(key, "column", F.inline(found))


def malformed_summary(rows: DataFrame, key: str) -> DataFrame:
    """Occurrences of each tag and its first suggestion by key and column, most frequent first.

    Counted by suggestion first, which takes sums and least keys only: choosing texts would have each task sort all its rows.
    """
    some = rows.groupBy("tag", "column", "suggestion").agg(F.sum("n").alias("n"), F.min(key).alias("first"))
    return some.groupBy("tag").agg(F.sum("n").cast("bigint").alias("count"), F.min_by("suggestion", F.struct("first", "column", "suggestion")).alias("suggestion"), F.min("first").alias("first")).orderBy(F.desc("count"), "tag")


def repair_statistics(summary: DataFrame) -> DataFrame:
    """Totals of what repairs itself (literals, doubled brackets, bibl) and what wants review."""
    auto = ~F.col("suggestion").startswith("Mismatch:") | (F.col("tag") == "<bibl>")
    uneven = F.col("suggestion").startswith("Mismatch:")
    return summary.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"), F.count("*").alias("unique"), F.coalesce(F.sum(F.when(auto, F.col("count"))), F.lit(0)).alias("auto_fixable"),
                       F.coalesce(F.sum(F.when(~auto, F.col("count"))), F.lit(0)).alias("manual"), F.count_if(~uneven).alias("literal_patterns"), F.count_if(uneven).alias("mismatch_patterns"))


def manual_review(rows: DataFrame) -> DataFrame:
    """C4: unequal counts of other tags than bibl, by tag and issue."""
    r = rows.filter(F.col("suggestion").startswith("Mismatch:") & (F.col("tag") != "<bibl>"))
    return r.groupBy("tag", F.col("suggestion").alias("issue")).agg(F.count("*").alias("occurrences"))


def mismatch_cells(df: DataFrame, key: str, columns: list[str], tags: list[str], preview: int = 200) -> DataFrame:
    """C4, O2: the cells with unequal counts of these tags, with a cut view, by tag and key."""
    out = cells(df, key, columns).select(key, "column", F.left("cell", F.lit(preview)).alias("preview"), F.inline(M.mismatches(F.col("cell"), tags)))
    return out.orderBy("tag", key, "column")


def repair_html(df: DataFrame, columns: list[str], encode: bool = True, anchors: bool = True, balance: bool = True) -> DataFrame:
    """Literal fixes, then bibl balance (each cell by its own counts), then entities for what is no markup, then anchors.

    Each step is a select of its own: as one expression, a step would be computed for each place where the next one names it. Raw URLs in brackets become anchors before the encoding, which would otherwise take them for text. Repairing twice changes nothing more.
    """
    def literals(c):
        return M.repair(functools.reduce(lambda t, kv: F.replace(t, F.lit(kv[0]), F.lit(kv[1])), M.LITERALS, c))
    steps = [literals, *[M.balance_bibl] * balance, *[M.anchor_raw_urls] * anchors, *[lambda c: M.encode_non_html(c, empty_too=True)] * encode]
    return functools.reduce(lambda d, step: rewrite(d, columns, step), steps, df)


def unified_report(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Malformed, non-markup and link findings in one frame; columns that a kind lacks are null."""
    c = cells(df, key, columns)
    bad = malformed_rows(df, key, columns).select(key, "column", F.col("tag").alias("item"), F.col("suggestion"), F.lit("malformed").alias("issue_type"))
    non = c.select(key, "column", F.explode(M.non_html_tags(F.col("cell"))).alias("item")).withColumn("issue_type", F.lit("non_html"))
    link = c.select(key, "column", F.inline(M.link_issues(F.col("cell")))).select(key, "column", F.col("detail").alias("item"), "opens", "closes", F.concat(F.lit("link_"), "issue").alias("issue_type"))
    return bad.unionByName(non, allowMissingColumns=True).unionByName(link, allowMissingColumns=True)


def citation_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Citations taken out of the content columns into `citations` (' | ' list) and their number. Blank cells are left as they are."""
    blank = {c: F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))) == "" for c in columns}
    found = F.concat(*[M.citations(F.col(f"`{c}`")) for c in columns])
    kept = [F.when(blank[c], F.col(f"`{c}`")).otherwise(M.without_citations(F.col(f"`{c}`"))).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns]
    return df.select(*kept, F.array_join(found, " | ").alias("citations"), F.size(found).alias("number_of_citations"))


def crossref_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same for cross-references, with the distinct types, sorted."""
    found = F.concat(*[M.crossrefs(F.col(f"`{c}`")) for c in columns])
    kept = [M.without_crossrefs(F.col(f"`{c}`")).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns]
    return df.select(*kept, F.array_join(F.transform(found, lambda x: x.text), " | ").alias("cross_references"), F.size(found).alias("number_of_cross_references"),
                     F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x.type))), ", ").alias("crossref_types"))


def append_citations(df: DataFrame, column: str) -> DataFrame:
    """Citations of one more column after those there; the counts are added."""
    more = M.citations(F.col(column))
    joined = F.concat_ws(" | ", F.nullif("citations", F.lit("")), F.nullif(F.array_join(more, " | "), F.lit("")))
    out = {"citations": joined, "number_of_citations": F.coalesce("number_of_citations", F.lit(0)) + F.size(more), column: M.without_citations(F.col(column))}
    return df.select(*[out[c].alias(c) if c in out else F.col(f"`{c}`") for c in df.columns])


def sweep_empty_p(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Empty paragraphs out of the columns that exist; the report has the changed cells of each, null for missing columns."""
    there = [c for c in columns if c in df.columns]
    after = rewrite(df, there, lambda c: F.when(c.rlike(r"(?iU)<p>\s*</p>"), M.drop_empty_p(c)).otherwise(c))
    counts = df.agg(*[F.count_if(F.col(c).rlike(r"(?iU)<p>\s*</p>")).alias(c) for c in there])
    report = counts.select(*there, *[F.lit(None).cast("bigint").alias(c) for c in columns if c not in there]).unpivot([], columns, "column", "changed")
    return after, report


def attestation_matrix(df: DataFrame, attestations: list[str], sources: list[str], exact: bool = False) -> DataFrame:
    """For each pair of an attestation and a source column the rows with a match, their share of all rows, and the matches."""
    pairs = F.array(*[F.struct(F.lit(a).alias("attestation"), F.lit(s).alias("source"), F.size(N.matched_attestations(F.col(a), F.col(s), exact)).alias("m")) for a in attestations for s in sources])
    rows = df.select(F.inline(pairs))
    return rows.groupBy("attestation", "source").agg(F.count_if(F.col("m") > 0).alias("rows_matching"), F.round(F.count_if(F.col("m") > 0) * 100.0 / F.count("*"), 2).alias("pct"), F.sum("m").cast("bigint").alias("matches"))


def multiply_by_source(df: DataFrame, key: str, sources: list[str]) -> DataFrame:
    """Rows with more than one filled source become a base row and one for each source; others stay one row."""
    filled = F.array_compact(F.array(*[F.when(F.trim(F.coalesce(F.col(f"`{s}`"), F.lit(""))) != "", F.lit(s)) for s in sources]))
    suffix = F.lower(F.replace(F.col("source"), F.lit(" "), F.lit("_")))
    parts = F.when(F.size(filled) > 1, F.concat(F.array(F.lit(None).cast("string")), filled)).otherwise(F.array(F.lit(None).cast("string")))
    rows = df.select(key, F.explode(parts).alias("source"))
    kind = F.when(F.col("source").isNull(), "base").otherwise("source")
    return rows.select(F.col(key).cast("string").alias("base_ref"), F.when(F.col("source").isNull(), F.col(key).cast("string")).otherwise(F.concat(F.col(key).cast("string"), F.lit("_"), suffix)).alias("ref"),
                       F.coalesce(F.initcap(F.replace("source", F.lit("_"), F.lit(" "))), F.lit("")).alias("source_title"), kind.alias("entry_type"))


def export_json(whp: DataFrame, idiez: DataFrame) -> DataFrame:
    """(key, json) of both tables' entries."""
    contents = {"VLM": F.col("molina"), "AND": F.col("karttunen"), "GML": F.col("carochi"), "ALM": F.col("olmos"), "NWN": F.col("lockhart")}
    themes = items(F.col("themes"), ";")
    a = whp.select(F.col("ref").alias("key"), N.export_entry(F.col("headword"), F.col("principal_english_translation"), F.lit("Classical Nahuatl"), N.authority_sources(contents, F.col("citations")), themes).alias("json"))
    fields = {"IDIEZ morfema": F.col("tlahtolli"), "IDIEZ traduc. inglés": F.col("traduc_ingles"), "IDIEZ def. náhuatl": F.col("def_nahuatl"), "IDIEZ def. español": F.col("def_espanol"), "IDIEZ morfología": F.col("morfologia"), "IDIEZ gramática": F.col("gramatica")}
    b = idiez.select(F.col("ref").alias("key"), N.export_entry(F.col("ond_node_title"), F.col("traduc_ingles"), F.lit("Huasteca Nahuatl"), N.labelled_source("IDIEZ", fields)).alias("json"))
    return a.unionByName(b)


def store_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """C14: foreign keys, allowed values and required keys over the normalised tables, as one frame of (check, key)."""
    fks = [fk_violations(tables[c], ck, tables[p], pk, f"{c}.{ck}") for c, ck, p, pk in schemas.FOREIGN_KEYS]
    allowed = [check_violations(tables[t], tables[t].columns[0], {f"{t}.{c}": F.col(c).isin(v)}).select("check", "key") for (t, c), v in schemas.ALLOWED.items()]
    return functools.reduce(DataFrame.unionByName, fks + allowed)


def import_store(tables: dict[str, DataFrame], database: str, skip_validation: bool = False) -> None:
    """C14: all tables or none: violations are looked for before the first write, and a failed write drops what was written."""
    if not skip_validation and not store_violations(tables).isEmpty():
        raise ValueError("the tables violate keys or allowed values; see store_violations")
    spark, done = next(iter(tables.values())).sparkSession, []
    try:
        for name, df in tables.items():
            done.append(name)
            df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
    except Exception:
        for name in done:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        raise


def slugs_to_tids(entry_themes: DataFrame, themes: DataFrame) -> DataFrame:
    """Theme slugs as ids; ValueError names slugs without one (at most ten are shown)."""
    j = entry_themes.join(themes.select(F.col("slug").alias("theme_slug"), F.col("tid").alias("theme_tid")), "theme_slug", "left")
    lost = [r[0] for r in j.filter("theme_tid is null").select("theme_slug").distinct().limit(10).collect()]
    if lost:
        raise ValueError(f"slugs without a theme: {lost}")
    return j


def gap_analysis(df: DataFrame, status: Column) -> DataFrame:
    """Rows and shares by status bucket (success, not_found, error for all else)."""
    bucket = F.when(status.isin("success", "not_found"), status).otherwise("error")
    counts = df.groupBy(bucket.alias("status")).agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("t")))).select("status", "n", F.round(F.col("n") * 100.0 / F.col("t"), 1).alias("pct"))
