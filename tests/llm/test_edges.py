"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns and string keys, for op1 and op3 to op8."""

import pytest
from pyspark.sql import functions as F

from lexspark.llm import decontaminate, edit_embedding, language_id, line_dedup, simhash, substring_dedup, suffix_dedup

LONG = " ".join(f"t{i}" for i in range(60_000))
TEXT = " ".join(f"w{i}" for i in range(80))
SCHEMA = "doc_id long, text string, lang string, source string, start int, duplicate_of int, removed string, matches int"


def docs(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", 1, 2, "r", 3) for k, t in rows], SCHEMA)


ODD = [(None, TEXT), (1, None), (2, ""), (3, "  \n "), (4, TEXT), (4, TEXT), (5, TEXT), (6, LONG), (7, LONG), (8, "unlike all others in this table")]


@pytest.mark.parametrize("op", [substring_dedup.repeated, suffix_dedup.repeated])
def test_repeated_passages(spark, op):
    assert op(docs(spark, [])).collect() == []
    got = sorted(map(tuple, op(docs(spark, ODD)).collect()))
    assert got == [(4, 0, 80), (5, 0, 80), (6, 0, 60_000), (7, 0, 60_000)]
    within = sorted(map(tuple, op(docs(spark, [(1, f"{TEXT} x {TEXT}")])).collect()))
    assert within == [(1, 0, 80), (1, 81, 161)]
    with pytest.raises(TypeError):
        op(docs(spark, ODD).withColumn("doc_id", F.col("source")))


@pytest.mark.parametrize("op", [simhash.near_duplicates, edit_embedding.near_copies])
def test_near_documents(spark, op):
    assert op(docs(spark, [])).collect() == []
    got = sorted(map(tuple, op(docs(spark, ODD)).collect()))
    assert got == [(5, 4), (7, 6)]
    with pytest.raises(TypeError):
        op(docs(spark, ODD).withColumn("doc_id", F.col("source")))


def test_a_hot_group_of_copies_is_one_group(spark):
    rows = [(i, f"{TEXT} number {i % 40} of many copies") for i in range(1500)] + [(9000 + i, f"other text {i} " * 9) for i in range(3)]
    for op in (simhash.near_duplicates, edit_embedding.near_copies):
        got = dict(map(tuple, op(docs(spark, rows)).collect()))
        assert {k: v for k, v in got.items() if k < 9000} == {i: 0 for i in range(1, 1500)}


def test_without_copies_keeps_what_is_no_copy(spark):
    rows = [(1, TEXT), (2, TEXT), (2, "another text that nothing here is like at all"), (None, TEXT), (3, None), (4, ""), (5, "one more of its own kind entirely"), (5, "one more of its own kind entirely")]
    out = simhash.without_copies(docs(spark, rows).withColumnRenamed("matches", "__gone"))
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect())
    texts = [t for _, t in got]
    assert texts.count(TEXT) == 2 and "another text that nothing here is like at all" in texts and texts.count("one more of its own kind entirely") == 1
    assert (3, "") in got and (4, "") in got and out.columns[-1] == "__gone" and len(got) == 6
    assert simhash.without_copies(docs(spark, [])).collect() == []


def test_lines(spark):
    rows = [(None, "a\nb"), (1, None), (2, "a\nb\n\na"), (3, "b \nc"), (3, "b \nc"), (4, ""), (5, "a")]
    got = sorted((r["doc_id"] or 0, r["text"] or "", r["removed"]) for r in line_dedup.dedup_lines(docs(spark, rows)).collect())
    assert got == [(0, "a\nb", 0), (1, "", 0), (2, "a\nb\n", 1), (3, "c", 1), (3, "c", 1), (4, "", 0), (5, "", 1)]
    assert line_dedup.dedup_lines(docs(spark, [])).collect() == []
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        loose = {(r["doc_id"], r["removed"]) for r in line_dedup.dedup_lines(docs(spark, [(1, "x"), (2, "y")])).collect()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert loose == {(1, 0), (2, 0)}
    named = docs(spark, [(i, f"same\nown {i}") for i in range(40)]).withColumn("doc_id", F.format_string("k%02d", "doc_id"))
    out = {r["doc_id"]: r["removed"] for r in line_dedup.dedup_lines(named).collect()}
    assert out["k00"] == 0 and all(v == 1 for k, v in out.items() if k != "k00")


def test_language(spark):
    rows = [(i, "the cat and the dog of the house " * 3) for i in range(9)] + [(None, "the cat and the dog"), (20, None), (21, ""), (22, "123 !!"), (23, LONG)]
    d = docs(spark, rows)
    profiles = language_id.train(d)
    got = {r["doc_id"] for r in language_id.identify(d, profiles).collect()}
    assert set(range(9)) | {None} <= got and not {20, 21, 22} & got
    assert language_id.accepted(docs(spark, []), profiles).collect() == [] and language_id.train(docs(spark, [])) == {}
    assert language_id.identify(d, {}).collect() == []
    adlam = "".join(chr(0x1E900 + i % 34) for i in range(60))
    other = spark.createDataFrame([(1, adlam, "ff"), (2, "the cat and the dog of it", "en")], "doc_id long, text string, lang string")
    assert {r["doc_id"]: r["language"] for r in language_id.identify(other, language_id.train(other)).collect()} == {1: "ff", 2: "en"}


def test_decontamination(spark):
    items = spark.createDataFrame([("a", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"), ("b", "quick"), (None, "unlike"), ("c", None), ("d", " ")], "item_id string, text string")
    d = docs(spark, [(1, "x alpha beta  gamma delta EPSILON zeta eta theta iota kappa lambda mu nu y"), (2, "a quick one"), (3, "quickly"), (None, "quick"), (4, None), (5, ""), (6, "quick " * 30_000)])
    got = sorted((r["doc_id"] or 0, r["item_id"], r["matches"]) for r in decontaminate.leaks(d, items).collect())
    assert got == [(0, "b", 1), (1, "a", 1), (2, "b", 1), (6, "b", 1)]
    assert sorted(r["doc_id"] for r in decontaminate.clean(d, items).collect()) == [3, 4, 5]
    assert decontaminate.leaks(docs(spark, []), items).collect() == [] and decontaminate.leaks(d, items.where("false")).collect() == []
    assert decontaminate.clean(d, items.where("false")).count() == 7
