"""Decontamination in several scans."""

from lexspark.llm import decontaminate


def test_an_item_with_rows_far_apart_counts_once_in_several_scans(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three and four five six and nine ten")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "one two three"), (8, "nine ten"), (7, "four five six"), (7, "one two three")], "item_id long, text string").coalesce(1)
    want = [(1, 7, 2), (1, 8, 1)]
    assert sorted(map(tuple, decontaminate.leaks(docs, items).collect())) == want
    monkeypatch.setattr(decontaminate, "SCAN_BYTES", 1)
    assert sorted(map(tuple, decontaminate.leaks(docs, items).collect())) == want
