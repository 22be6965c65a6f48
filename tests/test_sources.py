"""Readers, writers, stored pages, trees and streams on small files."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from lexspark.operators import order, trees
from lexspark.sources import io, pages
from lexspark.streaming import resume


def test_csv_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿Ref,Headword,Unnamed: 2\nWHP-1,"<p>a\nb ""q""</p>",\n007,NA,\n,N/A,x\n', encoding="utf-8")
    df = io.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["Ref", "Headword"] and [tuple(r) for r in df.collect()] == [("WHP-1", '<p>a\nb "q"</p>'), ("007", None), (None, None)]
    (tmp_path / "b.csv").write_bytes("a,b\né’,1\n".encode("cp1252"))
    assert io.detect_encoding(spark, str(tmp_path / "b.csv")) == "windows-1252" and io.read_csv(spark, str(tmp_path / "b.csv")).first()["a"] == "é’"
    assert io.load(spark, str(tmp_path / "b.csv")).count() == 1
    with pytest.raises(ValueError):
        io.load(spark, "x", "odd")
    io.write_csv(df, str(tmp_path / "out"))
    assert sorted(map(str, io.read_csv(spark, str(tmp_path / "out"), df.schema, "UTF-8").collect())) == sorted(map(str, df.collect()))
    io.write_csv(spark.createDataFrame([("=1+1",)], "c string"), str(tmp_path / "esc"), formula_escape=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "esc")).first()[0] == "'=1+1"


def test_json_xml_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "x": "é"}, {"id": 2}]')
    assert io.read_json_array(spark, str(tmp_path / "a.json")).count() == 2
    (tmp_path / "none.json").write_text("[]")
    with pytest.raises(ValueError):
        io.read_json_array(spark, str(tmp_path / "none.json"))
    (tmp_path / "e.json").write_text(json.dumps({"metadata": {"n": 1}, "records": [{"Tamil": "t", "A": 1, "_sub_entries": [{"Toda": "x"}]}]}))
    rec = io.read_envelopes(spark, str(tmp_path / "e.json"))
    flat = trees.nodes(rec, "seq", "record").select("path", F.map_keys("fields").alias("fields")).orderBy("path").collect()
    assert [(r["path"], list(r["fields"])) for r in flat] == [([], ["Tamil", "A"]), ([0], ["Toda"])]
    (tmp_path / "x.xml").write_text('<r><entry id="e1" dia="d"><o>w</o><pos>n</pos><g><s><t><e>dog</e><h>male</h></t></s><s/></g></entry></r>')
    x = io.read_xml_entries(spark, str(tmp_path / "x.xml")).first()
    assert (x["id"], x["dialect"], x["glosses"][0][0][0]["translation"]) == ("e1", "d", "dog")
    (tmp_path / "l.txt").write_text("12\n\n# no\n abc \n7\n")
    assert [r[0] for r in io.read_lines(spark, str(tmp_path / "l.txt")).collect()] == ["12", "abc", "7"]
    assert io.read_lines(spark, str(tmp_path / "l.txt"), True).count() == 2


def test_checkpoints_and_store(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t1 LOCATION '{tmp_path}/t1'")
    spark.catalog.setCurrentDatabase("t1")
    try:
        df = spark.createDataFrame([(1, "a")], "id int, x string")
        io.save_checkpoint(df, "one", datetime.datetime(2024, 1, 1), {"empty": df.where("false"), "full": df})
        io.save_checkpoint(df.unionAll(df), "one", datetime.datetime(2024, 1, 2))
        assert io.load_checkpoint(spark, "one").count() == 2 and spark.catalog.tableExists("full_one_20240101") and not spark.catalog.tableExists("empty_one_20240101")
        with pytest.raises(ValueError):
            io.load_checkpoint(spark, "two")
        with pytest.raises(ValueError):
            io.read_table(spark, "absent")
        io.log_stage(spark, "s", "ok", 1.5, 3)
        assert spark.table("processing_log").count() == 1 and any(n == "processing_log" for n, _, _ in io.catalog(spark))
        assert "themes" in io.create_store(spark, "t2", fresh=True)
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE IF EXISTS t2 CASCADE")
        spark.sql("DROP DATABASE IF EXISTS t1 CASCADE")


def test_exports(spark, tmp_path):
    df = spark.range(25).select("id", F.concat(F.lit("w"), "id").alias("w"))
    m = io.export_batches(df, "id", str(tmp_path / "b"), 10, "x", 4).orderBy("batch").collect()
    assert [(r["entries"], r["file"]) for r in m] == [(10, "x_01_of_03_entries_1-10"), (10, "x_02_of_03_entries_11-20"), (5, "x_03_of_03_entries_21-25")]
    back = spark.read.json(str(tmp_path / "b" / "batches"))
    assert back.count() == 25 and spark.read.json(str(tmp_path / "b" / "plan_b")).where("part = 'trial'").count() == 4
    io.write_json(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"a":1}'
    assert io.write_sheets({"n" * 40: df}, str(tmp_path / "s")) == ["n" * 31]
    io.export_by(df.withColumn("k", F.col("id") % 2), "k", str(tmp_path / "k"))
    assert spark.read.option("header", True).csv(str(tmp_path / "k")).groupBy("k").count().count() == 2


def test_row_numbers_of_texts_and_empty_tables(spark):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("k"))
    got = {r["k"]: r["rn"] for r in order.with_row_number(df, "k").collect()}
    assert [got[k] for k in sorted(got)] == list(range(1, 501))
    assert order.with_row_number(df.where("false"), "k").count() == 0


ENTRY = """<html><body class="page-node-12 x"><div class="node-dictionary-entry" about="/content/atl"><div class="field field-wordorparticle"><div class="field-item"> atl </div></div>
<div class="field field-translation1"><div class="field-item"><p>water<br>x</p></div></div><div class="field-molina-x"><div class="field-item"><b>agua</b></div></div>
<div class="field-additionalnotes-lang2"><div class="field-item">nota</div></div><div class="field-themes"><a href="/themes/water">Water</a><a href="">no</a></div>
<div class="field-audio-headword"><article class="node-audio" id="node-7"></article><article class="node-audio" id="bad"></article></div></div>"""
LISTING = """<table class="views-table"><tbody><tr><td class="views-field-title"><a href="/node/5"> atl </a></td><td class="views-field-field-wordorparticle">atl</td><td class="views-field-field-head-idiez"> </td><td class="views-field-field-translation1">w</td></tr><tr><td>no link</td></tr></tbody></table>"""
RECORD = """<div class="results_record"><div><span class="fld">Tamil:</span><span class="unicode">nir</span><div class="subquery_link"><img onclick="go('q?1')"></div></div><div><span class="fld">Meaning:</span> water</div><div><span class="lang-name" data-notes="m">Oss</span><span class="unicode">don</span><sup>2</sup><div class="expandable"><div class="notes">n</div></div></div></div>"""
AUDIO = """<div class="node-audio"><h1>atl</h1><div class="field-speaker"><div class="field-item">S</div></div><a href="/f/a.wav">w</a><source src="/f/a.mp3?x=1"></div>"""


def test_pages(spark):
    def of(html):
        return spark.createDataFrame([(1, html), (2, None), (3, "<p>broken <b")], "id int, html string")
    e = {r["id"]: r for r in pages.entries(of(ENTRY), "id", "html").collect()}
    assert (e[1]["node_id"], e[1]["url_alias"], e[1]["headword"], e[1]["source_dataset"], e[1]["status"]) == (12, "/content/atl", "atl", "WHP", "success")
    assert [c["authority_name"] for c in e[1]["citations"]] == ["Molina"] and e[1]["attestations"][0]["language"] == "Spanish" and [t["theme_slug"] for t in e[1]["themes"]] == ["water"] and e[1]["audio"][0]["audio_node_id"] == 7
    assert e[2]["status"] == e[3]["status"] == "not_dictionary_entry"
    rows = pages.listing(of(LISTING), "id", "html").collect()
    assert [(r["node_id"], r["title"], r["has_translation1"], r["source_dataset"]) for r in rows] == [(5, "atl", True, "WHP")]
    rec = pages.records(of(RECORD), "id", "html").collect()
    assert rec[0]["fields"]["Tamil"] == "nir" and rec[0]["fields"]["Meaning"] == "water" and rec[0]["sub_urls"] == ["q?1"]
    cog = pages.cognates(of(RECORD), "id", "html").first()["language_entries"][0]
    assert (cog["language"], cog["language_metadata"], cog["form"], cog["reference_number"], cog["notes"]) == ("Oss", "m", "don", "2", "n")
    a = {r["id"]: r for r in pages.audio(of(AUDIO), "id", "html").collect()}
    assert (a[1]["status"], a[1]["speaker"], a[1]["file_wav"], a[1]["file_mp3"], a[2]["status"]) == ("success", "S", "/f/a.wav", "/f/a.mp3?x=1", "not_audio")
    t = {r["id"]: r for r in pages.themes(of('<body class="taxonomy-term-9"><h1>Water</h1> 12 entries'), "id", "html").collect()}
    assert (t[1]["tid"], t[1]["name"], t[1]["entry_count"], t[2]["tid"]) == (9, "Water", 12, None)


def test_trees(spark):
    record = {"_page": 1, "Meaning": "m", "Toda": "t", "Tamil": "x", "_sub_entries": [{"Tamil": "x"}, {"Notes": "no head", "_sub_entries": [{"Tamil": "lost"}]}, {"_circular_reference": True, "Tamil": "c"}, "odd"]}
    df = spark.createDataFrame([(1, json.dumps(record)), (2, None), (3, "no json"), (4, "[1]")], "id int, j string")
    tree = trees.nodes(df, "id", "j")
    assert tree.count() == 5
    heads = trees.heads_and_reflexes(tree).orderBy("ID").collect()
    assert [(r["ID"], r["Headword"], r["Parent Word ID"]) for r in heads] == [("TAM001", "x", None), ("TAM002", "x", "TAM001"), ("TAM003", "c", "TAM001"), ("TOD001", "t", "TAM001")]
    words = trees.language_entries(tree, ["Tamil"]).orderBy("path").collect()
    assert [(r["Word"], r["Meaning"]) for r in words] == [("x", "m"), ("x", "m"), ("lost", "m")]
    deep = inner = {}
    for _ in range(900):
        inner["Tamil"], inner["_sub_entries"] = "a", [{}]
        inner = inner["_sub_entries"][0]
    assert trees.nodes(spark.createDataFrame([(1, json.dumps(deep))], "id int, j string"), "id", "j").count() == 901


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    at = str(tmp_path)
    spark.range(10).withColumn("h", F.col("id") % 3).write.parquet(f"{at}/in")
    schema = spark.read.parquet(f"{at}/in").schema
    source = resume.stream_parquet(spark, f"{at}/in", schema, 1)
    resume.run_available(resume.unseen(source, "h"), resume.write_batches(f"{at}/out"), f"{at}/check")
    assert spark.read.parquet(f"{at}/out").count() == 3
    spark.range(10, 14).withColumn("h", F.col("id") % 3 + F.when(F.col("id") == 13, 5).otherwise(0)).write.mode("append").parquet(f"{at}/in")
    resume.run_available(resume.unseen(source, "h"), resume.write_batches(f"{at}/out"), f"{at}/check")
    assert spark.read.parquet(f"{at}/out").count() == 4
