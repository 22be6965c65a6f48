"""The pipeline and each of its stages against brute-force versions, and on odd rows."""

import __spark_entry__ as entry
import corpus_pipeline as C

import numpy as np

from lexspark.llm import language_id, simhash
from lexspark.llm.decontaminate import normal, test_strings as strings_of
from lexspark.llm.mixing import pack
from lexspark.llm.textnp import utf8

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"], r["text"] or ""))


def profile(texts):
    count = {}
    for t in texts:
        s = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in t or "").split()) + " "
        for n in (1, 2, 3):
            for i in range(len(s) - n + 1 if s.strip() else 0):
                g = s[i : i + n]
                if g != " ":
                    count[g] = count.get(g, 0) + 1
    return sorted(count, key=lambda g: (-count[g], g))[: language_id.TOP]


def test_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    # language ID
    kept = rows(C.language(spark, docs, SF))
    every = rows(docs)
    profiles = {x: profile([r["text"] for r in every if r["lang"] == x]) for x in {r["lang"] for r in every}}
    def accepted(text):
        own = profile([text])
        far = [sum(abs(i - p.index(g)) if g in p else language_id.TOP for i, g in enumerate(own)) for p in profiles.values()]
        return own and min(far) < language_id.REJECT * language_id.TOP * len(own)
    assert [r["doc_id"] for r in kept] == [r["doc_id"] for r in every if accepted(r["text"])]
    # near duplicates
    docs = spark.createDataFrame(kept, docs.schema)
    left = rows(C.near_dedup(spark, docs, SF))
    table = docs.toArrow()
    fp, any_ = simhash.fingerprints(*utf8(table["text"]))
    ids = table["doc_id"].to_numpy()
    root = ids.copy()
    for i in np.flatnonzero(any_):
        close = np.flatnonzero((simhash.apart(fp, i, np.arange(len(ids))) <= simhash.NEAR) & any_)
        joined = np.isin(root, root[close])
        root[joined] = root[joined].min()
    want = set(ids[root == ids].tolist())
    got = {r["doc_id"] for r in left}
    assert want <= got and len(got - want) <= 0.1 * len(set(ids.tolist()) - want) + 1
    # decontamination
    docs = spark.createDataFrame(left, docs.schema)
    clean = rows(C.decontamination(spark, docs, SF))
    tests = {s for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for s in strings_of(r["text"])}
    assert [r["doc_id"] for r in clean] == [r["doc_id"] for r in left if not any(s in normal(r["text"]) for s in tests)]
    # mixing: as many rows as blocks, every text a block of its source, columns of the first document
    docs = spark.createDataFrame(clean, docs.schema).coalesce(1).cache()
    blocks = {(b["source"], b["text"]) for b in pack(docs).collect()}
    out = C.mixture(spark, docs, SF)
    mix = out.collect()
    lang = {r["doc_id"]: (r["lang"], r["source"]) for r in clean}
    assert out.columns == columns and len(mix) == len(pack(docs).collect())
    assert all((r["source"], r["text"]) in blocks and (r["lang"], r["source"]) == lang[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in mix)
    # sharding: nothing lost, no key divided, no shard above its capacity unless one key alone is
    done = C.shards(spark, spark.createDataFrame(mix, out.schema), SF).collect()
    assert sorted((r["doc_id"], r["text"]) for r in done) == sorted((r["doc_id"], r["text"]) for r in mix)
    of, load = {}, {}
    for r in done:
        of.setdefault(r["doc_id"], set()).add(r["shard"])
        load[r["shard"]] = load.get(r["shard"], 0) + r["n_chars"]
    assert all(len(x) == 1 for x in of.values()) and set(load) == set(range(len(load)))
    assert all(n <= 1 << 20 or sum(s == {b} for s in of.values()) == 1 for b, n in load.items())


def test_run_goes_through_all_stages(spark):
    out = entry.queries()["pipeline"](spark, SF)
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "shard"} and out.count() > 0


def test_odd_rows_and_an_empty_table(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard string, rest int"
    english = "the cat and the dog went over the hill to see what the others of the house did " * 4
    odd = spark.createDataFrame([(None, english, None, None, None, "x", 1), (1, english, "en", "a", 9, "x", 1), (1, english, "en", "a", 9, "x", 1), (2, None, "en", "a", 0, None, None), (3, "", "en", None, 0, None, 2), (4, english * 2000, "en", "b", 5, None, 3)], schema)
    for table in (odd, odd.where("false")):
        docs = table
        for name, stage in C.STAGES:
            out = stage(spark, docs, SF)
            got = out.collect()
            if name != "sharding":
                assert out.columns == table.columns
            docs = spark.createDataFrame(got, out.schema)
        assert bool(got) == (table is odd)


def test_near_dedup_in_many_small_shards_is_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = rows(C.near_dedup(spark, docs, SF))
    monkeypatch.setattr(simhash, "AT_ONCE", 40)
    monkeypatch.setattr(simhash, "SPREAD", 64)
    assert rows(C.near_dedup(spark, docs, SF)) == want and len(want) < docs.count()
