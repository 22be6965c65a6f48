"""Packing round trip, permutations, draws against a plain version, and edge cases of source mixing."""

from collections import Counter

import numpy as np
import pytest

from lexspark.llm import mixing
from lexspark.llm.mixing import as_documents, mixed, pack, permuted, target_weights

WORDS = "text string, source string, lang string, n_chars long"


def docs(spark, n=300):
    rnd = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(int(rnd.integers(0, 60)))), "hot" if i % 3 else f"s{i % 4}", "en" if i % 2 else "de", i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, " + WORDS).repartition(3).cache()


def test_blocks_hold_every_token_once_in_order(spark):
    rows, df = docs(spark)
    blocks = pack(df, block=16).collect()
    want = Counter(w for _, t, s, *_ in rows for w in t.split())
    got = Counter(w for b in blocks for w in b["text"].split())
    assert got == want and all(len(b["text"].split()) == b["tokens"] <= 16 for b in blocks)
    by = {}
    for b in sorted(blocks, key=lambda b: (b["source"], b["part"], b["nth"])):
        by.setdefault((b["source"], b["part"]), []).append(b)
    assert all(x["tokens"] == 16 for run in by.values() for x in run[:-1])
    assert all(b["text"].split()[0].startswith(f"w{b['doc']}_") for b in blocks)


def test_permutations_are_permutations():
    for n in (1, 2, 3, 17, 1000):
        j = np.arange(n)
        one, two = (permuted(j, np.full(n, n), np.full(n, s, np.uint64)) for s in (1, 2))
        assert sorted(one) == sorted(two) == list(range(n)) and (n < 17 or (one != two).any())


def test_draws_as_by_the_plain_version(spark):
    _, df = docs(spark)
    weights = {"hot": 0.5, "s0": 0.3, "s3": 0.2}
    out = mixed(df, weights, block=16, slots=20, seed=4).collect()
    blocks = pack(df, block=16).collect()
    size = Counter(b["source"] for b in blocks)
    names = sorted(x for x in size if weights.get(x))
    p = np.array([weights[x] for x in names]) / sum(weights[x] for x in names)
    every = len(blocks)
    counts = {k: np.random.default_rng([4, k]).multinomial(min(20, every - k * 20), p) for k in range(-(-every // 20))}
    assert len(out) == every
    assert Counter((r["shard"], r["source"]) for r in out) == Counter({(k, names[i]): int(c) for k, v in counts.items() for i, c in enumerate(v) if c})
    # a source's blocks come all once before any comes again
    for s in names:
        use = Counter((r["epoch"], r["block"]) for r in out if r["source"] == s)
        assert max(use.values()) == 1
        total = sum(use.values())
        full, left = divmod(total, size[s])
        per = Counter(e for e, _ in use)
        assert [per[e] for e in sorted(per)] == [size[s]] * full + ([left] if left else [])
    text = {(b["source"], b["text"]) for b in blocks}
    assert {(r["source"], r["text"]) for r in out} <= text


def test_documents_keep_their_columns(spark):
    rows, df = docs(spark)
    lang = {i: x for i, _, _, x, _ in rows}
    out = as_documents(df.withColumn("rest", df["lang"]), block=16).collect()
    assert out and all(r["lang"] == r["rest"] == lang[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in out)


def test_edges(spark, monkeypatch):
    empty = spark.createDataFrame([], "doc_id long, " + WORDS)
    assert mixed(empty).collect() == [] and as_documents(empty).collect() == []
    odd = spark.createDataFrame([(None, "a b c", None, None, None), (1, None, "x", None, None), (2, "", "x", "en", 0), (3, "d " * 5000, "x", "en", 1), (3, "d " * 5000, "x", "en", 1)], "doc_id long, " + WORDS)
    out = mixed(odd, block=100).collect()
    assert len(out) == 101 and abs(sum(target_weights({None: 3, "x": 10000}).values()) - 1) < 1e-9
    numbers = spark.createDataFrame([(1, "a b", 7)], "doc_id long, text string, source int")
    assert [r["source"] for r in mixed(numbers).collect()] == ["7"]
    monkeypatch.setattr(mixing, "SOURCES", 1)
    with pytest.raises(ValueError):
        mixed(odd)
