"""Toxicity: the kernel against its definition, held-out labels, disguised forms, edge cases."""

import itertools

import numpy as np
import pyarrow as pa
import pytest

from lexspark.llm import toxicity as T
from lexspark.llm.textnp import utf8

SF = "/root/testdata/sf0.1"


def plain(a: bytes, b: bytes) -> float:
    total = 0.0
    for i in itertools.combinations(range(len(a)), T.ORDER):
        for j in itertools.combinations(range(len(b)), T.ORDER):
            if all(a[x] == b[y] for x, y in zip(i, j)):
                total += T.DECAY ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


def test_kernel_is_the_sum_over_common_subsequences():
    rnd = np.random.default_rng(1)
    words = [bytes(rnd.integers(97, 101, int(rnd.integers(1, 9))).astype(np.uint8)) for _ in range(60)]
    marks = [bytes(rnd.integers(97, 101, 6).astype(np.uint8)) for _ in range(60)]
    text, size = T.table(words, 0)
    got = T.string_kernel(text, size, T.table(marks, 255)[0])
    assert np.allclose(got, [plain(a, b) for a, b in zip(words, marks)], rtol=1e-4)


@pytest.fixture(scope="module")
def fitted():
    rnd = np.random.default_rng(7)
    bad = ["scumbag", "wretch", "numbskull", "blockhead", "nitwit", "vermin"]
    stem = ["ba", "lo", "mi", "te", "sur", "na", "ke", "ro", "pi", "dus"]
    def sentence():
        return " ".join("".join(rnd.choice(stem, rnd.integers(1, 4))) for _ in range(rnd.integers(4, 12))) + "."
    texts, toxic = [], []
    for i in range(900):
        t = [sentence() for _ in range(6)]
        if i % 6 == 0:
            t[int(rnd.integers(6))] = f"lo na {rnd.choice(bad)} ro mi."
        texts.append(" ".join(t))
        toxic.append(int(i % 6 == 0))
    return T.fit(texts[:700], np.array(toxic[:700])), texts[700:], np.array(toxic[700:]), bad


def score(model, texts):
    k = T.Kernel(model.marks, model.weights, model.bias, model.allow)
    w = T.windows(*utf8(pa.array(texts, pa.string())))
    out = np.full(len(texts), -np.inf)
    np.maximum.at(out, w.row, k.scores(w))
    return out


def test_held_out_documents(fitted):
    model, texts, toxic, _ = fitted
    got = score(model, texts) > 0
    assert (got & (toxic > 0)).sum() >= 0.95 * (toxic > 0).sum() and not (got & (toxic == 0)).any()


@pytest.mark.parametrize("name, form", [("plain", lambda x: x), ("upper", str.upper), ("dotted", ".".join), ("spaced", " ".join), ("inserted", lambda x: x[:3] + "z" + x[3:]), ("two inserted", lambda x: x[:2] + "z" + x[2:4] + "f" + x[4:]),
                                        ("split", lambda x: x[:4] + " " + x[4:]), ("dash", lambda x: x[:4] + " - " + x[4:]), ("accents", lambda x: x.translate(str.maketrans("aeiou", "áéíóú"))), ("digits", lambda x: x.replace("i", "1").replace("e", "3"))])
def test_disguised_insults(fitted, name, form):
    model, _, _, bad = fitted
    found = score(model, [f"Lo na {form(x)} ro mi." for x in bad]) > 0
    assert found.sum() >= len(bad) - 1, (name, [x for x, f in zip(bad, found) if not f])


def test_a_gap_does_not_cross_sentences(fitted):
    model, _, _, bad = fitted
    assert (score(model, [f"Lo na {x[:3]}. {x[3:]} ro." for x in bad if x != "nitwit"]) <= 0).all()


def test_held_out_labels_of_the_driver(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = T.train(docs, labels)
    found = {r["doc_id"] for r in T.toxic_documents(docs, model).collect()}
    first = {r["k"] for r in labels.selectExpr("doc_id k", "md5(string(doc_id)) m").orderBy("m", "k").limit(T.SAMPLE).collect()}
    rest = [(r["doc_id"], r["toxic"]) for r in labels.collect() if r["doc_id"] not in first]
    bad, good = [d for d, t in rest if t], [d for d, t in rest if not t]
    assert sum(d in found for d in bad) >= 0.8 * len(bad) and sum(d in found for d in good) <= 0.02 * len(good)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "you scum.", 1), (4, "x" * 200_000, 1), (5, "scum " * 50_000, 1), (5, "scum", 1)], "doc_id long, text string, score int")
    none = T.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert none.marks == [] and T.toxic_documents(docs, none).collect() == []
    one = T.train(docs, spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id long, toxic int"))
    assert one.marks == []
    model = T.Model([b"scum"], np.array([2.0], np.float32), -1.0, np.ones((3, 1), bool))
    assert sorted((r["doc_id"] or 0) for r in T.toxic_documents(docs, model).collect()) == [0, 5, 5]
    assert T.toxic_documents(docs.where("false"), model).collect() == []
    named = T.toxic_documents(docs.withColumnRenamed("doc_id", "id"), model, key="id")
    assert named.columns == ["id", "score"]
