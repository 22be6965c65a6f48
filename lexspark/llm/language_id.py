"""Language identification by rank-order n-gram profiles and out-of-place distance."""

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.textnp import pieces, utf8

#: n-grams kept in a profile, and of a document's own most frequent ones.
TOP = 300
#: Labelled documents that profiles are trained on (the bound of the training sample).
SAMPLE = 4000
#: A document is rejected whose mean distance per n-gram is at least this share of the largest one.
REJECT = 0.95


def _letters() -> np.ndarray:
    """For each code point, its lower-case letter, or a space where it is no letter."""
    out = np.full(0x110000, 32, np.int32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


_TABLE: list[np.ndarray] = []


def grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """n-gram counts (n from 1 to 3) of each row: row, index among the codes, count; the sorted codes; rows' number.

    Letters are lower-cased, other runs become one space, and each row has a space at either end. A lone space is no n-gram.
    A code holds the n-gram's characters in 21 bits each, from the left, so codes sort as the n-grams do.
    """
    if not _TABLE:
        _TABLE.append(_letters())
    n = len(offs) - 1
    cp = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    cp = _TABLE[0][cp]
    at = lead[offs]
    row = np.repeat(np.arange(n), np.diff(at))
    # a space before each row and one after it; then runs of spaces shrink to one
    seq = np.full(len(cp) + 2 * n, 32, np.int64)
    own = np.arange(len(cp)) + 2 * row + 1
    seq[own] = cp
    rows = np.repeat(np.arange(n), np.diff(at) + 2)
    keep = np.ones(len(seq), bool)
    keep[1:] = (seq[1:] != 32) | (seq[:-1] != 32) | (rows[1:] != rows[:-1])
    seq, rows = seq[keep], rows[keep]
    symbols, dense = np.unique(seq, return_inverse=True)
    base = len(symbols) + 1
    r_all, k_all = [], []
    for size in (1, 2, 3):
        if len(dense) < size:
            continue
        m = len(dense) - size + 1
        key = np.zeros(m, np.int64)
        for i in range(3):
            key = key * base + (dense[i : i + m] + 1 if i < size else 0)
        good = rows[:m] == rows[size - 1 :]
        if size == 1:
            good &= seq != 32
        else:
            # a row without letters is one space
            good &= (seq[:m] != 32) | (seq[1 : m + 1] != 32)
        r_all.append(rows[:m][good])
        k_all.append(key[good])
    r, k = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (r_all, k_all))
    if not len(k):
        return k, k, k, k, n
    if base**3 <= 1 << 23:
        there = np.zeros(base**3, bool)
        there[k] = True
        found = np.flatnonzero(there)
        index = np.cumsum(there) - 1
        k = index[k]
    else:
        found, k = np.unique(k, return_inverse=True)
    v = len(found)
    if n * v <= 1 << 24:
        count = np.bincount(r * v + k, minlength=1)
        pair = np.flatnonzero(count)
        count = count[pair]
    else:
        pair, count = np.unique(r * v + k, return_counts=True)
    chars = np.concatenate(([0], symbols))
    codes = (chars[found // (base * base)] << 42) | (chars[found // base % base] << 21) | chars[found % base]
    return pair // v, pair % v, count, codes, n


def ranked(row: np.ndarray, code: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of most frequent first within each row, equal counts by n-gram, and each one's rank from 0."""
    order = np.lexsort((code, -count, row))
    row = row[order]
    begin = np.searchsorted(row, row)
    return order, np.arange(len(row)) - begin


def distances(data: np.ndarray, offs: np.ndarray, profiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance of each row to each profile (its codes by rank, -1 as filling), and the number of n-grams compared."""
    row, k, count, codes, n = grams(data, offs)
    out = np.zeros((n, len(profiles)), np.int64)
    order, rank = ranked(row, k, count)
    top = rank < TOP
    row, k, rank = row[order][top], k[order][top], rank[top]
    for j, p in enumerate(profiles):
        place = np.full(len(codes), -1, np.int64)
        own = p[p >= 0]
        if len(codes) and len(own):
            i = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            hit = codes[i] == own
            place[i[hit]] = np.arange(len(own))[hit]
        d = np.where(place[k] >= 0, np.abs(place[k] - rank), TOP) if len(k) else k
        out[:, j] = np.bincount(row, d, n).astype(np.int64)
    return out, np.bincount(row, minlength=n)


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    for part in pieces(batch, text, 1 << 19):
        for at in range(0, part.num_rows, 512):
            yield part.slice(at, 512)


def train(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> dict[str, list[int]]:
    """Profiles: for each label the codes of its TOP most frequent n-grams, equal counts by n-gram.

    They are made from at most ``sample`` labelled documents, those first in the order of md5(key), then key. Rows without
    label or key don't count; without any labelled row there is no profile, and everything is rejected.
    """
    named = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(label).alias("l")).where("k is not null and l is not null")
    first = named.select("k", "l").withColumn("m", F.md5(F.col("k").cast("string"))).orderBy("m", "k", "l").limit(sample).select("k").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "t"):
                labels = np.array(part.column(1).to_pylist(), object)
                row, k, c, codes, _ = grams(*utf8(part.column(0)))
                for name in sorted(set(labels)):
                    own = (labels == name)[row] if len(row) else np.zeros(0, bool)
                    total = np.bincount(k[own], c[own], len(codes)).astype(np.int64)
                    hit = np.flatnonzero(total)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(hit), pa.string()), pa.array(codes[hit]), pa.array(total[hit])], ["l", "code", "n"])

    # the sample's keys are at most ``sample``, a documented bound
    chosen = named.join(F.broadcast(first), "k", "left_semi").select("t", "l")
    counts = chosen.mapInArrow(count, "l string, code long, n long").groupBy("l", "code").agg(F.sum("n").alias("n"))
    best = counts.groupBy("l").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "code"))), 1, TOP).alias("p"))
    return {r["l"]: [x["code"] for x in r["p"]] for r in best.orderBy("l").collect()}


def _judge(profiles: dict[str, list[int]], text: str):
    names = sorted(profiles)
    table = np.full((len(names), TOP), -1, np.int64)
    for i, x in enumerate(names):
        table[i, : len(profiles[x])] = profiles[x]

    def judge(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        d, n = distances(*utf8(part.column(part.schema.get_field_index(text))), table)
        if not names:
            z = np.zeros(part.num_rows, np.int64)
            return z, z, z, np.zeros(part.num_rows, bool)
        best = d.argmin(1)
        least = d[np.arange(len(d)), best]
        return best, least, n, (n > 0) & (least < REJECT * TOP * n)

    return names, judge


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, language, distance, ngrams) of each document that some profile accepts.

    The language has the smallest out-of-place distance between the document's TOP most frequent n-grams and the profile;
    equal distances go to the first name. Documents without a letter (null and empty texts too) and those as far from every
    profile as REJECT of the largest distance are rejected and not returned. Repeated rows each give a row; a null key stays.
    """
    names, judge = _judge(profiles, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, text):
                best, least, n, good = judge(part)
                lang = pa.array([names[i] for i in best[good]], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(good)), lang, pa.array(least[good]), pa.array(n[good])], [key, "language", "distance", "ngrams"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, language string, distance long, ngrams long")


def accepted(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text") -> DataFrame:
    """The rows, in all their columns, that identify() doesn't reject."""
    _, judge = _judge(profiles, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, text):
                yield part.filter(pa.array(judge(part)[3]))

    return docs.mapInArrow(run, docs.schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, train(docs))


SQL = f"""
WITH norm AS (SELECT doc_id, lang, ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}]+', ' ', 'g')) || ' ' AS s FROM documents),
pos AS (SELECT doc_id, lang, s, unnest(range(1, length(s) + 1)) AS i FROM norm WHERE s <> '  '),
g AS (SELECT doc_id, lang, unnest([substr(s, i, 1), CASE WHEN i < length(s) THEN substr(s, i, 2) END, CASE WHEN i + 1 < length(s) THEN substr(s, i, 3) END]) AS g FROM pos),
c AS (SELECT doc_id, lang, g, count(*) AS n FROM g WHERE g IS NOT NULL AND g <> ' ' GROUP BY ALL),
first AS (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL AND lang IS NOT NULL ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT {SAMPLE}),
p AS (SELECT lang AS language, g, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, g) - 1 AS r FROM c WHERE doc_id IN (SELECT doc_id FROM first) GROUP BY lang, g QUALIFY r < {TOP}),
d AS (SELECT doc_id, g, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, g) - 1 AS r FROM c QUALIFY r < {TOP}),
k AS (SELECT doc_id, count(*) AS ngrams FROM d GROUP BY doc_id),
hit AS (SELECT doc_id, language, sum(abs(d.r - p.r) - {TOP}) AS less FROM d JOIN p USING (g) GROUP BY ALL),
far AS (SELECT k.doc_id, l.language, ngrams, CAST(ngrams * {TOP} + coalesce(less, 0) AS BIGINT) AS distance FROM k CROSS JOIN (SELECT DISTINCT language FROM p) l LEFT JOIN hit ON hit.doc_id = k.doc_id AND hit.language = l.language)
SELECT doc_id, language, distance, ngrams FROM far QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY distance, language) = 1 AND distance < {REJECT} * {TOP} * ngrams
"""

register_pickle_by_value(sys.modules[__name__])
