"""Near-duplicate documents by SimHash fingerprints and Golay-code fuzzy hashing.

The fingerprint has 8 segments of 23 bits. The perfect Golay code [23, 12, 7] has for any two words that differ in up to two
bits a codeword within distance 4 of both (the word between them lies within 3 of one). So a segment's keys are the 1 or 6
codewords within distance 4 of it. A key of the search is a pair of segments' codewords, 24 bits. Errors that spread over
the segments leave, by the pigeonhole principle, some pair of segments with at most two errors each; which pairs are joined
is PAIRS. Documents under one key are compared by their whole fingerprints.
"""

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.components import components
from lexspark.llm.storage import integer_key, written
from lexspark.llm.textnp import LOWER, PUNCT, mix, pieces, span_hashes, spans, utf8

SEGMENTS, BITS = 8, 184
#: Segments that are joined in one key: all pairs within either half, so of any three segments two are joined.
PAIRS = tuple((i, j) for h in (0, 4) for i in range(h, h + 4) for j in range(i + 1, h + 4))
#: Fingerprints that differ in at most this many of the 184 bits are near duplicates.
NEAR = 33
#: Members under one key that are compared side by side with other keys' members; those of larger keys one after another.
ALL_PAIRS = 4096
#: Keys of a shard, about, and near pairs that are kept before they are joined: what a task holds at once, whatever the input and the number of partitions.
AT_ONCE, PENDING = 200_000, 500_000
#: Shards of keys for each shuffle partition; they are dealt out evenly, and a partition goes to Python as one Arrow batch, so this bounds what JVM and Python hold of it.
SPREAD = 2
#: Bytes of text and then tokens that are hashed at once (numpy takes some 50 times those bytes), and shards that are sent to the JVM at once.
TEXT, TOKENS, SENT = 1 << 20, 1 << 13, 512
#: Members that one member of a large key is compared with at once.
BLOCK = 1 << 17

_WORD = np.dtype("u8")


def fingerprints(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """184-bit SimHash of each row as three 64-bit words, and whether it has any token.

    Tokens are runs of letters and digits without case; a token counts 1 + ln(its number in the row).
    """
    low = LOWER[data]
    s, e, first = spans(low, offs, PUNCT)
    h = span_hashes(low, s, e)
    n = len(offs) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    h, row, weight = h[at], row[at], (1 + np.log(np.diff(np.append(at, len(h))))).astype(np.float32)
    total = np.zeros((n, BITS), np.float32)
    for i in range(0, len(h), TOKENS):
        part, r = h[i : i + TOKENS], row[i : i + TOKENS]
        words = np.stack([mix(part + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) for j in range(3)], 1)
        bits = np.unpackbits(words.view(np.uint8), axis=1, count=BITS).astype(np.float32)
        bits *= 2
        bits -= 1
        bits *= weight[i : i + TOKENS, None]
        begin = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        total[r[begin]] += np.add.reduceat(bits, begin, axis=0)
    out = np.zeros((n, 24), np.uint8)
    out[:, :23] = np.packbits(total > 0, axis=1)
    return out.view(_WORD), np.bincount(row, minlength=n) > 0


def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndrome of each 23-bit word's low and high part, and for each syndrome the error patterns of weight up to 4 (filled up with -1)."""
    poly = 0b101011100011

    def remainder(w: int) -> int:
        for i in range(22, 10, -1):
            if w >> i & 1:
                w ^= poly << (i - 11)
        return w

    unit = [remainder(1 << i) for i in range(23)]
    lo, hi = np.zeros(1 << 12, np.int32), np.zeros(1 << 11, np.int32)
    for i in range(12):
        lo[np.arange(1 << 12) >> i & 1 == 1] ^= unit[i]
    for i in range(11):
        hi[np.arange(1 << 11) >> i & 1 == 1] ^= unit[12 + i]
    errors = np.full((2048, 6), -1, np.int32)
    fill = np.zeros(2048, int)

    def add(w: int, syndrome: int, left: int, begin: int) -> None:
        errors[syndrome, fill[syndrome]] = w
        fill[syndrome] += 1
        if left:
            for i in range(begin, 23):
                add(w | 1 << i, syndrome ^ unit[i], left - 1, i + 1)

    add(0, 0, 4, 0)
    return lo, hi, errors


def segment_keys(words: np.ndarray, code: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Up to 6 codeword indices (the code is systematic: a codeword's high 12 bits) of each 23-bit word; -1 fills up."""
    lo, hi, errors = code
    e = errors[lo[words & 4095] ^ hi[words >> 12]]
    return np.where(e >= 0, (words[:, None] ^ e) >> 11, -1)


def segments(fp: np.ndarray) -> np.ndarray:
    """The 8 segments of 23 bits of each fingerprint."""
    bits = np.unpackbits(fp.view(np.uint8).reshape(len(fp), 24), axis=1, count=BITS).reshape(-1, SEGMENTS, 23)
    return bits.astype(np.int32) @ (1 << np.arange(22, -1, -1, dtype=np.int32))


def search_keys(fp: np.ndarray, code) -> tuple[np.ndarray, np.ndarray]:
    """Keys (pair of segments, two codewords) and the row of each."""
    seg = segments(fp)
    each = [segment_keys(seg[:, i], code) for i in range(SEGMENTS)]
    rows, keys = [], []
    for p, (i, j) in enumerate(PAIRS):
        k = np.where((each[i][:, :, None] >= 0) & (each[j][:, None, :] >= 0), each[i][:, :, None] << 12 | each[j][:, None, :], -1).reshape(len(fp), -1)
        r, c = np.nonzero(k >= 0)
        rows.append(r)
        keys.append(k[r, c] | p << 24)
    return np.concatenate(keys).astype(np.int32), np.concatenate(rows)


def apart(fp: np.ndarray, i, j) -> np.ndarray:
    n = np.bitwise_count(fp[i] ^ fp[j])
    return n[..., 0] + n[..., 1] + n[..., 2]


def joined(key: np.ndarray, doc: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """The smallest document of each one's group. Of the members (key, document), sorted by key, those under one key are compared each with each.

    Pairs that are already in one group aren't compared, and found pairs are joined before they become many.
    """
    label = np.arange(len(fp))
    left, right = [], []

    def join() -> None:
        own = np.flatnonzero(label != np.arange(len(fp)))
        nodes, roots = _forest(np.concatenate([own, *left]), np.concatenate([label[own], *right]))
        label[nodes] = roots
        left.clear()
        right.clear()

    def found(x: np.ndarray, y: np.ndarray) -> None:
        if len(x):
            left.append(x)
            right.append(y)
        if sum(map(len, left)) > PENDING:
            join()

    here = np.arange(len(key))
    begin, end = np.searchsorted(key, key, "left"), np.searchsorted(key, key, "right")
    i = here[(end - begin <= ALL_PAIRS) & (end - here > 1)]
    step = 1
    while len(i):
        x, y = doc[i], doc[i + step]
        two = label[x] != label[y]
        x, y = x[two], y[two]
        good = apart(fp, x, y) <= NEAR
        found(x[good], y[good])
        if step == 1:
            join()
        step += 1
        i = i[end[i] - i > step]
    for b in np.unique(begin[end - begin > ALL_PAIRS]):
        # a few documents with all: what is near one of many copies needs no further comparison with the others
        rest = doc[b : end[b]]
        for _ in range(64):
            if len(rest):
                near = apart(fp, rest[:1], rest) <= NEAR
                found(np.full(near.sum() - 1, rest[0]), rest[near][1:])
                rest = rest[~near]
        join()
        m = doc[b : end[b]]
        m = m[np.argsort(label[m], kind="stable")]
        group = label[m]
        past = np.searchsorted(group, group, "right")
        w = fp[m]
        for p in range(len(m)):
            for at in range(past[p], len(m), BLOCK):
                near = at + np.flatnonzero(apart(w, p, slice(at, at + BLOCK)) <= NEAR)
                if len(near):
                    one = near[np.unique(group[near], return_index=True)[1]]
                    found(np.full(len(one), m[p]), m[one])
    join()
    return label


def planes(x: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second ones, and so on."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def whole(raw: bytes, kind) -> np.ndarray:
    """The numbers that planes() took apart."""
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the edges: each node and the smallest one."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def _hashed(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    for part in pieces(batch, text, TEXT):
        fp, any_ = fingerprints(*utf8(part.column(1)))
        good = pa.array(any_)
        cols = [part.column(0).cast(pa.int64()).filter(good)] + [pa.array(fp[any_, i].view(np.int64)) for i in range(3)]
        yield pa.RecordBatch.from_arrays(cols, ["id", "f0", "f1", "f2"])


def _members(docs: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _hashed(batch, text)

    return docs.select(key, text).where(f"`{key}` is not null").mapInArrow(run, "id long, f0 long, f1 long, f2 long")


def _plan(reps: DataFrame, parts: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Partitions, and the first shard and the number of shards of each (first segment, codeword), by the numbers of their keys."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, total = golay(), np.zeros(SEGMENTS << 12, np.int64)
        for batch in batches:
            fp = np.stack([batch.column(i).to_numpy().view(np.uint64) for i in range(3)], 1)
            for at in range(0, len(fp), 4096):
                seg = segments(np.ascontiguousarray(fp[at : at + 4096]))
                each = [segment_keys(seg[:, i], code) for i in range(SEGMENTS)]
                for i in {i for i, _ in PAIRS}:
                    others = sum((each[y] >= 0).sum(1) for x, y in PAIRS if x == i)
                    r, c = np.nonzero(each[i] >= 0)
                    total += np.bincount(each[i][r, c] + (i << 12), others[r], len(total)).astype(np.int64)
        lead = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lead), pa.array(total[lead])], ["lead", "n"])

    got = reps.select("f0", "f1", "f2").mapInArrow(count, "lead long, n long").groupBy("lead").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(SEGMENTS << 12, np.int64)
    n[got["lead"].to_numpy()] = got["n"].to_numpy()
    parts = max(parts, -(-int(n.sum()) // (SPREAD * AT_ONCE)))
    most = max(1, min(AT_ONCE, int(n.sum()) // (SPREAD * parts)))
    many = np.maximum(1, -(-n // most))
    # leads with few keys share a shard
    small = np.where(many == 1, n, 0)
    shared = (np.cumsum(small) - small) // most
    own = np.where(many > 1, many, 0)
    first = np.where(many > 1, shared[-1] + 1 + np.cumsum(own) - own, shared)
    return parts, first, many


def _packed(reps: DataFrame, plan: tuple[int, np.ndarray, np.ndarray]) -> DataFrame:
    """Keys and the fingerprints that they belong to, packed by shard."""
    parts, start, many = plan

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, lead = golay(), np.array([i for i, _ in PAIRS])
        for batch in batches:
            ids = batch.column(0).to_numpy()
            fp = np.stack([batch.column(i).to_numpy().view(np.uint64) for i in (1, 2, 3)], 1)
            for at in range(0, len(ids), 4096):
                k, r = search_keys(np.ascontiguousarray(fp[at : at + 4096]), code)
                # keys with one first segment and codeword go together, so that a document's fingerprint goes there once; if they are many, by their hash
                of = lead[k >> 24] << 12 | (k >> 12 & 4095)
                shard = start[of]
                hot = np.flatnonzero(many[of] > 1)
                shard[hot] += (mix(k[hot].astype(np.uint64)) % many[of[hot]].astype(np.uint64)).astype(np.int64)
                order = np.lexsort((k, shard))
                k, r, shard = k[order], r[order], shard[order]
                begin = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(k) else np.zeros(0, np.int64)
                ends = np.append(begin[1:], len(k))
                sent, nth = np.unique(shard << 12 | r, return_inverse=True)
                first = np.searchsorted(sent >> 12, shard[begin])
                own = (nth - np.repeat(first, ends - begin)).astype(np.uint16)
                w, i = fp[at : at + 4096][sent & 4095], ids[at : at + 4096][sent & 4095]
                last = np.append(first[1:], len(sent))
                # keys as differences, and bytes of equal weight together: the shuffle's compression then finds the zeros
                difference = lambda x: planes(np.diff(x, prepend=x.dtype.type(0)))
                for c in range(0, len(begin), SENT):
                    some = slice(c, c + SENT)
                    of_keys = [pa.array([f(x[b:e]) for b, e in zip(begin[some], ends[some])], pa.binary()) for f, x in ((difference, k), (planes, own))]
                    of_documents = [pa.array([f(x[b:e]) for b, e in zip(first[some], last[some])], pa.binary()) for f, x in ((planes, i), (lambda x: x.tobytes(), w.view(np.uint8).reshape(len(w), 24)[:, :23]))]
                    yield pa.RecordBatch.from_arrays([pa.array(shard[begin[some]]), *of_keys, *of_documents], ["shard", "k", "own", "i", "w"])

    # the columns lie in one file per task: spread the key work over all cores
    spread = max(8, int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return reps.select("id", "f0", "f1", "f2").repartition(spread).mapInArrow(emit, "shard long, k binary, own binary, i binary, w binary")


def _dealt(packed: DataFrame, parts: int) -> DataFrame:
    """The packed keys in partitions that each hold the same number of shards, one shard after another."""
    return packed.repartitionById(parts, F.expr(f"int(shard % {parts})")).sortWithinPartitions("shard")


def _candidates(reps: DataFrame) -> DataFrame:
    """Edges among fingerprints' first documents: keys, packed by shard, go through one shuffle and are compared there, one shard at a time."""
    plan = _plan(reps, max(8, int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def edges(rows: list[tuple[pa.Buffer, ...]]) -> Iterator[pa.RecordBatch]:
        got = list(zip(*rows))
        k = np.concatenate([np.cumsum(whole(x, np.int32), dtype=np.int32) for x in got[0]])
        before = np.cumsum([0] + [len(x) // 8 for x in got[2]])
        own = np.concatenate([whole(x, np.uint16) + b for x, b in zip(got[1], before)])
        i = np.concatenate([whole(x, np.int64) for x in got[2]])
        w = np.zeros((len(i), 24), np.uint8)
        w[:, :23] = np.frombuffer(b"".join(got[3]), np.uint8).reshape(-1, 23)
        order = np.argsort(k, kind="stable")
        k = k[order]
        same = np.zeros(len(k), bool)  # a key with one member needs no comparison
        same[1:] = k[1:] == k[:-1]
        same[:-1] |= same[1:]
        label = joined(k[same], own[order[same]], w.view(_WORD))
        a = np.flatnonzero(label != np.arange(len(label)))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(i[a]), pa.array(i[label[a]])], ["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            # views of the batch, no copies: what is copied is one shard
            for r, shard in enumerate(batch.column(0).to_pylist()):
                if shard != at and rows:
                    yield from edges(rows)
                    rows = []
                at = shard
                rows.append(tuple(c[r].as_buffer() for c in batch.columns[1:]))
        if rows:
            yield from edges(rows)

    return _dealt(_packed(reps, plan), plan[0]).mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, duplicate_of) of each document but the first of its group; groups join documents whose fingerprints are near, directly or by way of others.

    Keys are integers (TypeError for others). The first has the smallest key. Documents without any token (null and empty texts) and rows with a null key are in no
    group. Rows that repeat a key are one document. Equal fingerprints (exact copies among them) need no search.
    """
    integer_key(docs, key)
    members = written(_members(docs, key, text), "fingerprints")
    reps = written(members.groupBy("f0", "f1", "f2").agg(F.min("id").alias("id")), "fingerprint-first")
    edges = _candidates(reps)
    equal = members.join(reps.withColumnRenamed("id", "b"), ["f0", "f1", "f2"]).where("id <> b").select(F.col("id").alias("a"), "b")
    found = components(edges.unionByName(equal))
    return found.select(F.col("node").alias(key), F.col("root").alias("duplicate_of"))


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, in all their columns, of one document of each group.

    Of rows that repeat key and text one stays, the first by its columns as JSON. Rows with a null key stay. Texts that share a
    key are documents of their own: a copy among them goes, the others stay.
    """
    names = [f"__{x}_{uuid.uuid4().hex[:8]}" for x in ("id", "own", "gone", "row")]
    own_id, shared_key, gone, first = names
    cols = docs.columns
    clash = docs.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), F.count_distinct(F.xxhash64(text)).alias("texts")).where("n > 1")
    # written, so that Spark knows their sizes: small tables of keys are broadcast and the texts don't move, large ones are not
    clash = written(clash.select(F.col(key).alias(shared_key), (F.col("texts") > 1).alias(first)), "key-clashes")
    named = docs.join(clash, F.col(key) == F.col(shared_key), "left")
    # keys that stand for several texts get ids below all others
    several = F.coalesce(F.col(first), F.lit(False))
    named = named.withColumn(own_id, F.when(several, -F.pmod(F.xxhash64(key, text), F.lit(1 << 62)) - (1 << 62)).otherwise(F.col(key).cast("long")))
    copies = near_duplicates(named.select(F.col(own_id).alias("id"), F.col(text).alias("t")), "id", "t").select(F.col("id").alias(gone))
    copies = written(copies, "copies")
    kept = named.join(copies, F.col(own_id) == F.col(gone), "left_anti")
    single = kept.where(F.col(shared_key).isNull()).select(*cols)
    again = kept.where(F.col(shared_key).isNotNull()).groupBy(key, text).agg(F.min_by(F.struct(*cols), F.to_json(F.struct(*cols))).alias(first))
    return single.unionByName(again.select(*[F.col(first)[c].alias(c) for c in cols]))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


register_pickle_by_value(sys.modules[__name__])
