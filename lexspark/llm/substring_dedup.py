"""Substring deduplication: Rabin-Karp hashes of all token windows, counted over the corpus, and merged into intervals."""

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.storage import integer_key
from lexspark.llm.textnp import SPACE, mix, pieces, powers, span_hashes, spans, utf8

#: Tokens of a window: a passage of at least so many that comes twice is found.
WINDOW = 50
#: Windows that a task gathers before it sends them.
GATHER = 1_000_000
#: Bytes of text whose windows a shard has, about, and windows of a packed row at most.
SHARD, ROW = 6 << 20, 256

_BASE = 0xD6E8FEB86659FD93
_INV = pow(_BASE, -1, 1 << 64)


def windows(data: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rolling hash, row and first token of each window of ``width`` tokens within a row."""
    s, e, first = spans(data, offs, SPACE)
    h = span_hashes(data, s, e)
    n = len(h) - width + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z
    # sum of h[i] * BASE ** -i; a window's sum times BASE ** (its start) is its polynomial, wherever it stands
    acc = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(_INV, len(h)), out=acc[1:])
    roll = mix((acc[width:] - acc[:-width]) * powers(_BASE, n))
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    good = row[:n] == row[width - 1 :]
    row = row[:n][good]
    return roll[good], row, np.flatnonzero(good) - first[row]


def merge(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The intervals [a, b) of each document, those that overlap or touch joined."""
    order = np.lexsort((a, doc))
    doc, a, b = doc[order], a[order], b[order]
    if not len(doc):
        return doc, a, b
    # ends that reach furthest so far, document by document
    step = np.int64(max(int(b.max()) + 1, 1))
    nth = np.cumsum(np.append(False, doc[1:] != doc[:-1]))
    far = np.maximum.accumulate(b + nth * step) - nth * step
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (a[1:] > far[:-1])
    at = np.flatnonzero(new)
    return doc[at], a[at], far[np.append(at[1:], len(doc)) - 1]


def _packed(col: np.ndarray, at: np.ndarray) -> pa.Array:
    """The column's bytes as binary values that begin at the entries ``at``; they aren't copied."""
    col = np.ascontiguousarray(col)
    offs = (np.append(at, len(col)) * col.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offs), pa.py_buffer(col)])


def _split(shard: np.ndarray, *cols: np.ndarray):
    """Rows (shard, bytes of each column's part), each of ROW entries at most."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    edge = np.append(True, shard[1:] != shard[:-1]) if len(shard) else np.zeros(0, bool)
    first = np.flatnonzero(edge)
    nth = np.arange(len(shard)) - np.repeat(first, np.diff(np.append(first, len(shard))))
    at = np.flatnonzero(nth % ROW == 0)
    return [pa.array(shard[at], pa.int64())] + [_packed(c[order], at) for c in cols]


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one shard after another; they come sorted by shard."""
    at, held = None, []
    for batch in batches:
        shard = batch.column(0).to_numpy()
        cuts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard)) if len(shard) else []
        for b, e in zip(cuts, cuts[1:]):
            if held and shard[b] != at:
                yield pa.Table.from_batches(held)
                held = []
            at = shard[b]
            held.append(batch.slice(b, e - b))
    if held:
        yield pa.Table.from_batches(held)


def unpacked(rows: pa.Table, column: int, kind: type) -> np.ndarray:
    """The numbers of a packed column, row after row; nulls have none."""
    parts = []
    for c in rows.column(column).chunks:
        if c.null_count == len(c):
            continue
        offs = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]
        if offs[-1] > offs[0]:
            parts.append(np.frombuffer(c.buffers()[2], np.uint8)[offs[0] : offs[-1]])
    return np.concatenate(parts).view(kind) if parts else np.zeros(0, kind)


_PACKED = "shard long, kind int, h binary, d binary, a binary, b binary"
_NAMES = ["shard", "kind", "h", "d", "a", "b"]


def _row(kind: int, cols: list) -> pa.RecordBatch:
    """Kind 0 has hash, document and place; kind 1 has document, start and end."""
    shard, *rest = cols
    none = [pa.nulls(len(shard), pa.binary())]
    return pa.RecordBatch.from_arrays([shard, pa.array([kind] * len(shard), pa.int32()), *(none + rest if kind else rest + none)], _NAMES)


def joined(found: DataFrame, parts: int, key: str) -> DataFrame:
    """(key, start, end) from packed intervals (kind 1): brought together by document, and merged, a shard at a time."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_shard(batches):
            d, a, b = merge(*(unpacked(rows, c, t).astype(np.int64) for c, t in ((3, np.int64), (4, np.int32), (5, np.int32))))
            for at in range(0, len(d), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000]) for x in (d, a, b)], [key, "start", "end"])

    return found.repartitionById(parts, (F.col("shard") % parts).cast("int")).sortWithinPartitions("shard").mapInArrow(join, f"`{key}` long, start long, end long")


def repeated(docs: DataFrame, width: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, end): the maximal intervals of tokens [start, end) that windows of ``width`` tokens cover which occur at least twice.

    Tokens are split at ASCII white space and numbered from 0. All occurrences are reported, the first too, also those within
    one document. Keys are integers (TypeError for others); rows with a null key are left out; null, empty and shorter texts have no window. Rows that repeat a key
    are occurrences of their own, and their intervals are joined under the key.

    Windows go once through a shuffle by hash, packed in binary columns (20 bytes a window). A window that comes again
    among those that a task gathers is sent as one entry, however often it comes, so that a passage which very many documents
    share doesn't pile up in one partition. A partition comes sorted by shard, and a task holds the windows of one shard at a
    time; shards grow in number with the text, so their size doesn't depend on ``spark.sql.shuffle.partitions``.
    """
    integer_key(docs, key)
    spark = docs.sparkSession
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    size = docs.where(f"`{key}` is not null").agg(F.sum(F.octet_length(text))).first()[0] or 0
    # as many to each partition
    shards = parts * max(1, -(-size // (SHARD * parts)))
    # intervals are far fewer than windows
    few = max(parts, shards // 8)

    def send(h: list, d: list, a: list) -> Iterator[pa.RecordBatch]:
        """Empties the lists."""
        h1 = np.concatenate(h)
        h.clear()
        order = np.argsort(h1, kind="stable")
        h1 = h1[order]
        own, at = (np.concatenate(x)[order] for x in (d, a))
        d.clear()
        a.clear()
        same = h1[1:] == h1[:-1]
        again = np.append(False, same) | np.append(same, False)
        lead = np.append(True, ~same)
        # kind 0: hash and place of a window met once, or place -1 for one met more often; kind 1: intervals known to repeat
        h0, d0, a0 = h1[lead], own[lead], np.where(again, np.int32(-1), at)[lead]
        del h1, order
        yield _row(0, _split((h0 % np.uint64(shards)).astype(np.int64), h0, d0, a0))
        del h0, d0, a0
        if again.any():
            yield intervals(own[again], at[again].astype(np.int64))

    def intervals(d: np.ndarray, a: np.ndarray) -> pa.RecordBatch:
        d, a, b = merge(d, a, a + width)
        return _row(1, _split((mix(d.astype(np.uint64)) % np.uint64(few)).astype(np.int64), d, a.astype(np.int32), b.astype(np.int32)))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, d, a, n = [], [], [], 0
        for batch in batches:
            for part in pieces(batch, text, 1 << 20):
                roll, row, at = windows(*utf8(part.column(1)), width)
                ids = part.column(0).cast(pa.int64()).to_numpy()
                h.append(roll)
                d.append(ids[row])
                a.append(at.astype(np.int32))
                n += len(roll)
                if n >= GATHER:
                    yield from send(h, d, a)
                    n = 0
        if n:
            yield from send(h, d, a)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, a, n = [], [], 0
        for rows in by_shard(batches):
            first = pa.compute.equal(rows.column(1), 0)
            known = rows.filter(pa.compute.invert(first))
            yield from known.to_batches()
            mine = rows.filter(first) if known.num_rows else rows
            h = unpacked(mine, 2, np.uint64)
            order = np.argsort(h)
            h = h[order]
            same = h[1:] == h[:-1]
            hit = order[np.append(False, same) | np.append(same, False)] if len(h) else order
            if not len(hit):
                continue
            own, at = unpacked(mine, 3, np.int64)[hit], unpacked(mine, 4, np.int32)[hit]
            d.append(own[at >= 0])
            a.append(at[at >= 0].astype(np.int64))
            n += len(d[-1])
            if n >= GATHER:
                yield intervals(np.concatenate(d), np.concatenate(a))
                d, a, n = [], [], 0
        if n:
            yield intervals(np.concatenate(d), np.concatenate(a))

    packed = docs.select(key, text).where(f"`{key}` is not null").mapInArrow(gather, _PACKED)
    found = packed.repartitionById(parts, (F.col("shard") % parts).cast("int")).sortWithinPartitions("shard").mapInArrow(count, _PACKED)
    return joined(found, parts, key)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = f"""
WITH w AS (SELECT doc_id, string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') AS w FROM documents WHERE doc_id IS NOT NULL),
x AS (SELECT doc_id, a, hash(array_to_string(w[a + 1 : a + {WINDOW}], ' ')) AS h, md5(array_to_string(w[a + 1 : a + {WINDOW}], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(0, len(w) - {WINDOW - 1})) AS a FROM w)),
r AS (SELECT doc_id, a, a + {WINDOW} AS b FROM x QUALIFY count(*) OVER (PARTITION BY h, s) > 1),
m AS (SELECT doc_id, a, b, CASE WHEN a > max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM r),
i AS (SELECT doc_id, a, b, sum(new) OVER (PARTITION BY doc_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT doc_id, min(a) AS start, max(b) AS "end" FROM i GROUP BY doc_id, island
"""

register_pickle_by_value(sys.modules[__name__])
