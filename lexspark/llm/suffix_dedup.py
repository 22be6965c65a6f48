"""Repeated passages by a logarithmic family of suffix arrays.

Token windows that are equal have the same smallest 4-gram hash, so runs of windows with one such hash go, as a stretch of
tokens, to the shard that the hash names: equal windows meet in one shard, and a shard needs no other text. There the batches
come one after another. Each gets a suffix array (of the suffixes at window starts, to the depth of a window), is merged with
the existing levels' arrays, where neighbours that agree over the whole depth are long matches, and becomes a level; two
levels of one size become one of the next.
"""

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession

from lexspark.llm import substring_dedup
from lexspark.llm.substring_dedup import _NAMES, _PACKED, _row, _split, joined, merge
from lexspark.llm.storage import integer_key
from lexspark.llm.textnp import SPACE, mix, pieces, powers, span_hashes, spans, utf8

#: Tokens of a match; tokens of the n-grams that name shards; batches; shards for each shuffle partition; windows that a task gathers.
WINDOW, GRAM, BATCHES, SPREAD, GATHER = 50, 4, 4, 8, 1_000_000

_BASE = 0xD6E8FEB86659FD93
_INV = pow(_BASE, -1, 1 << 64)


@dataclass
class Index:
    """A suffix array: ``text`` (tokens), ``start`` (suffixes in order), and the place in the batch's window list of each."""

    text: np.ndarray
    start: np.ndarray
    window: np.ndarray


def suffix_sort(text: np.ndarray, start: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes by their first ``depth`` tokens, and which of them agree over that depth with another.

    Two tokens are compared at a time; only suffixes that are still tied with a neighbour are looked at again.
    """
    n = len(start)
    wide = text.astype(np.uint64)

    def word(at: np.ndarray, j: int) -> np.ndarray:
        first = wide[at + j] << np.uint64(32)
        return first | wide[at + j + 1] if j + 1 < depth else first

    order = np.argsort(word(start, 0), kind="stable")
    key = word(start[order], 0)
    tied = np.zeros(n, bool)
    same = key[1:] == key[:-1]
    slot = np.flatnonzero(np.append(same, False) | np.append(False, same))  # places in the order that are tied
    group = np.cumsum(np.append(True, ~same))[slot] if n else slot
    for j in range(2, depth, 2):
        if not len(slot):
            break
        own = order[slot]
        key = word(start[own], j)
        by = np.lexsort((key, group))
        own, key, group = own[by], key[by], group[by]
        order[slot] = own
        same = (group[1:] == group[:-1]) & (key[1:] == key[:-1])
        keep = np.append(same, False) | np.append(False, same)
        group = np.cumsum(np.append(True, ~same))[keep]
        slot = slot[keep]
    tied[slot] = True
    return order, tied


def built(text: np.ndarray, start: np.ndarray, window: np.ndarray, depth: int) -> tuple[Index, np.ndarray]:
    """The index of a batch, and the windows that repeat within it."""
    order, tied = suffix_sort(text, start, depth)
    return Index(text, start[order], window[order]), window[order[tied]]


def merged(a: Index, b: Index, depth: int) -> tuple[Index, np.ndarray]:
    """Both indexes as one, and the windows that agree with another. Merging two sorted runs is what the stable sort does first."""
    return built(np.concatenate([a.text, b.text]), np.concatenate([a.start, b.start + len(a.text)]), np.concatenate([a.window, b.window]), depth)


class Family:
    """Levels of suffix arrays; level i holds at most one, of 2 ** i batches."""

    def __init__(self, depth: int):
        self.depth = depth
        self.levels: list[Index | None] = []
        self.hits: list[np.ndarray] = []

    def add(self, text: np.ndarray, start: np.ndarray, window: np.ndarray) -> None:
        """Indexes a batch, and notes the windows (by number) that match one of the batch or of a level."""
        own, hits = built(text, start, window, self.depth)
        self.hits.append(hits)
        up = next((i for i, x in enumerate(self.levels) if x is None), len(self.levels))
        # levels below the first free one are merged into the batch; those above are only scanned
        for level in self.levels[up + 1 :]:
            if level is not None:
                self.hits.append(merged(level, own, self.depth)[1])
        for i in range(up):
            own, hits = merged(self.levels[i], own, self.depth)
            self.hits.append(hits)
            self.levels[i] = None
        if up == len(self.levels):
            self.levels.append(None)
        self.levels[up] = own


def runs(data: np.ndarray, offs: np.ndarray, width: int):
    """Tokens, and of each run of windows with one smallest n-gram hash: that hash, the row, its first token and its number of tokens."""
    s, e, first = spans(data, offs, SPACE)
    h = span_hashes(data, s, e)
    n = len(h) - width + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return h, z.astype(np.uint64), z, z, z
    acc = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(_INV, len(h)), out=acc[1:])
    gram = mix((acc[GRAM:] - acc[:-GRAM]) * powers(_BASE, len(h) - GRAM + 1))
    span, low, wide = width - GRAM + 1, gram, 1
    while wide * 2 <= span:
        low = np.minimum(low[:-wide], low[wide:])
        wide *= 2
    low = np.minimum(low[:n], low[span - wide :][:n])
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    good = np.flatnonzero(row[:n] == row[width - 1 :])
    low, row = low[good], row[good]
    new = np.ones(len(good), bool)
    new[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(good)))
    return h, low[at], row[at], good[at], count + width - 1


def repeated(docs: DataFrame, width: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, end): the maximal intervals of tokens [start, end) covered by matches of at least ``width`` tokens with another place of the corpus.

    Tokens are split at ASCII white space and numbered from 0; they are compared by 32 bits of a hash each. Both places of a
    match are reported, also within one document. Keys are integers (TypeError for others); rows with a null key are left out; null, empty and shorter texts have no
    match. Rows that repeat a key are places of their own, and their intervals are joined under the key. A stretch that comes
    again among those that a task gathers is sent once, so a passage which very many documents share doesn't pile up.
    """
    integer_key(docs, key)
    spark = docs.sparkSession
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shards = parts * SPREAD
    if width < 2 * GRAM:
        raise ValueError(f"a match has at least {2 * GRAM} tokens")

    def send(got: list) -> Iterator[pa.RecordBatch]:
        token, low, doc, at, begin, size = (np.concatenate(x) for x in zip(*got))
        acc = np.zeros(len(token) + 1, np.uint64)
        np.cumsum(token * powers(_INV, len(token)), out=acc[1:])
        name = mix((acc[begin + size] - acc[begin]) * powers(_BASE, len(token) + 1)[begin] + size.astype(np.uint64))
        _, lead, index, times = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
        again = times[index] > 1
        if again.any():
            d, a, b = merge(doc[again], at[again], (at + size)[again])
            yield _row(1, _split((mix(d.astype(np.uint64)) % np.uint64(parts)).astype(np.int64), d, a.astype(np.int32), b.astype(np.int32)))
        at = np.where(again, -1, at)
        shard = (low % np.uint64(shards)).astype(np.int64)
        lead = lead[np.argsort(shard[lead], kind="stable")]
        pack = zstandard.ZstdCompressor(level=1)
        batch = TaskContext.get().partitionId() % BATCHES
        token = token.astype(np.uint32)
        edges = np.flatnonzero(np.append(True, np.diff(shard[lead]) != 0))
        out = []
        for x, y in zip(edges, np.append(edges[1:], len(lead))):
            own = lead[x:y]
            place = np.repeat(begin[own] - (np.cumsum(size[own]) - size[own]), size[own]) + np.arange(size[own].sum())
            out.append((shard[own[0]], pack.compress(token[place].tobytes()), doc[own].tobytes(), at[own].astype(np.int32).tobytes(), size[own].astype(np.int32).tobytes()))
        cols = list(zip(*out))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array([2 + batch] * len(out), pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], _NAMES)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, n, base = [], 0, 0
        for batch in batches:
            for part in pieces(batch, text):
                data, offs = utf8(part.column(1))
                token, low, row, begin, size = runs(data, offs, width)
                if not len(low):
                    continue
                _, _, first = spans(data, offs, SPACE)
                ids = part.column(0).cast(pa.int64()).to_numpy()
                got.append((token, low, ids[row], begin - first[row], begin + base, size))
                base += len(token)
                n += len(token)
                if n >= GATHER:
                    yield from send(got)
                    got, n, base = [], 0, 0
        if got:
            yield from send(got)

    def match(shard: list) -> Iterator[pa.RecordBatch]:
        """The windows of one shard that match, batch after batch."""
        open_ = zstandard.ZstdDecompressor()
        family, docs_, places = Family(width), [], []
        count = 0
        for number in sorted({x[0] for x in shard}):
            rows = [x for x in shard if x[0] == number]
            token = np.concatenate([np.frombuffer(open_.decompress(x[1]), np.uint32) for x in rows])
            d, a, z = (np.concatenate([np.frombuffer(x[i], t) for x in rows]) for i, t in ((2, np.int64), (3, np.int32), (4, np.int32)))
            begin = np.cumsum(z) - z
            n = z - width + 1
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            family.add(token, np.repeat(begin, n) + nth, count + np.arange(n.sum()))
            count += int(n.sum())
            docs_.append(np.repeat(d, n))
            places.append(np.where(np.repeat(a, n) < 0, -1, np.repeat(a, n) + nth))
        hit = np.unique(np.concatenate(family.hits))
        d, a = np.concatenate(docs_)[hit], np.concatenate(places)[hit]
        d, a = d[a >= 0], a[a >= 0]
        if len(d):
            d, a, b = merge(d, a, a + width)
            yield _row(1, _split((mix(d.astype(np.uint64)) % np.uint64(parts)).astype(np.int64), d, a.astype(np.int32), b.astype(np.int32)))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list] = {}
        for batch in batches:
            known = pa.compute.equal(batch.column(1), 1)
            yield batch.filter(known)
            rest = batch.filter(pa.compute.invert(known))
            for s, *x in zip(*(c.to_pylist() for c in rest.columns)):
                by.setdefault(s, []).append(x)
        for s in sorted(by):
            yield from match(by.pop(s))

    packed = docs.select(key, text).where(f"`{key}` is not null").mapInArrow(gather, _PACKED)
    return joined(packed.repartition(parts, "shard").mapInArrow(index, _PACKED), parts, key)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: A match of WINDOW tokens or more is a run of windows that occur at least twice.
SQL = substring_dedup.SQL

register_pickle_by_value(sys.modules[__name__])
