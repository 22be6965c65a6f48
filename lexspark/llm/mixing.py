"""Mixing sources to target weights: packed blocks, multinomial counts per output shard, pseudorandom index permutations."""

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.llm.storage import written
from lexspark.llm.textnp import SPACE, mix, pieces, spans, utf8

#: Tokens of a block, slots of an output shard, exponent that tempers the sources' shares, seed.
BLOCK, SLOTS, TEMPER, SEED = 512, 1024, 0.7, 17
#: Different sources that are mixed at most.
SOURCES = 10_000


class Packer:
    """Joins one source's texts, a newline between two, and cuts them after every ``block`` tokens (words with the white space before the next).

    Blocks come out as (document in which the block starts, text, tokens); only the one that flush() gives is shorter.
    """

    def __init__(self, block: int):
        self.block, self.room, self.parts, self.doc = block, block, [], None

    def add(self, doc, raw: bytes, starts: np.ndarray):
        """``starts``: where the tokens of ``raw`` begin. A text without tokens adds nothing."""
        if not len(starts):
            return
        at, left = 0, len(starts) - self.room
        for cut in starts[self.room :: self.block].tolist():
            yield self._end(doc, raw[at:cut], self.block)
            at = cut
        if left < 0:
            self.room = -left
        else:
            self.room = self.block - left % self.block if left % self.block else 0
        self._part(doc, raw[at:])
        if not self.room:
            yield self._end(doc, b"", self.block)

    def _part(self, doc, raw: bytes) -> None:
        if not self.parts:
            self.doc = doc
        self.parts.append(raw)

    def _end(self, doc, raw: bytes, tokens: int):
        if raw or not self.parts:
            self._part(doc, raw)
        out = (self.doc, b"\n".join(self.parts), tokens)
        self.parts, self.room = [], self.block
        return out

    def flush(self):
        if self.parts:
            yield self._end(self.doc, b"", self.block - self.room)


def pack(docs: DataFrame, block: int = BLOCK, key: str = "doc_id", text: str = "text", source: str = "source", rest: tuple[str, ...] = ()) -> DataFrame:
    """(source, part, nth, doc, text, tokens): the blocks of each source within each input partition, in the rows' order; with
    ``rest`` also the first document's other columns, as a struct.

    No shuffle. Each partition's last block of a source may be shorter; nothing is left out but texts without tokens
    (null and empty ones). A null source is a source of its own, a null key stays null.
    """
    own = F.struct(F.col(key).alias("doc"), *[F.col(c) for c in rest])
    made = docs.select(own.alias("own"), F.col(text).alias("text"), F.col(source).cast("string").alias("source"))
    kind = made.schema["own"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packers: dict = {}
        nth: dict = {}

        def send(rows: list) -> pa.RecordBatch:
            cols = list(zip(*[(s, part, n, d, t, k) for s, n, (d, t, k) in rows])) or [()] * 6
            types = [pa.string(), pa.int64(), pa.int64(), ids, pa.binary(), pa.int64()]
            made = [pa.array(c, t) for c, t in zip(cols, types)]
            made[4] = made[4].cast(pa.string())
            return pa.RecordBatch.from_arrays(made, ["source", "part", "nth", "own", "text", "tokens"])

        ids = None
        for batch in batches:
            ids = batch.column(0).type
            for piece in pieces(batch, "text"):
                data, offs = utf8(piece.column(1))
                s, _, first = spans(data, offs, SPACE)
                raw, rows = data.tobytes(), []
                for i, (doc, src) in enumerate(zip(piece.column(0).to_pylist(), piece.column(2).to_pylist())):
                    for b in packers.setdefault(src, Packer(block)).add(doc, raw[offs[i] : offs[i + 1]], s[first[i] : first[i + 1]] - offs[i]):
                        rows.append((src, nth.get(src, 0), b))
                        nth[src] = nth.get(src, 0) + 1
                yield send(rows)
        if ids is not None:
            yield send([(src, nth.get(src, 0), b) for src, p in packers.items() for b in p.flush()])

    blocks = made.mapInArrow(run, f"source string, part long, nth long, own {kind}, text string, tokens long")
    return blocks.select("source", "part", "nth", F.col("own.doc").alias("doc"), "text", "tokens", *([F.struct(*[F.col("own")[c].alias(c) for c in rest]).alias("rest")] if rest else []))


def permuted(j: np.ndarray, n: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Image of each index j < n under a pseudorandom permutation of range(n) that ``seed`` picks: a four-round Feistel network, walked until it falls below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    low = (np.uint64(1) << half) - np.uint64(1)
    x, todo = j.astype(np.uint64), np.arange(len(j))
    while len(todo):
        h, m, s, y = half[todo], low[todo], seed[todo], x[todo]
        a, b = y >> h, y & m
        for r in range(4):
            a, b = b, a ^ (mix(b + s + np.uint64((r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) & m)
        x[todo] = a << h | b
        todo = todo[x[todo] >= n[todo].astype(np.uint64)]
    return x.astype(np.int64)


def target_weights(tokens: dict, temper: float = TEMPER) -> dict:
    """Shares in proportion to the sources' tokens to the power ``temper``."""
    raw = {s: n**temper for s, n in tokens.items()}
    return {s: x / sum(raw.values()) for s, x in raw.items()}


def mixed(docs: DataFrame, weights: dict | None = None, block: int = BLOCK, slots: int = SLOTS, seed: int = SEED, key: str = "doc_id", text: str = "text", source: str = "source", rest: tuple[str, ...] = ()) -> DataFrame:
    """(shard, slot, source, epoch, block, key, text, tokens): as many slots as there are blocks, drawn to the weights.

    Each output shard of ``slots`` slots (the last may have fewer) draws its number of slots of each source from a multinomial
    distribution. A source's slots, counted over all shards, are mapped by a permutation of its blocks, a new one for each
    epoch: no block comes again before all of its source have come. ``key`` is the document in which the block starts.
    ``weights`` (source: share, scaled to sum 1; sources without blocks or weight are left out) default to target_weights().
    An empty table gives no row. Blocks are numbered by the input's partitions, so the same seed gives the same mixture of the
    same files read in the same partitions; with others, one drawn alike. ValueError for more than SOURCES sources. With
    ``rest`` the first document's columns of these names come as a struct.
    """
    spark = docs.sparkSession
    blocks = written(pack(docs, block, key, text, source, rest), "blocks")
    counts = written(blocks.groupBy("source", "part").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")), "block-counts")
    # one row for each source, at most SOURCES
    rows = counts.groupBy("source").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens")).limit(SOURCES + 1).collect()
    if len(rows) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources: they are labels that weights are set for, no data")
    total = {r["source"]: (r["n"], r["tokens"]) for r in rows}
    share = weights or target_weights({s: t for s, (_, t) in total.items()})
    names = sorted((s for s in total if share.get(s, 0) > 0), key=lambda s: (s is None, s or ""))
    p = np.array([share[s] for s in names], float)
    p = p / p.sum() if len(p) else p
    size = np.array([total[s][0] for s in names], np.int64)
    every = sum(n for n, _ in total.values()) if names else 0
    shards = -(-every // slots)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, src, no = [], [], []
            for k in batch.column(0).to_pylist():
                c = np.random.default_rng([seed, k]).multinomial(min(slots, every - k * slots), p)
                hit = np.flatnonzero(c)
                at += [k] * len(hit)
                src += hit.tolist()
                no += c[hit].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (at, src, no)], ["shard", "s", "n"])

    drawn = spark.range(shards).mapInArrow(draw, "shard long, s long, n long")
    before = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    runs = drawn.select("shard", "s", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("slot"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, s, n, first, slot = (c.to_numpy() for c in batch.columns)
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            j, own = np.repeat(first, n) + nth, np.repeat(s, n)
            most = size[own] if len(own) else own
            epoch = j // most if len(own) else own
            word = mix(np.uint64(seed) + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (epoch.astype(np.uint64) << np.uint64(32)))
            at = permuted(j - epoch * most, most, word)
            out = [np.repeat(shard, n), np.repeat(slot, n) + nth, own, epoch, at]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["shard", "slot", "s", "epoch", "block"])

    picked = runs.mapInArrow(place, "shard long, slot long, s long, epoch long, block long")
    labels = spark.createDataFrame([(i, s) for i, s in enumerate(names)], "s long, source string")
    # a block's index in its source: the blocks of the partitions before its own, and its place there
    upto = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    named = counts.join(F.broadcast(labels), counts["source"].eqNullSafe(labels["source"])).select("s", labels["source"], "part", "n")
    base = named.select("s", "source", "part", "n", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    index = base.select("s", F.col("source").alias("src"), F.col("part").alias("p"), "base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i")).select("s", "src", "p", "i", (F.col("base") + F.col("i")).alias("block"))
    # both sides grow with the blocks, and nothing is known of their sizes: no broadcast
    slot = picked.join(index.hint("merge"), ["s", "block"])
    # the slots are narrow: they are hashed, and the texts, which move only here, stream past them unsorted
    here = blocks["source"].eqNullSafe(slot["src"]) & (blocks["part"] == slot["p"]) & (blocks["nth"] == slot["i"])
    both = blocks.join(slot.hint("shuffle_hash"), here)
    return both.select("shard", "slot", "source", "epoch", "block", F.col("doc").alias(key), "text", "tokens", *(["rest"] if rest else []))


def as_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture in the columns of documents: a row for each slot, with the block's text and length; key and all other columns are those of the document in which the block starts."""
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text", "source", "n_chars"))
    m = mixed(docs, rest=rest, **options)
    made = {"doc_id": F.col("doc_id"), "text": F.col("text"), "source": F.col("source"), "n_chars": F.length("text").cast("long")}
    return m.select(*[(made[f.name] if f.name in made else F.col("rest")[f.name]).cast(f.dataType).alias(f.name) for f in docs.schema])


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


register_pickle_by_value(sys.modules[__name__])
