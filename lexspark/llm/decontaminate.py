"""Benchmark decontamination by Wu-Manber multi-pattern search."""

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

#: Words in a test string; an item with fewer words is one test string as a whole.
WORDS = 13
#: Characters of a block of the shift table, and of the prefix that tells strings of one suffix apart.
BLOCK, HEAD = 6, 4
#: Lengths from which test strings are of the next class.
SHORT = (10, 32)
#: Bytes of test strings that one scan of the documents searches at once; more are searched in further scans.
SCAN_BYTES = 64 << 20


def normal(text: str | None) -> str:
    """Lower case, white space as one space, and a space at either end."""
    return " " + " ".join((text or "").lower().split()) + " "


def test_strings(item: str | None, words: int = WORDS) -> list[str]:
    """All runs of ``words`` words of an item, or the whole item if it is shorter; none if it has no word. A space is at either end."""
    w = (item or "").lower().split()
    return [" " + " ".join(w[i : i + words]) + " " for i in range(max(1, len(w) - words + 1))] if w else []


class WuManber:
    """Finds which of the strings occur in a text.

    The search window is as long as the shortest string (Finder makes a search for each class of lengths). The block that ends it tells from ``shift`` how far the window can
    move without missing a string; where it can't, ``bucket`` names the strings whose window ends in that block, their first
    characters are compared, and then the whole strings.
    """

    def __init__(self, strings: list[str]):
        self.strings = sorted(set(strings))
        self.window = m = min(map(len, self.strings), default=0)
        self.block = b = max(1, min(BLOCK, m))
        self.shift: dict[str, int] = {}
        self.bucket: dict[str, list[tuple[str, int]]] = {}
        for i, s in enumerate(self.strings):
            for at in range(b, m + 1):
                block = s[at - b : at]
                self.shift[block] = min(self.shift.get(block, m), m - at)
            self.bucket.setdefault(s[m - b : m], []).append((s[: min(HEAD, m)], i))

    def find(self, text: str) -> set[int]:
        """Indices into ``strings`` of those that occur, overlapping ones too."""
        found: set[int] = set()
        m, b, n = self.window, self.block, len(text)
        if not m:
            return found
        shift, free, bucket, strings = self.shift.get, m - b + 1, self.bucket, self.strings
        end = m
        while end <= n:
            block = text[end - b : end]
            far = shift(block, free)
            if far:
                end += far
                continue
            at = end - m
            for head, i in bucket[block]:
                if text.startswith(head, at) and i not in found and text.startswith(strings[i], at):
                    found.add(i)
            end += 1
        return found


class Finder:
    """A search for each class of lengths, so that one short string doesn't shorten the window of all others."""

    def __init__(self, strings: list[str]):
        self.strings = sorted(set(strings))
        classes: list[list[int]] = [[], [], []]
        for i, s in enumerate(self.strings):
            classes[(len(s) >= SHORT[0]) + (len(s) >= SHORT[1])].append(i)
        self.parts = [(ids, WuManber([self.strings[i] for i in ids])) for ids in classes if ids]

    def find(self, text: str) -> set[int]:
        return {ids[i] for ids, part in self.parts for i in part.find(text)}

    def any(self, text: str) -> bool:
        return any(part.find(text) for _, part in self.parts)


def _items(benchmark: DataFrame, item: str, text: str) -> Iterator[tuple[dict[str, list[int]], int]]:
    """Test strings and the items that have them, in portions of about SCAN_BYTES, read from the table in order of items; none is divided."""
    owners: dict[str, list[int]] = {}
    size, last = 0, None
    for row in benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).where("i is not null and t is not null").orderBy("i").toLocalIterator():
        if size > SCAN_BYTES and row[0] != last:
            yield owners, size
            owners, size = {}, 0
        last = row[0]
        for s in set(test_strings(row[1])):
            size += len(s)
            owners.setdefault(s, []).append(row[0])
    yield owners, size


def _search(docs: DataFrame, owners: dict[str, list], key: str, text: str, item: str, kind: DataType) -> DataFrame:
    shared, arrow = docs.sparkSession.sparkContext.broadcast(owners), to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(list(shared.value))
        for batch in batches:
            at, it, no = [], [], []
            for row, value in enumerate(batch.column(1)):
                hits: dict[int, int] = {}
                for i in finder.find(normal(value.as_py())):
                    for x in set(shared.value[finder.strings[i]]):
                        hits[x] = hits.get(x, 0) + 1
                at += [row] * len(hits)
                it += hits
                no += hits.values()
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(it, arrow), pa.array(no, pa.int64())], ["k", "i", "matches"])

    found = docs.select(key, text).mapInArrow(run, f"k {docs.schema[key].dataType.simpleString()}, i {kind.simpleString()}, matches long")
    return found.select(F.col("k").alias(key), F.col("i").alias(item), "matches")


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item, matches): how many different test strings of the item the document has.

    Both sides are compared in lower case with white space as one space, at words' ends. Null and empty items give no test
    strings, null and empty documents no row; rows that repeat a document each give their rows, with null keys too. An item
    that comes twice counts once. An empty benchmark gives no row.
    """
    out = None
    for owners, _ in _items(benchmark, item, item_text):
        found = _search(docs, owners, key, text, item, benchmark.schema[item].dataType)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows, in all their columns, in which no test string of the benchmark occurs."""
    out = docs
    for owners, _ in _items(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(list(owners))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = Finder(shared.value)
            for batch in batches:
                col = batch.column(batch.schema.get_field_index(text))
                yield batch.filter(pa.array([not finder.any(normal(x.as_py())) for x in col], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = f"""
WITH w AS (SELECT item_id, string_split(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ') AS w FROM benchmark WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''),
s AS (SELECT DISTINCT item_id, ' ' || array_to_string(w[i + 1 : i + {WORDS}], ' ') || ' ' AS s FROM (SELECT item_id, w, unnest(range(0, greatest(1, len(w) - {WORDS - 1}))) AS i FROM w)),
d AS (SELECT doc_id, ' ' || trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) || ' ' AS t FROM documents)
SELECT doc_id, item_id, count(*) AS matches FROM d JOIN s ON contains(t, s) GROUP BY doc_id, item_id
"""

register_pickle_by_value(sys.modules[__name__])
