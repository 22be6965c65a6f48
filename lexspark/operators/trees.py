"""Trees of dictionary records with dynamic keys: flattening, key census, language structure, per-language tables, heads and reflexes.

A record is JSON text whose keys are language names in a meaningful order, with children under `_sub_entries`. The tree is
walked once a record in Arrow batches (depth is unbounded, so no join a level); all else is native over the node table
(root, path, parent_path, depth, fields). Null, broken or non-object records give no node; children that are no objects are skipped.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.functions.nulls import is_blank
from lexspark.functions.text import squeeze

NODE = "root bigint, path array<int>, parent_path array<int>, depth int, fields map<string,string>, inherited string"
SUB = "_sub_entries"
EXCLUDED = set("_page _record_num _sub_entries _url _depth _content_hash _error _circular_reference Meaning Notes Miscellaneous Stems".split()) | {
    "Number in DED", "Number in CVOTGD", "Notes on correspondences", "Dialectal forms", "Additional forms", "Additional Forms", *(f"Dialectal forms ({i})" for i in (1, 2, 3, 4))}
ETYMOLOGY_FIELDS = ["Dravidian etymology", "Gondwan etymology", "South Dravidian etymology"]

#: Languages by priority as heads, with their abbreviation (two share PND).
LANGUAGES = [tuple(x.split("=", 1)) for x in """
PDR=Proto-Dravidian
PSD=Proto-South Dravidian
PND=Proto-North Dravidian
PND=Proto-North-Dravidian
PTE=Proto-Telugu
PGK=Proto-Gondi-Kui
PKG=Proto-Kolami-Gadba
PNI=Proto-Nilgiri
PKK=Proto-Kui-Kuwi
PGO=Proto-Gondi
PPM=Proto-Pengo-Manda
TAM=Tamil
MAL=Malayalam
KAN=Kannada
TEL=Telugu
TUL=Tulu
KOD=Kodagu
KOT=Kota
TOD=Toda
KON=Konda
PAR=Parji
KUI=Kui
KUR=Kurukh
KOL=Kolami
MLT=Malto
NAI=Naikri
PEN=Pengo
BRA=Brahui
KGO=Koya Gondi
KWS=Kuwi (Schulze)
KWF=Kuwi (Fitzgerald)
KWI=Kuwi (Israel)
MGO=Muria Gondi
MRG=Maria Gondi
BGO=Betul Gondi
SKW=Sunkarametta Kuwi
AGO=Adilabad Gondi
SGA=Salur Gadba
MAN=Manda
OGA=Ollari Gadba
NAK=Naiki
MGP=Mandla Gondi (Phailbus)
MGM=Maria Gondi (Mitchell)
MGW=Mandla Gondi (Williamson)
SGO=Seoni Gondi
TEK=Telugu (Krishnamurti)
KGA=Kondekor Gadba
GMG=Gommu Gondi
KKO=Kinwat Kolami
KSR=Kolami (Setumadhava Rao)
PKW=Parja Kuwi
YGO=Yeotmal Gondi
MGL=Maria Gondi (Lind)
PGA=Poya Gadba
CGO=Chindwara Gondi
KKU=Khuttia Kui
KBB=Konda (Burrow/Bhattacharya)
MGS=Maria Gondi (Smith)
KWM=Kuwi (Mahanti)
TKW=Tekriya Kuwi
ITE=Inscriptional Telugu
DGO=Durg Gondi
CHG=Chanda Gondi
DKW=Dongriya Kuwi
MDG=Mandla Gondi
IRU=Irula
MTE=Merolu Telugu
KAS=Kasaba
""".strip().splitlines()]


def _text(v) -> str | None:
    return v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)


def _walk(root: int, record: dict) -> Iterator[dict]:
    """Nodes in pre-order, by an explicit stack; `inherited` is the nearest filled Meaning of the ancestors."""
    stack = [(record, [], None)]
    while stack:
        node, path, inherited = stack.pop()
        yield {"root": root, "path": path, "parent_path": path[:-1] if path else None, "depth": len(path), "inherited": inherited,
               "fields": [(k, _text(v)) for k, v in node.items() if k != SUB]}
        own = _text(node.get("Meaning")) or inherited
        children = [c for c in node.get(SUB) or [] if isinstance(c, dict)] if isinstance(node.get(SUB), list) else []
        stack.extend((c, [*path, i], own) for i, c in reversed(list(enumerate(children))))


def nodes(records: DataFrame, key: str, text: str) -> DataFrame:
    """One row a node of each record; `key` is an integer, paths hold the child numbers from the root."""
    import pyarrow as pa

    schema = pa.schema([("root", pa.int64()), ("path", pa.list_(pa.int32())), ("parent_path", pa.list_(pa.int32())), ("depth", pa.int32()),
                        ("fields", pa.map_(pa.string(), pa.string())), ("inherited", pa.string())])

    def flat(batches):
        for b in batches:
            rows = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    record = json.loads(t) if t else None
                except ValueError:
                    record = None
                for row in _walk(k, record) if isinstance(record, dict) and k is not None else ():
                    rows.append(row)
                    if len(rows) == 10000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return records.select(F.col(key).cast("bigint"), F.col(text).cast("string")).mapInArrow(flat, NODE)


def envelope_records(files: DataFrame, column: str = "value") -> DataFrame:
    """The records of {metadata, records[]} texts, one row each, as JSON text in the key order of the file."""
    return files.select(F.posexplode(F.from_json(column, "struct<records:array<string>>").records).alias("seq", "record"))


def distinct_values(tree: DataFrame) -> DataFrame:
    """Distinct non-null values of each key, as one row a pair (a hot key is not gathered)."""
    return tree.select(F.explode("fields").alias("key", "value")).filter("value is not null").distinct()


def key_census(tree: DataFrame) -> DataFrame:
    """Occurrences of every key at every depth, and its kind."""
    keys = tree.select(F.explode(F.map_keys("fields")).alias("key"))
    kind = F.when(F.col("key").startswith("_"), "metadata").when(F.col("key").isin("Meaning", "Notes", "Number in DED"), "common").otherwise("language")
    return keys.groupBy("key").agg(F.count("*").alias("n")).withColumn("kind", kind)


def language_structure(census: DataFrame) -> DataFrame:
    """Base languages with their number and which companion fields occur (etymology too)."""
    c = census.filter(~F.col("key").isin(*EXCLUDED) & ~F.col("key").isin(*ETYMOLOGY_FIELDS))
    base = F.regexp_replace("key", " (?:meaning|derivates|etymology)$", "")
    def has(s):
        return F.bool_or(F.col("key").endswith(" " + s)).alias(f"has_{s}")
    return c.groupBy(base.alias("language")).agg(F.sum(F.when(base == F.col("key"), F.col("n")).otherwise(0)).cast("bigint").alias("count"), has("meaning"), has("derivates"), has("etymology"))


def merged_variants(structure: DataFrame) -> DataFrame:
    """Spellings that differ by hyphens are one language."""
    canon = F.trim(F.replace("language", F.lit("-"), F.lit(" ")))
    flags = [F.bool_or(f"has_{s}").alias(f"has_{s}") for s in ("meaning", "derivates", "etymology")]
    return structure.groupBy(canon.alias("canonical")).agg(F.sum("count").cast("bigint").alias("count"), *flags, F.array_join(F.array_sort(F.collect_set("language")), "; ").alias("variants"))


def _field(name: str) -> Column:
    return F.trim(F.coalesce(F.try_element_at("fields", F.lit(name)), F.lit("")))


def _first(*cs: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit(""))


def language_entries(tree: DataFrame, variants: list[str]) -> DataFrame:
    """the entries of one language under any of its spellings. Meaning: its own, else the record's, else inherited; etymology:
    its own, else the first field that ends so. Circular references are left out. Null values are blank, not 'None'."""
    word = _first(*[_field(v) for v in variants])
    any_etymology = F.get(F.filter(F.transform(F.filter(F.map_entries("fields"), lambda e: e.key.endswith(" etymology")), lambda e: F.trim(F.coalesce(e.value, F.lit("")))), lambda x: x != ""), 0)
    return tree.filter(~F.array_contains(F.map_keys("fields"), "_circular_reference") & (word != "")).select(
        "root", "path", "depth", word.alias("Word"),
        _first(*[_field(f"{v} meaning") for v in variants], _field("Meaning"), F.coalesce("inherited", F.lit(""))).alias("Meaning"),
        _first(*[_field(f"{v} derivates") for v in variants]).alias("Derivates"),
        _first(*[_field(f"{v} etymology") for v in variants], F.coalesce(any_etymology, F.lit(""))).alias("Etymology"),
        _field("Notes").alias("Notes"), _field("Number in DED").alias("Number in DED"))


def language_summary(entries: DataFrame, language: str) -> DataFrame:
    """K8: what the export of one language holds; distinct words ignore blanks."""
    return entries.agg(F.count("*").alias("entries"), F.count_distinct("Word").alias("unique_words"), F.count_if(F.col("Meaning") != "").alias("with_meaning")).select(F.lit(language).alias("language"), "*")


def _bucket(cuts: list[int]) -> Column:
    """How many of the sorted cuts are below the root, by halving."""
    def of(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col("root") > cuts[mid], of(mid + 1, hi)).otherwise(of(lo, mid))
    return of(0, len(cuts))


def heads_and_reflexes(tree: DataFrame) -> DataFrame:
    """One row for the head of each node and for each reflex, with the head of the nearest node above as parent.

    A node's head is its first language by priority with a value. Reflexes are its later languages, but for those whose (language,
    word) heads a child. A node without a head drops what is below it (as B20 says). Ids count by abbreviation in pre-order (B9).

    Nodes move once, to buckets of successive roots. All else is windows within a bucket, so that no task has all rows of an
    abbreviation: ids count on from those of the buckets before (one row a bucket and abbreviation, broadcast).
    """
    rank = F.create_map(*[x for i, (_, n) in enumerate(LANGUAGES) for x in (F.lit(n), F.lit(i))])
    abbr = F.create_map(*[F.lit(x) for a, n in LANGUAGES for x in (n, a)])
    known = F.filter(F.transform(F.map_entries("fields"), lambda e: F.struct(F.try_element_at(rank, e.key).alias("rank"), e.key.alias("language"), e.value.alias("word"))), lambda x: x.rank.isNotNull() & (F.coalesce(x.word, F.lit("")) != ""))
    filled = F.transform(F.array_sort(known), lambda x: F.struct(x.language.alias("language"), x.word.alias("word")))
    etymology = F.coalesce(*[F.when(F.map_contains_key("fields", n), F.lit(n)) for n in ETYMOLOGY_FIELDS], F.lit(""))
    n = max(2, int(tree.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    cuts = tree.agg(F.percentile_approx("root", [i / n for i in range(1, n)], 10000)).first()[0] or []
    t = tree.select(_bucket(sorted(set(cuts))).alias("__bucket"), "root", "path", "parent_path", "depth", filled.alias("langs"), etymology.alias("Etymology"), F.try_element_at("fields", F.lit("Meaning")).alias("Meaning")).repartition(n, "__bucket")
    bare = F.collect_list(F.when(F.size("langs") == 0, F.col("path"))).over(Window.partitionBy("__bucket", "root"))
    live = t.withColumn("__bare", bare).filter(~F.exists("__bare", lambda p: F.slice("path", F.lit(1), F.size(p)) == p)).drop("__bare")
    # a node stands at its own path, and again at that of the node above, which looks there for the heads below it
    at = Window.partitionBy("__bucket", "root", "__at")
    def twice(own: str, other: str, where: Column) -> Column:
        places = F.array(F.struct(F.col(own).alias("__at"), F.lit(True).alias("__own")), F.struct(F.col(other).alias("__at"), F.lit(False).alias("__own")))
        return F.inline(F.when(where, places).otherwise(F.slice(places, 1, 1)))
    below = F.collect_set(F.when(~F.col("__own"), F.col("langs")[0])).over(at)
    nodes = live.select("*", twice("path", "parent_path", F.col("parent_path").isNotNull())).withColumn("below", below).filter("__own")
    def row(pos, parent, etym, x):
        return F.struct(pos.cast("int").alias("pos"), parent.alias("above"), etym.alias("Etymology"), x.alias("l"))
    later = F.filter(F.slice("langs", F.lit(2), F.size("langs")), lambda x: ~F.array_contains("below", x))
    rows = nodes.select("__bucket", "root", "path", "depth", "Meaning", F.inline(F.concat(
        F.array(row(F.lit(0), F.col("parent_path"), F.col("Etymology"), F.col("langs")[0])), F.transform(later, lambda x, i: row(i + 1, F.col("path"), F.lit(""), x)))))
    named = rows.withColumn("abbr", F.element_at(abbr, F.col("l.language")))
    before = named.groupBy("abbr", "__bucket").count().select("abbr", "__bucket", (F.sum("count").over(Window.partitionBy("abbr").orderBy("__bucket")) - F.col("count")).alias("__before"))
    number = F.row_number().over(Window.partitionBy("__bucket", "abbr").orderBy("root", "path", "pos"))
    ids = named.withColumn("__in", number).join(F.broadcast(before), ["abbr", "__bucket"]).withColumn("ID", F.format_string("%s%03d", "abbr", F.col("__in") + F.col("__before")))
    # likewise a head stands with the rows below its node
    parent = F.max(F.when(~F.col("__own"), F.struct("ID", F.col("l.word").alias("word"), F.col("l.language").alias("language")))).over(at)
    out = ids.select("*", twice("above", "path", F.col("pos") == 0)).withColumn("__parent", parent).filter("__own")
    return out.select("root", F.col("above").alias("parent_path"), "path", "depth", "pos", "ID", F.col("l.word").alias("Headword"), F.col("l.language").alias("Language"), "Meaning", "Etymology",
                      F.col("__parent.ID").alias("Parent Word ID"), F.col("__parent.word").alias("Parent Word"), F.col("__parent.language").alias("Parent Language"))


def ancestry(df: DataFrame, key: str, parent: str, name: str) -> DataFrame:
    """Every row with its depth and the names from its root, by a recursive query; rows whose parent is missing are roots' children of none and left out."""
    df.createOrReplaceTempView("__tree")
    return df.sparkSession.sql(f"""
        WITH RECURSIVE up(id, depth, trail) AS (
            SELECT `{key}`, 0, `{name}` FROM __tree WHERE `{parent}` IS NULL
            UNION ALL
            SELECT t.`{key}`, up.depth + 1, concat(up.trail, ' > ', t.`{name}`) FROM __tree t JOIN up ON t.`{parent}` = up.id)
        SELECT id, depth, trail FROM up""")


def prefix_plan(words: DataFrame, word: str, limit: int = 200, alphabet: str = "abcdefghijklmnopqrstuvwxyz", deepest: int = 8) -> DataFrame:
    """The shortest prefixes that have fewer than `limit` words each, with their number; words that a split loses (equal to the
    prefix, or going on outside the alphabet) get the kind 'rest' with the prefix that was split, so that none is lost. Lower case.
    Prefixes of `deepest` letters aren't split any more."""
    w = words.select(F.lower(squeeze(F.col(word))).alias("w")).filter(~is_blank(F.col("w")))
    per = w.groupBy("w").agg(F.count("*").alias("n"))
    cuts = per.select("w", "n", F.explode(F.sequence(F.lit(1), F.least(F.length("w"), F.lit(deepest)))).alias("len")).select(F.left("w", F.col("len")).alias("prefix"), "len", "n")
    sizes = cuts.groupBy("prefix", "len").agg(F.sum("n").alias("n"))
    full = sizes.filter((F.col("n") >= limit) & (F.col("len") < deepest)).select("prefix")
    ok = sizes.filter((F.col("n") < limit) | (F.col("len") == deepest)).withColumn("above", F.left("prefix", F.col("len") - 1))
    inside = ok.filter(F.right("prefix", F.lit(1)).isin(*alphabet))
    kept = inside.filter("len = 1").select("prefix", "n").unionByName(inside.join(full.select(F.col("prefix").alias("above")), "above", "left_semi").select("prefix", "n"))
    below = sizes.filter(F.right("prefix", F.lit(1)).isin(*alphabet)).groupBy(F.left("prefix", F.col("len") - 1).alias("prefix")).agg(F.sum("n").alias("below"))
    rest = sizes.join(full, "prefix", "left_semi").join(below, "prefix", "left").select("prefix", (F.col("n") - F.coalesce("below", F.lit(0))).alias("n")).filter("n > 0")
    return kept.withColumn("kind", F.lit("prefix")).unionByName(rest.withColumn("kind", F.lit("rest")))


register_pickle_by_value(sys.modules[__name__])
