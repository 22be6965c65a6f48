"""Readers and writers: CSV as text, encodings, JSON, XML, line lists, checkpoints, logs, batched and partitioned exports."""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lexspark import schemas
from lexspark.functions.nulls import NA_TOKENS, null_tokens
from lexspark.functions.text import resolve_column
from lexspark.operators.order import batch_manifest, batches

XML_ENTRY = "_id string, _dia string, o string, pos string, g array<struct<s:array<struct<t:array<struct<e:string,h:string>>>>>>"


def detect_encoding(spark: SparkSession, path: str) -> str:
    """By the first 10 KB of the first file: a byte-order mark, else UTF-8 if valid, else Windows-1252."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    head = bytes(b & 255 for b in stream.readNBytes(10240))
    stream.close()
    for mark, name in ((b"\xff\xfe", "UTF-16LE"), (b"\xfe\xff", "UTF-16BE")):
        if head.startswith(mark):
            return name
    try:
        head.decode("utf-8-sig")
    except UnicodeDecodeError as e:
        if len(head) < 10240 or e.start < len(head) - 4:
            return "windows-1252"
    return "UTF-8"


#: Windows-1252 is read as Latin-1, which Spark has, and its own characters are put in afterwards.
_WINDOWS = [(chr(b), bytes([b]).decode("cp1252")) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]


def _charset(encoding: str) -> str:
    return "ISO-8859-1" if encoding == "windows-1252" else encoding


def csv_columns(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[str]:
    """The header alone."""
    return spark.read.option("header", True).option("multiLine", True).option("encoding", _charset(encoding)).option("escape", '"').csv(path).columns


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, encoding: str | None = None) -> DataFrame:
    """All columns as text (or the declared schema), quoted cells over several lines, NA tokens as null.

    Columns named _c… or 'Unnamed…' without a header are dropped (P2).
    """
    enc = encoding or detect_encoding(spark, path)
    r = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", _charset(enc))
    if schema is not None:
        return r.option("nullValue", "").schema(schema).csv(path)
    names = csv_columns(spark, path, enc)
    df = r.schema(StructType([StructField(n, StringType()) for n in names])).csv(path)
    if enc == "windows-1252":
        bad, good = ("".join(x) for x in zip(*_WINDOWS))
        df = df.select(*[F.translate(F.col(f"`{n}`"), bad, good).alias(n) for n in names])
    df = null_tokens(df)
    return df.select(*[F.col(f"`{n}`") for n in names if not n.startswith(("Unnamed", "_c"))])


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table; ValueError if it isn't there."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"no table {name}")
    return spark.table(name)


def load(spark: SparkSession, source: str, kind: str = "auto") -> DataFrame:
    """By the suffix, or by the kind named; ValueError for an unknown kind."""
    suffix = source.rsplit(".", 1)[-1].lower()
    kind = {"csv": "csv", "json": "json", "parquet": "parquet", "xml": "xml"}.get(suffix, "table") if kind == "auto" else kind
    readers = {"csv": read_csv, "json": read_json_array, "parquet": lambda s, p: s.read.parquet(p), "xml": read_xml_entries, "table": read_table}
    if kind not in readers:
        raise ValueError(f"unknown source type {kind}")
    return readers[kind](spark, source)


def select_where(df: DataFrame, columns: list[str], where: str | None = None, limit: int | None = None) -> DataFrame:
    """Projection (names resolved past apostrophes and case), an optional predicate and an optional limit, all pushed to the scan."""
    out = df.filter(where) if where else df
    out = out.select(*[F.col(f"`{resolve_column(df.columns, c) or c}`").alias(c) for c in columns])
    return out.limit(limit) if limit is not None else out


def catalog(spark: SparkSession) -> list[tuple[str, str, list[str]]]:
    """(table, kind, columns) of the current database; names only, nothing is scanned."""
    return [(t.name, t.tableType, [c.name for c in spark.catalog.listColumns(t.name)]) for t in spark.catalog.listTables()]


def read_json_array(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A file that is one array of objects; ValueError if it holds none."""
    r = spark.read.option("multiLine", True)
    df = (r.schema(schema) if schema else r).json(path)
    if not df.columns or df.isEmpty():
        raise ValueError(f"no records in {path}")
    return df


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """(seq, record) with records as JSON text, keys in file order; a file is one row, so the files should be many."""
    from lexspark.operators.trees import envelope_records
    return envelope_records(spark.read.option("wholetext", True).text(path))


def read_xml_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entry elements with nested glosses; senses and groups without a translation or hint are dropped."""
    df = spark.read.format("xml").option("rowTag", "entry").schema(XML_ENTRY).load(path)
    def sense(s):
        return F.transform(s.t, lambda t: F.struct(t.e.alias("translation"), t.h.alias("hint")))
    def group(g):
        return F.filter(F.transform(g.s, sense), lambda x: F.size(x) > 0)
    glosses = F.filter(F.transform("g", group), lambda x: F.size(x) > 0)
    return df.select(F.col("_id").alias("id"), F.col("_dia").alias("dialect"), F.col("o").alias("orthographic_form"), "pos", glosses.alias("glosses"))


def read_lines(spark: SparkSession, path: str, digits_only: bool = False) -> DataFrame:
    """Trimmed lines without blanks and # comments, and without what isn't a number if so asked."""
    v = F.trim("value")
    lines = spark.read.text(path).select(v.alias("value")).filter((F.col("value") != "") & ~F.col("value").startswith("#"))
    return lines.filter(F.col("value").rlike("^[0-9]+$")) if digits_only else lines


def create_store(spark: SparkSession, database: str, fresh: bool = False) -> list[str]:
    """A database with the normalised tables; an old one is dropped if `fresh`."""
    if fresh:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in schemas.STORE.items():
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet")
    return sorted(t.name for t in spark.catalog.listTables(database))


def write_csv(df: DataFrame, path: str, formula_escape: bool = False, mode: str = "overwrite") -> None:
    """K1: header, nulls as empty cells; with `formula_escape` cells that a spreadsheet would run get a leading apostrophe."""
    if formula_escape:
        df = df.select([F.when(F.col(f"`{n}`").rlike("^[=+@-]"), F.concat(F.lit("'"), F.col(f"`{n}`"))).otherwise(F.col(f"`{n}`")).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes])
    df.write.mode(mode).option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def write_table(df: DataFrame, name: str, if_exists: str = "replace") -> None:
    """Replace, append or fail."""
    mode = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}[if_exists]
    df.write.mode(mode).saveAsTable(name)


def save_checkpoint(df: DataFrame, name: str, at: datetime.datetime, reports: dict[str, DataFrame] | None = None, metadata: str = "checkpoint_metadata") -> str:
    """K3, K4: checkpoint_{name}_{day} (a second run of the day replaces it), a metadata row, and each report that isn't empty."""
    spark, table = df.sparkSession, f"checkpoint_{name}_{at:%Y%m%d}"
    write_table(df, table)
    row = spark.createDataFrame([(name, table, at, spark.table(table).count(), len(df.columns), ",".join(df.columns))], schemas.CHECKPOINT)
    write_table(row, metadata, "append")
    for report, frame in (reports or {}).items():
        if not frame.isEmpty():
            write_table(frame, f"{report}_{name}_{at:%Y%m%d}")
    return table


def load_checkpoint(spark: SparkSession, name: str | None = None, table: str | None = None, metadata: str = "checkpoint_metadata") -> DataFrame:
    """By table, else the newest of the name; ValueError if there is none."""
    if table is None:
        try:
            table = spark.table(metadata).filter(F.col("checkpoint_name") == name).agg(F.max_by("table_name", "timestamp")).first()[0]
        except AnalysisException as e:
            raise ValueError(f"no checkpoint {name}") from e
    if table is None:
        raise ValueError(f"no checkpoint {name}")
    return read_table(spark, table)


def log_stage(spark: SparkSession, stage: str, status: str, seconds: float, rows: int, notes: str = "", table: str = "processing_log") -> None:
    """K11, K13."""
    row = spark.createDataFrame([(stage, status, float(seconds), rows, notes, datetime.datetime.now())], schemas.LOG)
    write_table(row, table, "append")


def write_sheets(sheets: dict[str, DataFrame], path: str) -> list[str]:
    """K5: one CSV folder a sheet, names cut to 31 characters as spreadsheets want."""
    for name, df in sheets.items():
        write_csv(df, f"{path}/{name[:31]}")
    return [n[:31] for n in sheets]


def write_json(df: DataFrame, path: str) -> None:
    """K6: one object a line, null fields left out."""
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def export_batches(df: DataFrame, key: str, path: str, size: int = 1000, prefix: str = "export", trial: int = 10) -> DataFrame:
    """K7: a folder for each batch of `size` entries, the first batch once more as a trial of its first entries and the rest (trial 0:
    not), and the manifest, which is returned and written beside them."""
    b = batches(df, key, size)
    b.drop("rn").write.mode("overwrite").partitionBy("batch").json(f"{path}/batches")
    if trial:
        first = b.filter("batch = 1").withColumn("part", F.when(F.col("rn") <= trial, "trial").otherwise("rest"))
        first.drop("rn", "batch").write.mode("overwrite").partitionBy("part").json(f"{path}/plan_b")
    manifest = batch_manifest(b, prefix)
    manifest.write.mode("overwrite").json(f"{path}/manifest")
    return manifest


def export_by(df: DataFrame, column: str, path: str) -> None:
    """One folder for each raw value, so that names that look alike don't collide."""
    df.write.mode("overwrite").option("header", True).partitionBy(column).csv(path)


def export_final(df: DataFrame, path: str) -> dict[str, DataFrame]:
    """The table, its rows with citations, and those with cross-references."""
    out = {"dataset": df, "citations": df.filter("number_of_citations > 0"), "crossrefs": df.filter("number_of_cross_references > 0")}
    for name, frame in out.items():
        write_csv(frame, f"{path}/{name}")
    return out


def normalised(scraped: DataFrame) -> dict[str, DataFrame]:
    """K9: five tables out of nested records, only those scraped with success; lists become rows."""
    ok = scraped.filter("status = 'success'")
    lists = {"authority_citations": "citations", "attestations": "attestations", "entry_themes": "themes", "entry_audio": "audio"}
    out = {t: ok.select("node_id", F.inline(c)) for t, c in lists.items()}
    out["dictionary_entries"] = ok.drop(*lists.values(), "status")
    return out


def tracking_list(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, null aside."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def is_na(text: str) -> bool:
    return text in NA_TOKENS
