"""Where intermediate tables go: the shared folder that the cluster names in spark.checkpoint.dir."""

import sys
import tempfile
import uuid

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegralType

#: Folders that written() made in this process and that weren't released.
MADE: list[str] = []


def shared(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or, where it is unset and Spark runs in one process (tests), a folder of our own that is then set."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        old = spark.sparkContext._jsc.sc().getCheckpointDir()
        if old.isDefined():
            return old.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="lexspark-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(at)
    return at


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder (with a folder for each value of the columns ``by``), read again: its lineage is cut, and a lost executor costs no recomputation."""
    path = f"{shared(df.sparkSession)}/lexspark/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    MADE.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders of written(); frames that read them can't be used any more."""
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        if path in MADE:
            MADE.remove(path)


def cut(df: DataFrame) -> DataFrame:
    """An eager reliable checkpoint in the shared folder."""
    shared(df.sparkSession)
    return df.checkpoint(eager=True)


def integer_key(docs: DataFrame, key: str) -> None:
    """Operators that pack keys by their bits want whole numbers; TypeError for others."""
    if not isinstance(docs.schema[key].dataType, IntegralType):
        raise TypeError(f"the key {key} is no integer; number the documents first")


register_pickle_by_value(sys.modules[__name__])
