"""What the operators of this subpackage share: tables, shared storage, shipping the package to workers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.shipping import ship

__all__ = ["SPACE", "fresh_path", "one_of_each", "remove", "saved", "shared_dir", "ship", "sized", "table", "text_or_empty", "tidy", "without_rows"]

#: Rows of a table of keys (some 50 bytes each in memory) up to which it is broadcast; beyond it joins are merge joins.
BROADCAST_ROWS = 1_000_000
#: White space of the text contracts: space and the five control characters.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark alone (the path may be of any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share: spark.checkpoint.dir, or one of our own where it is unset (tests)."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not given:
        given = spark.sparkContext.getCheckpointDir()
    if not given:
        given = "file://" + tempfile.mkdtemp(prefix="gazetta-shared-")
        spark.sparkContext.setCheckpointDir(given)
    return given.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/gazetta/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write df to the shared folder and read it back: its lineage ends there and survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def sized(keys: DataFrame) -> DataFrame:
    """A saved table of keys, to be broadcast if its counted rows are few enough, else to be merged."""
    return keys.hint("broadcast" if keys.count() <= BROADCAST_ROWS else "merge")


def one_of_each(docs: DataFrame, id_col: str, text_col: str, grouped: DataFrame) -> DataFrame:
    """docs with one row of each group: the one of the smallest id (null last), then text key; all columns stay.

    grouped: doc_id, text_key, group for each row of docs (a null group: the row stays). Rows go one by one, not by id:
    rows that share an id stay or go by their texts, and of rows that repeat id and text one stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = grouped.where(F.col("group").isNotNull()).groupBy("group").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    told = grouped.join(first, "group").groupBy("doc_id", "text_key").agg(F.max(key == F.col("first")).alias("stays"), F.count(F.lit(1)).alias("n"))
    told, _ = saved(told.where("NOT stays OR n > 1"), "dropped")
    rest = without_rows(docs, id_col, text_col, told)
    again, _ = saved(told.where("stays"), "repeated")
    if again.isEmpty():
        return rest
    repeated = _matching(docs, id_col, text_col, again, "left_semi")
    return rest.unionByName(repeated.dropDuplicates(["doc_id", "text_key"]).select("row.*"))


def _matching(docs: DataFrame, id_col: str, text_col: str, keys: DataFrame, how: str) -> DataFrame:
    """row (all columns of docs, whatever their names), doc_id, text_key of the rows with, or without, a key in keys."""
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"))
    keys = keys.select(F.col("doc_id").alias("_i"), F.col("text_key").alias("_t"))
    return rows.join(sized(keys), (F.col("text_key") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_i")), how)


def without_rows(docs: DataFrame, id_col: str, text_col: str, keys: DataFrame) -> DataFrame:
    """docs without the rows whose id and text key are in keys (doc_id, text_key)."""
    return _matching(docs, id_col, text_col, keys, "left_anti").select("row.*")


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow, with its freed memory given back to the system as a task ends: workers live on for later stages."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return tidied


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))
