"""Reading the resolver's inputs. Schemas are explicit; parquet first, text and spreadsheets at the edge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.plans.gazetteer import COLUMNS

ADDRESS = "ID long, ADDR string"


def read_addresses(spark: SparkSession, path: str, kind: str = "parquet", **options: str) -> DataFrame:
    """idx, addr from a table with the columns ID and ADDR: parquet, csv (with a header), json or xlsx."""
    if kind == "xlsx":
        rows = read_xlsx(spark, path, **options)
    elif kind == "parquet":
        rows = spark.read.parquet(path)
    else:
        rows = spark.read.format(kind).schema(ADDRESS).options(**({"header": "true"} if kind == "csv" else {}), **options).load(path)
    return rows.select(F.col("ID").cast("long").alias("idx"), F.col("ADDR").alias("addr"))


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """A stored gazetteer; its columns may be spelled with spaces ("ward code") or with underscores."""
    df = spark.read.parquet(path)
    return df.select(*(F.col(f"`{c if c in df.columns else c.replace('_', ' ')}`").alias(c) for c in COLUMNS))


def read_matches(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A stored match table of one kind."""
    df = spark.read.parquet(path)
    names = {"index": "idx", f"{kind} code": f"{kind}_code"}
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def literal_addresses(spark: SparkSession, texts: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(texts)), "idx long, addr string")


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A sheet of a workbook, all columns strings; the first row names them. One workbook is one task, by Spark's reader."""
    from gazetta.shipping import ship
    from gazetta.sources.xlsx import rows_of_workbook

    ship(spark)
    file = spark.read.format("binaryFile").load(path).select("content")
    lists = file.rdd.flatMap(lambda r: rows_of_workbook(bytes(r.content), sheet))
    header = lists.first()
    names = [h or f"column_{i}" for i, h in enumerate(header)]
    n = len(names)
    body = lists.zipWithIndex().filter(lambda x: x[1] > 0).map(lambda x: tuple((x[0] + [None] * n)[:n]))
    return spark.createDataFrame(body, ", ".join(f"`{x}` string" for x in names))
