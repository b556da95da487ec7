"""A store of matches: one table of all kinds, bucketed and sorted by idx, so that scoring it again moves nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COLUMNS = ["idx", "addr", "kind", "code", "name", "start_idx", "end_idx"]


def save_matches(matches: DataFrame, table: str, path: str, buckets: int = 64, mode: str = "error") -> None:
    """Write matches (as match_areas() gives them) below path, a file for each bucket, and name them in the catalog."""
    rows = matches.select(*COLUMNS).repartition(buckets, "idx").sortWithinPartitions("idx")
    rows.write.mode(mode).format("parquet").bucketBy(buckets, "idx").sortBy("idx").option("path", path).saveAsTable(table)


def open_matches(spark: SparkSession, table: str, path: str, buckets: int = 64) -> DataFrame:
    """The stored matches; a catalog that doesn't know the table is told of it (with the number of buckets it has)."""
    if not spark.catalog.tableExists(table):
        kinds = {"idx": "BIGINT", "start_idx": "BIGINT", "end_idx": "BIGINT"}
        columns = ", ".join(f"{c} {kinds.get(c, 'STRING')}" for c in COLUMNS)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (idx) SORTED BY (idx) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(table)
