"""Writing the resolver's results, with the column names that spreadsheets of this kind use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.operators.scoring import RESULT


def spaced(df: DataFrame) -> DataFrame:
    """idx as index, and spaces for the underscores of the area columns."""
    areas = [c for c in df.columns if c.split("_")[0] in ("ward", "district", "province")]
    return df.withColumnsRenamed({"idx": "index"} | {c: c.replace("_", " ") for c in areas})


def write_matches(matches: DataFrame, path: str, mode: str = "error") -> None:
    """A match table as parquet and as CSV, below path."""
    spaced(matches).write.mode(mode).parquet(f"{path}.parquet")
    spaced(matches).write.mode(mode).option("header", True).option("escape", '"').csv(f"{path}.csv")


def write_result(result: DataFrame, path: str, mode: str = "error") -> None:
    """The best answers as CSV with semicolons; dealt anew into files of a sensible size, so that none is empty."""
    spaced(result.select(*RESULT)).hint("rebalance").write.mode(mode).option("header", True).option("sep", ";").option("escape", '"').csv(path)


def write_gazetteer(gazetteer: DataFrame, path: str, mode: str = "error") -> None:
    gazetteer.write.mode(mode).parquet(path)


def summary(result: DataFrame) -> DataFrame:
    """Answers by strategy, for a log."""
    return result.groupBy("strategy").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"))
