"""Spans inside intervals, rebased to them: a range join in bins.

Addresses can be matched as parts of longer texts. The parts of a text are intervals of it; a span that lies in a part
whole belongs to it, at a place that counts from the part's start. An interval stands in every bin of `width` places that
it touches, a span in the bin of its start only, so the join is one on equal bins (no nested loop) and tells each pair once.

Edge cases: a span in several intervals gets a row for each; a span in none gets one row with nulls and its place as it is;
empty intervals (that end before they start) hold nothing; spans or intervals with a null place or key match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.operators.matching import dealt

#: Places in a bin: some times the length of a usual interval, so that most stand in one or two bins.
WIDTH = 256


def combined(addresses: DataFrame, batch: Column, separator: str = ";") -> tuple[DataFrame, DataFrame]:
    """Addresses (idx, addr) laid end to end, by batch: texts (idx: the batch, addr), and parts (batch, idx, from_idx, to_idx).

    Each is followed by the separator, which must not be a word character. A batch is one text: keep it bounded.
    """
    rows = dealt(addresses.select(batch.alias("batch"), "idx", F.coalesce("addr", F.lit("")).alias("addr")), "batch")
    order = Window.partitionBy("batch").orderBy("idx", "addr")
    start = F.coalesce(F.sum(F.length("addr") + len(separator)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    placed = rows.withColumn("from_idx", start)
    parts = placed.select("batch", "idx", "from_idx", (F.col("from_idx") + F.length("addr") - 1).alias("to_idx"))
    laid = F.transform(F.sort_array(F.collect_list(F.struct("from_idx", "idx", "addr"))), lambda x: F.concat(x["addr"], F.lit(separator)))
    return placed.groupBy("batch").agg(F.array_join(laid, "").alias("addr")).withColumnRenamed("batch", "idx"), parts


def contained(spans: DataFrame, intervals: DataFrame, by: list[str], width: int = WIDTH) -> DataFrame:
    """spans (by, start_idx, end_idx and any other columns) with the other columns of the intervals (by, from_idx, to_idx)
    that hold them, start_idx and end_idx counted from from_idx."""
    told = [c for c in intervals.columns if c not in (*by, "from_idx", "to_idx")]
    place = F.struct(*(F.col(c).alias(c) for c in [*by, "from_idx", "to_idx", *told])).alias("_i")
    bins = F.explode(F.sequence(F.floor(F.col("from_idx") / width), F.floor(F.col("to_idx") / width)))
    binned = intervals.where("from_idx <= to_idx").select(place, bins.alias("_bin"))
    mine = F.floor(F.col("start_idx") / width)
    on = [F.col(c) == F.col(f"_i.{c}") for c in by] + [mine == F.col("_bin"), F.col("_i.from_idx") <= F.col("start_idx"), F.col("end_idx") <= F.col("_i.to_idx")]
    met = spans.join(binned, on, "left")
    rebased = {c: F.col(c) - F.coalesce("_i.from_idx", F.lit(0)) for c in ("start_idx", "end_idx")}
    return met.select(*(rebased[c].alias(c) if c in rebased else F.col(c) for c in spans.columns), *(F.col(f"_i.{c}").alias(c) for c in told))
