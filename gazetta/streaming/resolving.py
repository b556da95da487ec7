"""Resolving a stream of addresses: an address never spans micro-batches, so each batch is resolved like a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gazetta.plans.resolve import prepare, resolve_observed


def resolve_stream(addresses: DataFrame, gazetteer: DataFrame, path: str, checkpoint: str, report: Callable[[int, dict[str, int]], None] | None = None) -> StreamingQuery:
    """Append the best answers of a stream of (idx, addr) to parquet below path; ended by the caller.

    report: called with each batch's number and its counts (of resolve_observed()), which its one job has gathered.

    A batch that is run again after a failure overwrites its own folder, so answers are written exactly once.
    """

    known = prepare(gazetteer)  # once for all micro-batches

    def one(batch: DataFrame, number: int) -> None:
        result, metrics = resolve_observed(batch, known)
        result.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if report:
            report(number, metrics())

    return addresses.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
