"""Exact deduplication by a tree merge of sorted digest runs.

Every partition turns its rows into a *run*: entries (digest, byte length, smallest id, count), sorted by digest, each
digest once. Runs are split by leading digest bits into buckets, so a merge task holds one bucket of a few runs, never a
whole group of rows. Runs then meet in rounds as in a binomial tree (of fan-in ``fan_in`` instead of two): in each round
runs g*f .. g*f+f-1 of a bucket are merged into run g. A merge keeps, for each digest, the smallest id and the sum of
the counts, and verifies that entries of one digest agree on the byte length.

Edge cases: a null text counts as empty; a null doc_id sorts after all others, so it is kept only where every id of its
group is null; very long texts are digested whole; an empty table gives no rows; other columns are not looked at.
drop_exact_copies drops rows, not ids: a row
that shares its doc_id with a copy stays if its own text is the first of its kind, and of repeated rows one stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm import common

ENTRY = np.dtype([("digest", "S32"), ("size", "<i8"), ("id", "<i8"), ("n", "<i8")])
NO_ID = np.iinfo(np.int64).max
#: Entries of a bucket that one merge task may hold (56 bytes each).
BUCKET_ENTRIES = 1 << 19


def normalised(column: str):
    """The text in which every run of white space is one space; null is empty."""
    return F.regexp_replace(common.text_or_empty(column), common.SPACE, " ")


def merge_entries(parts: list[np.ndarray]) -> np.ndarray:
    """Merge sorted runs into one with each digest once (the stable sort merges the runs that it finds in order)."""
    a = np.concatenate(parts) if parts else np.empty(0, ENTRY)
    if not len(a):
        return a
    a = a[np.argsort(a["digest"], kind="stable")]
    first = np.flatnonzero(np.concatenate(([True], a["digest"][1:] != a["digest"][:-1])))
    out = a[first].copy()
    if (np.minimum.reduceat(a["size"], first) != np.maximum.reduceat(a["size"], first)).any():
        raise ValueError("texts of different length share a digest")
    out["id"] = np.minimum.reduceat(a["id"], first)
    out["n"] = np.add.reduceat(a["n"], first)
    return out


def _leaves(bits: int):
    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        run = TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        for b in batches:
            a = np.empty(b.num_rows, ENTRY)
            a["digest"] = np.array(b.column("digest").to_pylist(), "S32")
            a["size"] = b.column("size").to_numpy(zero_copy_only=False)
            a["id"] = b.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            a["n"] = 1
            held.append(merge_entries([a]))
            if len(held) > 1 and sum(map(len, held[1:])) > len(held[0]):
                held = [merge_entries(held)]
        a = merge_entries(held)
        if len(a):
            bucket = np.frombuffer(a["digest"].astype("S32").tobytes(), ">u4")[::8].astype(np.int64) >> (32 - bits) if bits else np.zeros(len(a), np.int64)
            cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(a)]))
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([int(bucket[s])], pa.int64()), pa.array([run], pa.int64()), pa.array([a[s:e].tobytes()], pa.binary())], ["bucket", "run", "entries"])

    return leaves


def _round(key: tuple, group: pa.Table) -> pa.Table:
    merged = merge_entries([np.frombuffer(x.as_buffer(), ENTRY) for x in group.column("entries")])
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "run": pa.array([key[1].as_py()], pa.int64()), "entries": pa.array([merged.tobytes()], pa.binary())})


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x in b.column("entries"):
            a = np.frombuffer(x.as_buffer(), ENTRY)
            a = a[a["n"] > 1]
            for i in range(0, len(a), 50_000):
                c = a[i : i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(c), [None, pa.py_buffer(np.ascontiguousarray(c["digest"]).tobytes())]).cast(pa.binary()), pa.array(c["id"]), pa.array(c["n"])],
                    ["digest", "keep_id", "group_size"],
                )


def duplicate_groups(thin: DataFrame, rows: int, fan_in: int = 8) -> DataFrame:
    """digest, keep_id, group_size of every digest that more than one row has. thin: doc_id, digest, size."""
    bits = max(0, (max(rows, 1) // BUCKET_ENTRIES).bit_length())
    schema = "bucket long, run long, entries binary"
    runs, path = common.saved(thin.mapInArrow(_leaves(bits), schema), "runs")
    last = runs.agg(F.max("run")).first()[0] or 0
    while last:
        merged = runs.withColumn("run", F.floor(F.col("run") / fan_in)).groupBy("bucket", "run").applyInArrow(_round, schema)
        old, last = path, last // fan_in
        runs, path = common.saved(merged, "runs")
        common.remove(thin.sparkSession, old)
    return runs.mapInArrow(_unpack, "digest binary, keep_id long, group_size long")


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, digest and size of the normalised text of each row."""
    common.ship(docs.sparkSession)
    norm = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), normalised(text_col).alias("t"))
    return common.saved(norm.select("doc_id", "text_key", F.unhex(F.sha2("t", 256)).alias("digest"), F.octet_length("t").cast("long").alias("size")), "digests")[0]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of docs."""
    thin = _digests(docs, id_col, text_col)
    groups = duplicate_groups(thin.select("doc_id", "digest", "size"), thin.count(), fan_in)
    keep = F.when(F.col("keep_id") != NO_ID, F.col("keep_id"))
    return thin.join(groups, "digest", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(keep).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("group_size").isNull(), F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(keep)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each text: of the smallest id, and of rows that repeat it one; all columns stay."""
    thin = _digests(docs, id_col, text_col)
    groups = duplicate_groups(thin.select("doc_id", "digest", "size"), thin.count())
    copies = thin.join(groups.select("digest"), "digest").select("doc_id", "text_key", F.col("digest").alias("group"))
    return common.one_of_each(docs, id_col, text_col, copies)
