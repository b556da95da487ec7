"""Sharding by weighted rendezvous hashing of record keys.

A key's score for a shard is -weight / ln(u), u a uniform number drawn from md5(key ":" shard); the shard of the highest
score holds the key (the smaller number on a tie). Scores of other shards don't depend on the number of shards, so one
more shard takes keys only into itself, 1/(n+1) of them at equal weights. Only thin rows move: a slot inside a shard is
the row's rank inside its block (a hash range of the shard) plus the rows of earlier blocks, so no shard is in one task.

Edge cases: a null key hashes as the empty string; a null text has no bytes (size 1) and the CRC of nothing, 0; repeated
rows get different slots; very long texts only count their bytes; an empty table gives no rows; other columns of the input
pass through ``shard_records`` untouched: where one has the name of the shard's column, that takes the next free name
(``shard_1``, ...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm import common

#: Rows of a block, on average: what one window group sorts.
BLOCK_ROWS = 200_000


def uniform(key: Column, shard: int) -> Column:
    """A number in (0, 1) that depends on key and shard: 52 bits of an md5."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (int) of a string key among shards 0 .. len(weights) - 1; shards of weight 0 get nothing."""
    live = [(s, w) for s, w in enumerate(weights) if w > 0]
    if not live:
        raise ValueError("no shard has a positive weight")
    scored = [F.struct((F.lit(-float(w)) / F.log(uniform(key, s))).alias("score"), F.lit(-s).alias("shard")) for s, w in live]
    return (-(F.array_max(F.array(*scored))["shard"])).cast("int")


def shard_records(docs: DataFrame, weights: list[float], key_col: str = "doc_id", out: str = "shard") -> DataFrame:
    """docs with the shard of each row in a new column; narrow, nothing moves."""
    taken = {c.lower() for c in docs.columns}
    out = next(name for i in range(len(taken) + 1) if (name := f"{out}_{i}" if i else out).lower() not in taken)
    return docs.withColumn(out, rendezvous(F.coalesce(F.col(key_col).cast("string"), F.lit("")), weights))


def with_slots(rows: DataFrame, total: int, order: list[str], shard: str = "shard", spread: list[str] | None = None) -> DataFrame:
    """rows with slot, a rank from 0 without gaps inside each shard, in an order of blocks and, inside them, of order."""
    blocks = max(1, -(-total // BLOCK_ROWS))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64(*(spread or order)), F.lit(blocks)).cast("int"))
    counts = rows.groupBy(shard, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row for each shard and block: the input's rows / BLOCK_ROWS at least, so AQE decides whether to broadcast it.
    rank = F.row_number().over(Window.partitionBy(shard, "_block").orderBy(*order)) - 1
    return rows.withColumn("_rank", rank).join(starts, [shard, "_block"]).withColumn("slot", (F.col("_start") + F.col("_rank")).cast("long")).drop("_block", "_rank", "_start")


def shard_plan(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row, under the law `key` at equal weights."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.col("_text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")).select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        rendezvous(key, [1.0] * n_shards).alias("shard"),
        rendezvous(key, [1.0] * (n_shards + 1)).alias("grown_shard"),
    )
    thin, _ = common.saved(rows, "shards")
    slotted = with_slots(thin, thin.count(), ["doc_id", "text_crc32", "size"])
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
