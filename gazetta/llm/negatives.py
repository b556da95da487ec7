"""Hard-negative mining by bit-sliced integer products.

An anchor's *positives* are the best rows of its own label, its *negatives* for a positive the best rows of other labels
whose score lies between two shares of the positive's score. A score is the inner product of integer components.

1. Rows are stored in blocks as *bit-planes*: plane k holds bit k of all components, in two's complement.
2. Blocks of anchors meet blocks of rows in cells of a grid: a row goes once to each group of anchors (GROUP_BYTES of
   them), an anchor once to each group of rows, so every cell is bounded, whatever the labels and copies.
3. In a cell a block's planes are multiplied most significant first. After each of them a score lies between the sum so far
   plus what the anchor's negative components, and plus what its positive ones, can still add. Candidates go once this
   interval can't qualify any more: below the last of enough others that surely do (of this block or of blocks before),
   or outside the wanted range of scores. With few candidates left only their products go on. At the end scores are exact.
4. Each cell gives its best few rows for each anchor (and positive); Spark ranks them, partly before the shuffle. First
   this finds the positives, then, with their scores as bounds, the negatives.

Only products of the stated anchors with all rows are formed, in blocks; nothing is broadcast or collected.

Edge cases: rows with a null id, label or vector, a null component or one beyond BOUND in size (whose products could leave
64 bits) take no part; vectors of different lengths are as if filled up with zeros, empty vectors score 0; rows of the
anchor's own id are not its positives; rows that repeat an id count each, and each row of an anchor's id is an anchor; equal
scores go by the smaller id; a positive of negative score has no negatives, as no score lies in its range; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm import common

BOUND = 1 << 24
#: Components of a block of rows, anchors of a block, bytes of a group of either in a cell.
BLOCK_COMPONENTS, BLOCK_ANCHORS, GROUP_BYTES = 1 << 17, 256, 16 << 20
#: Below this share of pairs left, products are formed for them alone.
FEW = 0.1
_LEAST = np.iinfo(np.int64).min // 4


def matrix(column: pa.ListArray) -> np.ndarray:
    """Lists of integers as rows of a matrix, filled up with zeros."""
    lengths = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), max(int(lengths.max(initial=0)), 1)), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(column)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def to_planes(x: np.ndarray) -> tuple[int, bytes]:
    """The bit-planes of integers in two's complement, least significant first."""
    bits = 1 + max(int(x.max(initial=0)).bit_length(), int(-x.min(initial=0) - 1).bit_length() if x.min(initial=0) < 0 else 0)
    return bits, b"".join(np.packbits((x >> k) & 1).tobytes() for k in range(bits))


def plane(data: np.ndarray, k: int, shape: tuple[int, int]) -> np.ndarray:
    n = shape[0] * shape[1]
    size = -(-n // 8)
    return np.unpackbits(data[k * size : (k + 1) * size], count=n).reshape(shape)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows: ids, labels, number of components, bits and planes."""
    for b in batches:
        at = 0
        while at < b.num_rows:
            longest = max(1, int(np.diff(np.asarray(b.column("q").offsets))[at : at + BLOCK_COMPONENTS].max(initial=0)))
            part = b.slice(at, max(1, BLOCK_COMPONENTS // longest))
            at += part.num_rows
            x = matrix(part.column("q"))
            bits, planes = to_planes(x)
            ids, labels = (part.column(c).to_numpy().astype(np.int64).tobytes() for c in ("id", "label"))
            yield pa.RecordBatch.from_pydict({"ids": [ids], "labels": [labels], "dims": pa.array([x.shape[1]], pa.int32()), "bits": pa.array([bits], pa.int32()), "planes": [planes]})


class Anchors:
    """A block of anchors: numbers, ids, labels, components, and for each the wanted ranges of scores."""

    def __init__(self, table: pa.Table, lo: np.ndarray, hi: np.ndarray, most: int):
        self.number, self.id, self.label = (table.column(c).to_numpy() for c in ("number", "id", "label"))
        self.q = matrix(table.column("q").combine_chunks())
        self.lo, self.hi, self.most = lo, hi, most  # lo, hi: a column for each wanted list
        self.up, self.down = np.maximum(self.q, 0).sum(axis=1), np.minimum(self.q, 0).sum(axis=1)
        self.best = np.empty((0, 3), np.int64)  # list (anchor * lists + which), score, id
        self.bar = np.maximum(np.full(lo.shape, _LEAST), lo)  # what a score must reach to be on the list

    def keep(self, anchor: np.ndarray, row_id: np.ndarray, score: np.ndarray) -> None:
        """Put exact scores on the lists that want them."""
        lists, found = self.lo.shape[1], [self.best]
        for j in range(lists):
            good = (score >= self.bar[anchor, j]) & (score <= self.hi[anchor, j])
            found.append(np.stack((anchor[good] * lists + j, score[good], row_id[good]), axis=1))
        x = np.concatenate(found)
        x = x[np.lexsort((x[:, 2], -x[:, 1], x[:, 0]))]
        first = np.flatnonzero(np.concatenate(([True], x[1:, 0] != x[:-1, 0]))) if len(x) else np.empty(0, np.int64)
        rank = np.arange(len(x)) - np.repeat(first, np.diff(np.concatenate((first, [len(x)]))))
        self.best = x[rank < self.most]
        last = x[rank == self.most - 1]
        self.bar.reshape(-1)[last[:, 0]] = last[:, 1]


def _nth(values: np.ndarray, n: int) -> np.ndarray:
    """The n-th greatest of each row."""
    if values.shape[1] < n:
        return np.full(len(values), _LEAST)
    return np.partition(values, values.shape[1] - n, axis=1)[:, values.shape[1] - n]


def narrow(a: Anchors, who: np.ndarray, cols: np.ndarray, data: np.ndarray, bits: int, shape: tuple[int, int], allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, rows and exact scores of the pairs that may be on a list. who, cols: the anchors and rows looked at,
    allowed: which of their pairs count."""
    q = np.zeros((len(who), shape[1]), np.int64)
    d = min(shape[1], a.q.shape[1])
    q[:, :d] = a.q[who][:, :d]
    up, down = a.up[who], a.down[who]
    real = np.float32 if max(up.max(initial=0), -down.min(initial=0)) < 1 << 24 else np.float64
    qr = q.astype(real)
    alive, score = allowed, np.zeros(allowed.shape, np.int64)
    pairs = None  # (anchor, column, score) once few are left
    for k in range(bits - 1, -1, -1):
        weight = -(1 << k) if k == bits - 1 else 1 << k
        bit = plane(data, k, shape)[cols]
        more, less = ((1 << k) - 1) * up, ((1 << k) - 1) * down
        if pairs is None:
            score += (qr @ bit.T.astype(real)).astype(np.int64) * weight
            if 4 * (more - less).max(initial=0) > score.max(initial=0) - score.min(initial=0) and k:
                continue  # intervals that are as wide as all scores together rule nothing out
            stays = np.zeros(alive.shape, bool)
            for j in range(a.lo.shape[1]):
                lo, hi, bar = a.lo[who, j], a.hi[who, j], a.bar[who, j]
                sure = alive & (score >= (lo - less)[:, None]) & (score <= (hi - more)[:, None])
                bar = np.maximum(bar, _nth(np.where(sure, score, _LEAST), a.most) + less)
                stays |= alive & (score >= (bar - more)[:, None]) & (score <= (hi - less)[:, None])
            alive = stays
            used = alive.any(axis=0)
            if 2 * used.sum() < len(used):
                cols, alive, score = cols[used], alive[:, used], score[:, used]
            if alive.sum() <= FEW * alive.size:
                x, y = np.nonzero(alive)
                pairs = x, y, score[x, y]
        elif len(pairs[0]):
            x, y, s = pairs
            out = np.empty(len(x), np.int64)
            for at in range(0, len(x), 1 << 15):
                i, c = x[at : at + (1 << 15)], y[at : at + (1 << 15)]
                out[at : at + len(i)] = np.einsum("ij,ij->i", qr[i], bit[c].astype(real)).astype(np.int64)
            s = s + out * weight
            stays = np.zeros(len(x), bool)
            for j in range(a.lo.shape[1]):
                stays |= (s >= (a.bar[who, j] - more)[x]) & (s <= (a.hi[who, j] - less)[x])
            pairs = x[stays], y[stays], s[stays]
    if pairs is None:
        x, y = np.nonzero(alive)
        pairs = x, y, score[x, y]
    return who[pairs[0]], cols[pairs[1]], pairs[2]


def _cell(same: bool, most: int, shares: tuple[int, int]):
    """The best rows of a cell for each of its anchors (same label: to be positives) or of their positives."""

    def run(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        blocks = []
        for at in range(0, anchors.num_rows, BLOCK_ANCHORS):
            part = anchors.slice(at, BLOCK_ANCHORS)
            if same:
                lo, hi = np.full((part.num_rows, 1), _LEAST), np.full((part.num_rows, 1), -_LEAST)
            else:
                scores = part.column("positive_scores").to_pylist()
                width = max(map(len, scores))
                lo, hi = np.full((part.num_rows, width), -_LEAST), np.full((part.num_rows, width), _LEAST)
                for i, of in enumerate(scores):
                    for j, p in enumerate(of):
                        lo[i, j], hi[i, j] = -(-shares[0] * p // 100), shares[1] * p // 100
            blocks.append(Anchors(part, lo, hi, most))
        for r in range(rows.num_rows):
            ids, labels = (np.frombuffer(rows.column(c)[r].as_buffer(), np.int64) for c in ("ids", "labels"))
            data, bits = np.frombuffer(rows.column("planes")[r].as_buffer(), np.uint8), rows.column("bits")[r].as_py()
            shape = len(ids), rows.column("dims")[r].as_py()
            for a in blocks:
                groups = [(np.flatnonzero(a.label == x), np.flatnonzero(labels == x)) for x in np.intersect1d(a.label, labels)] if same else [(np.arange(len(a.id)), np.arange(len(ids)))]
                for who, cols in groups:
                    allowed = a.id[who][:, None] != ids[cols] if same else a.label[who][:, None] != labels[cols]
                    anchor, row, score = narrow(a, who, cols, data, bits, shape, allowed)
                    a.keep(anchor, ids[row], score)
        out = [(a.number[a.best[:, 0] // a.lo.shape[1]], a.best[:, 0] % a.lo.shape[1], a.best[:, 2], a.best[:, 1]) for a in blocks]
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 4
        return pa.table(dict(zip(("number", "which", "row_id", "score"), columns, strict=True)))

    return run


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, shares: tuple[int, int] = (30, 90)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its best
    `positives` rows the best `negatives` rows of other labels with shares[0] % to shares[1] % of the positive's score.

    rows: id (long), label (long), q (array of long); is_anchor: a condition on them.
    """
    spark = rows.sparkSession
    common.ship(spark)
    known = rows.where("id IS NOT NULL AND label IS NOT NULL AND q IS NOT NULL").where(F.forall("q", lambda x: x.isNotNull() & (F.abs(x) < BOUND))).select("id", "label", "q")
    blocks, rows_at = common.saved(known.mapInArrow(_sliced, "ids binary, labels binary, dims int, bits int, planes binary"), "planes")
    anchors, anchors_at = common.saved(known.where(is_anchor).withColumn("number", F.monotonically_increasing_id()), "anchors")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = lambda df, size: -(-(df.agg(F.sum(size)).first()[0] or 0) // GROUP_BYTES)
    row_groups = max(least, groups(blocks, F.octet_length("planes") + F.octet_length("ids") * 2))
    anchor_groups = max(1, groups(anchors, F.size("q").cast("long") * 8 + 64))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    placed = blocks.withColumn("row_group", F.pmod(F.xxhash64("ids", "planes"), F.lit(row_groups)).cast("int")).withColumn("anchor_group", every(anchor_groups))

    def best(of: DataFrame, same: bool, most: int) -> DataFrame:
        dealt = of.withColumn("anchor_group", F.pmod(F.xxhash64("number"), F.lit(anchor_groups)).cast("int")).withColumn("row_group", every(row_groups))
        cell = ["row_group", "anchor_group"]
        # With a fixed number of partitions, as a cell's bytes don't tell its work.
        left, right = (x.repartition(row_groups, *cell).groupBy(*cell) for x in (placed, dealt))
        found = left.cogroup(right).applyInArrow(_cell(same, most, shares), "number long, which long, row_id long, score long")
        order = Window.partitionBy("number", "which").orderBy(F.col("score").desc(), "row_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    first = best(anchors.select("number", "id", "label", "q"), True, positives)
    listed = first.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("rank", "row_id", "score"))).alias("positives"))
    paired, paired_at = common.saved(anchors.join(listed, "number"), "positives")
    second = best(paired.select("number", "id", "label", "q", F.col("positives.score").alias("positive_scores")), False, negatives)
    of = paired.select("number", F.col("id").alias("anchor_id"), F.posexplode("positives").alias("which", "p")).select("number", F.col("which").cast("long").alias("which"), "anchor_id", F.col("p.row_id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    out = second.join(of, ["number", "which"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    result, _ = common.saved(out, "negatives")
    common.remove(spark, rows_at, anchors_at, paired_at)
    return result


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """id, label, q of the rows whose label, vector and components are there and finite; labels of each seventh id are moved on."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    good = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.where("label IS NOT NULL AND embedding IS NOT NULL").where(good)
    return rows.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), F.transform(x, lambda c: F.floor(c * scale)).alias("q"))
