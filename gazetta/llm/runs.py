"""Periodic runs of words: longest previous factors, Lempel-Ziv blocks, extensions at block boundaries, copying.

A run is a stretch of consecutive words with smallest period q and length >= max(SHORTEST, 2 q) that no neighbouring word
extends. Documents are worked on by themselves, many at once in array operations, and nothing is shuffled:

1. Words become numbers, exactly, in each document. A run holds two equal stretches of SHORTEST / 2 words, so documents
   without such a repeat (told by a hash of each stretch; a false alarm only costs work) have no run.
2. Doubling names every stretch of 2**k words by its rank; the last names are the *suffix array*. Names of all k also
   answer how far two places agree, forwards and backwards, so the *LCP* of neighbouring suffixes comes from them.
3. The *longest previous factor* of a place is the greater of its LCPs with the nearest suffixes in order that begin
   earlier in the text (nearest smaller values and range minima, by sparse tables). Factors, end to end, are the blocks.
4. *Main's boundary extensions.* By the choice of blocks a run that begins at or before a block's start s and ends in the
   block has a period shorter than this block and the one before together. For each such period p the matches at distance
   p about s and about s - p are extended both ways. The sum of these periods is linear in the text. The ends of a run
   determine it: of periods with the same ends the smallest counts.
5. *Bucketed copying.* Other runs lie inside a block, so they are copies of runs where the block occurred before. Runs are
   kept in buckets by their start, and each block, in order, copies those of the place that it was copied from.

Edge cases: a null or empty text has no words, no runs and an empty collapsed text; other white space than U+0020 and
U+0009 to U+000D is part of words; rows are worked on one by one, so null, repeated ids and equal rows don't matter; very
long texts are worked on whole (some 4 bytes a word for each doubling that its longest repeat needs); an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.llm import common
from gazetta.llm.textkernel import mix

SHORTEST = 12
#: Words that are worked on at once, at least where a task has so many.
STRETCH = 1 << 17
_RUN = "array<struct<start:long,length:long,period:long>>"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def numbered(words: list[bytes]) -> list[int]:
    """A number for each word; equal words have equal ones."""
    number = defaultdict(count().__next__)
    return [number[w] for w in words]


def repeats(names: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Whether each place begins a stretch of `size` words (of one document) that by its hash begins elsewhere too."""
    out = np.zeros(len(names), bool)
    n = len(names) - size + 1
    if n < 2:
        return out
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + names[i : i + n].astype(np.uint64))
    at = np.flatnonzero(np.arange(n) + size <= ends[:n])
    order = at[np.argsort(h[at], kind="stable")]
    same = h[order[1:]] == h[order[:-1]]
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


class Names:
    """Ranks of all stretches of 2**k words; a stretch over its document's end is smaller than one that goes on."""

    def __init__(self, symbols: np.ndarray, ends: np.ndarray):
        """symbols: numbers that no two documents share, the documents' in order; ends: each place's document end."""
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        heads = np.flatnonzero(np.concatenate(([True], symbols[order][1:] != symbols[order][:-1])))
        rank = np.empty(n, np.int32)
        rank[order] = np.repeat(heads, np.diff(np.concatenate((heads, [n]))))
        self.n, self.ends, self.levels = n, ends, [rank]
        while True:
            shared = np.bincount(rank, minlength=n)[rank] > 1
            at = np.flatnonzero(shared)
            if not len(at):
                break
            half = 1 << (len(self.levels) - 1)
            behind = np.where(at + half < ends[at], rank[np.minimum(at + half, n - 1)], -1).astype(np.int64)
            key = rank[at].astype(np.int64) * (n + 1) + behind + 1
            order = np.argsort(key, kind="stable")
            key, at = key[order], at[order]
            old = rank[at]
            new = np.concatenate(([True], key[1:] != key[:-1]))
            group = np.concatenate(([True], old[1:] != old[:-1]))
            first = np.arange(len(at))
            of_new, of_group = np.maximum.accumulate(np.where(new, first, 0)), np.maximum.accumulate(np.where(group, first, 0))
            rank = rank.copy()
            rank[at] = old + (of_new - of_group)
            self.levels.append(rank)

    def suffixes(self) -> np.ndarray:
        sa = np.empty(self.n, np.int64)
        sa[self.levels[-1]] = np.arange(self.n)
        return sa

    def agree(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on (i < j, of one document) are the same."""
        i, j = i.copy(), j.copy()
        start, end = i.copy(), self.ends[np.minimum(j, self.n - 1)]
        live = np.flatnonzero(j < self.n)
        for k in range(len(self.levels) - 1, -1, -1):
            a = live[j[live] < end[live]]
            a = a[self.levels[k][i[a]] == self.levels[k][j[a]]]
            i[a] += 1 << k
            j[a] += 1 << k
        return i - start

    def agree_before(self, i: np.ndarray, j: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """How many words before i and before j (i < j, of one document that begins at begin) are the same."""
        i, j = i.copy(), j.copy()
        start = i.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            a = np.flatnonzero(i - (1 << k) >= begin)
            a = a[self.levels[k][i[a] - (1 << k)] == self.levels[k][j[a] - (1 << k)]]
            i[a] -= 1 << k
            j[a] -= 1 << k
        return start - i


def minima(values: np.ndarray) -> list[np.ndarray]:
    """A sparse table: at level k the minimum of the 2**k values from each place on."""
    out = [values]
    while 2 << (len(out) - 1) <= len(values):
        half = 1 << (len(out) - 1)
        out.append(np.minimum(out[-1][:-half], out[-1][half:]))
    return out


def least(table: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The minimum of values lo .. hi - 1, for lo < hi."""
    k = np.frexp((hi - lo).astype(np.float64))[1] - 1
    out = np.empty(len(lo), table[0].dtype)
    for level in np.unique(k):
        at = np.flatnonzero(k == level)
        out[at] = np.minimum(table[level][lo[at]], table[level][hi[at] - (1 << int(level))])
    return out


def nearest_smaller(table: list[np.ndarray]) -> np.ndarray:
    """For each place the last place before it with a smaller value, or -1."""
    values = table[0]
    at = np.arange(len(values))  # values at .. place - 1 are all larger
    for k in range(len(table) - 1, -1, -1):
        live = np.flatnonzero(at >= 1 << k)
        live = live[table[k][at[live] - (1 << k)] > values[live]]
        at[live] -= 1 << k
    return at - 1


def previous_factors(sa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the text: length of the longest stretch from there that also begins earlier, and where it does.

    lcp[i]: how far suffixes sa[i - 1] and sa[i] agree (0 at the first one).
    """
    n = len(sa)
    best, source = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    for flip in (False, True):
        places = sa[::-1] if flip else sa
        # between[i]: agreement of places[i] and places[i + 1]
        between = lcp[:0:-1] if flip else lcp[1:]
        before = nearest_smaller(minima(places))
        at = np.flatnonzero(before >= 0)
        length = least(minima(between), before[at], at) if len(at) else np.empty(0, np.int64)
        place = places[at]
        better = length > best[place]
        best[place[better]], source[place[better]] = length[better], places[before[at[better]]]
    return best, source


def blocks(best: np.ndarray, begin: int, end: int) -> list[int]:
    """Starts of the Lempel-Ziv blocks of a document, and its end."""
    out, at = [], begin
    steps = np.maximum(best[begin:end], 1).tolist()
    while at < end:
        out.append(at)
        at += steps[at - begin]
    out.append(end)
    return out


def _spread(n: np.ndarray) -> np.ndarray:
    """0 .. n[0] - 1, 0 .. n[1] - 1, ..."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def at_boundaries(names: Names, starts: np.ndarray, before: np.ndarray, behind: np.ndarray, begin: np.ndarray, shortest: int) -> np.ndarray:
    """Rows (start, end, period) of the runs that touch a boundary; starts: the boundaries, with the sizes of the blocks
    before and behind and the start of their document."""
    n = np.minimum(before + behind - 1, starts - begin)
    n = np.maximum(n, 0)
    p = _spread(n) + 1
    s, first = np.repeat(starts, n), np.repeat(begin, n)
    found = [np.empty((0, 3), np.int64)]
    for x in (s, s - p):
        # Matches about x at distance p: at least shortest / 2 of them, so some of the three behind or before x begin one.
        end = names.ends[np.minimum(first, names.n - 1)]
        good = np.zeros(len(x), bool)
        for shift in (0, -(shortest // 4)):
            a = np.flatnonzero((x + shift >= first) & (x + shift + p < end))
            pair = names.levels[min(1, len(names.levels) - 1)]
            good[a[pair[x[a] + shift] == pair[x[a] + shift + p[a]]]] = True
        at = np.flatnonzero(good & (x + p <= end))
        i, q = x[at], p[at]
        ahead, back = names.agree(i, i + q), names.agree_before(i, i + q, first[at])
        length = ahead + back + q
        keep = (length >= 2 * q) & (length >= shortest)
        found.append(np.stack((i - back, i + ahead + q, q), axis=1)[keep])
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[new]


def copied(found: list[tuple[int, int, int]], cuts: list[int], source: np.ndarray) -> list[tuple[int, int, int]]:
    """found (by start) and the runs inside blocks, which their block's source has too."""
    bucket: dict[int, list[tuple[int, int]]] = {}
    for b, e, q in found:
        bucket.setdefault(b, []).append((e, q))
    starts = sorted(bucket)
    for s, z in zip(cuts[:-1], cuts[1:], strict=True):
        if z - s <= SHORTEST or not starts:
            continue
        j = int(source[s])
        at = bisect_right(starts, j)
        # The source may run into the block, so what is copied may be copied again.
        while at < len(starts) and starts[at] < j + z - s:
            for e, q in [x for x in bucket[starts[at]] if x[0] < j + z - s]:
                b = starts[at] + s - j
                if b not in bucket:
                    bucket[b] = []
                    insort(starts, b)
                if (e + s - j, q) not in bucket[b]:
                    bucket[b].append((e + s - j, q))
            at += 1
    return sorted((b, e, q) for b, x in bucket.items() for e, q in x)


def runs_of(docs: list[list[int]], shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """For each document (a list of numbers from 0 without gaps): (start, length, period) of its runs, in order."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    sizes = np.array([len(d) for d in docs], np.int64)
    if not sizes.sum():
        return out
    offs = np.concatenate(([0], np.cumsum(sizes)))
    flat = np.concatenate([np.array(d, np.int64) for d in docs])
    doc = np.repeat(np.arange(len(docs)), sizes)
    symbols = flat + np.repeat(np.concatenate(([0], np.cumsum([max(d, default=-1) + 1 for d in docs])))[:-1], sizes)
    again = repeats(symbols, offs[1:][doc], shortest // 2)
    some = np.flatnonzero(np.bincount(doc[again], minlength=len(docs)))
    if not len(some):
        return out
    pick = np.isin(doc, some)
    sizes = sizes[some]
    symbols, offs = symbols[pick], np.concatenate(([0], np.cumsum(sizes)))
    names = Names(symbols, np.repeat(offs[1:], sizes))
    sa = names.suffixes()
    lcp = np.zeros(len(sa), np.int64)
    a, b = np.minimum(sa[1:], sa[:-1]), np.maximum(sa[1:], sa[:-1])
    same = np.flatnonzero(names.ends[a] == names.ends[b])
    lcp[1:][same] = names.agree(a[same], b[same])
    best, source = previous_factors(sa, lcp)
    cuts = [blocks(best, int(offs[i]), int(offs[i + 1])) for i in range(len(some))]
    columns = [[], [], [], []]
    for c, begin in zip(cuts, offs[:-1].tolist(), strict=True):
        width = np.diff(np.array(c))
        columns[0].append(np.array(c[1:])), columns[1].append(width)
        columns[2].append(np.concatenate((width[1:], [0]))), columns[3].append(np.full(len(width), begin))
    found = at_boundaries(names, *(np.concatenate(c) for c in columns), shortest)
    cut = np.searchsorted(found[:, 0], offs)
    for i, d in enumerate(some.tolist()):
        mine = list(map(tuple, found[cut[i] : cut[i + 1]].tolist()))
        if mine:
            out[d] = [(b - int(offs[i]), e - b, q) for b, e, q in copied(mine, cuts[i], source)]
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    gone = np.cumsum(cover[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def _find(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(ids: list[pa.Array], lists: list[list[bytes]]) -> pa.RecordBatch:
            found = runs_of([numbered(w) for w in lists], shortest)
            left = [collapsed(w, r).decode() for w, r in zip(lists, found, strict=True)]
            told = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
            return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.array([len(w) for w in lists], pa.int64()), pa.array(told, _RUN_TYPE), pa.array(left, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

        for b in batches:
            ids, texts, at, size = b.column("doc_id"), b.column("_text"), 0, 0
            lists: list[list[bytes]] = []
            for i in range(b.num_rows):
                words = (texts[i].as_py() or "").encode().split()
                lists.append(words)
                size += len(words)
                if size >= STRETCH:
                    yield done([ids.slice(at, i + 1 - at)], lists)
                    lists, at, size = [], i + 1, 0
            if lists:
                yield done([ids.slice(at)], lists)

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed (the text without what repeats
    inside a run, words joined by one space) of each row; narrow, nothing moves."""
    if shortest < 8:
        raise ValueError("runs of fewer than 8 words aren't looked for")
    common.ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(common.tidy(_find(shortest)), f"doc_id long, n_words long, runs {_RUN}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text of documents, where one in ten (by a checksum of its id) has its words from some place on repeated."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", common.SPACE), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n, g = F.size("w"), F.col("g")
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    rows = rows.withColumns({"a": F.when(n > 0, a), "p": F.when(n > 0, p)})
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("w", place(i))), " ")
    return rows.select("doc_id", F.when(n > 0, again).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The longest run of each row (ties: smallest start, then period) and digests of all runs and of the collapsed text."""
    ordered: Column = F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    rows = found.withColumn("top", F.array_max(ordered))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.s")).alias("start"), F.col("top.n").alias("length"), (-F.col("top.p")).alias("period"),
        F.floor(F.col("top.n") * 1000 / -F.col("top.p")).cast("long").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
