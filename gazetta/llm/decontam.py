"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

Texts are sequences of words (runs of letters and digits, A-Z lower-cased). A passage is a leak of an item of n words if
its word edit distance is at most EDITS * n.

1. Windows. An item of n words within e = int(EDITS * n) edits keeps at least one of its word grams of g words, as each
   edit breaks g of its n - g + 1 grams at most and g * e < n - g + 1 for g = gram_size(n): three words, two for
   items of five. So windows of n words are laid wherever a gram of the item occurs, at the start that its
   offset in the item implies. This loses nothing and leaves few windows of a text.
2. CGK embedding. WALKS random walks read window and item: at each step the walk notes the word under it and moves on if
   a random bit of (step, word) says so. Few edits give a small Hamming distance. A walk takes SPAN * n steps, as it reads
   a word for every two; longer ones would compare the padding past both ends.
3. Bit sampling. tables(n) keys for each walk, of SAMPLED coordinates each; an item and a window with a key in common are
   candidates. Of windows with as many edits as are allowed, 93 to 100 % are (measured at 5 to 400 words, one window a
   passage, 8 tables), of unrelated windows 0.3 to 19 %.
4. Verification. Exact edit distance of the item to the best passage about the window.

Items are sent to the workers in blocks of BLOCK_ITEMS items and BLOCK_BYTES bytes at most, one pass over the documents for
each. With several blocks a pass is written to the shared folder before the next block is fetched, so that driver and
workers hold one block at a time. Documents stay where they are: no shuffle.

Edge cases: null and empty texts and items never match; items below five words are matched as a whole; repeated
items and rows match each for itself; a document's hits on one item are told once, by its best passage; an empty table
gives no rows; other columns are not looked at. decontaminate drops rows, not ids: a clean row that shares its id with a
contaminated one stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm import common
from gazetta.llm.textkernel import PUNCTUATION, mix, slices, word_hashes, words

EDITS, GRAM = 0.2, 3
WALKS, SAMPLED, SPAN = 16, 3, 1.5
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20
#: Windows that are embedded at once, at least where a task has so many.
WINDOWS = 20_000
_GRAM_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def allowed(n: int) -> int:
    return int(EDITS * n)


def gram_size(n: int) -> int:
    """The longest grams, GRAM words at most, of which an item of n words within allowed(n) edits keeps one."""
    return max(g for g in range(1, min(GRAM, n) + 1) if g * allowed(n) < n - g + 1)


def grams(w: np.ndarray, g: int) -> np.ndarray:
    h = np.full(max(0, len(w) - g + 1), g, np.uint64)
    for i in range(g):
        h = mix(h * _GRAM_MULTIPLIER + w[i : len(w) - g + 1 + i])
    return h


def sequences(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For parts of a column: number of the first text, word hashes of all its texts, and where each text's begin."""
    for first, raw, offs in slices(column):
        starts, ends, text = words(raw, offs, PUNCTUATION)
        yield first, word_hashes(raw, starts, ends), np.searchsorted(text, np.arange(len(offs)))


def edit_distance(item: list[int], text: list[int], most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the passage of text nearest to item, if within `most`; earliest among equals."""
    there = set(text)
    if sum(a not in there for a in item) > most:  # each of these words costs an edit
        return None
    row = [(0, j) for j in range(len(text) + 1)]
    for i, a in enumerate(item, 1):
        now = [(i, 0)]
        least = i
        for j, b in enumerate(text, 1):
            d, s = row[j - 1]
            best = (d + (a != b), s)
            if (up := row[j])[0] + 1 < best[0]:
                best = (up[0] + 1, up[1])
            if (left := now[j - 1])[0] + 1 < best[0]:
                best = (left[0] + 1, left[1])
            now.append(best)
            least = min(least, best[0])
        if least > most:
            return None
        row = now
    d, end = min((x[0], j) for j, x in enumerate(row))
    return (d, row[end][1], end) if d <= most else None


def tables(n: int) -> int:
    return 8 + n // 40


def embed(x: np.ndarray, walk: int) -> np.ndarray:
    """CGK embedding of rows of n word hashes: SPAN * n symbols each; past its end a row reads 0."""
    m, n = x.shape
    steps = max(1, int(SPAN * n))
    padded = np.concatenate((x, np.zeros((m, 1), np.uint64)), axis=1)
    at, rows, out = np.zeros(m, np.int64), np.arange(m), np.empty((m, steps), np.uint64)
    for j in range(steps):
        symbol = padded[rows, at]
        out[:, j] = symbol
        salt = np.uint64((walk * 1_000_003 + j) * 0x9E3779B97F4A7C15 % (1 << 64))
        at = np.minimum(at + (mix(symbol ^ salt) & np.uint64(1)).astype(np.int64), n)
    return out


def keys(x: np.ndarray) -> np.ndarray:
    """The LSH keys of rows of n word hashes: one column for each walk and table."""
    n = x.shape[1]
    out = []
    for walk in range(WALKS):
        e = embed(x, walk)
        pick = np.random.default_rng([n, walk]).integers(0, e.shape[1], (tables(n), SAMPLED))
        for t in range(tables(n)):
            h = np.full(len(x), t, np.uint64)
            for c in pick[t]:
                h = mix(h * _GRAM_MULTIPLIER + e[:, c])
            out.append(h)
    return np.stack(out, axis=1) if len(x) else np.empty((0, WALKS * tables(n)), np.uint64)


class Matcher:
    """The items of a block, ready to be looked for."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.items = ids, [None] * len(ids)
        for first, w, cuts in sequences(pa.array(texts, pa.string())):
            for i in range(len(cuts) - 1):
                self.items[first + i] = w[cuts[i] : cuts[i + 1]]
        hashes, lengths, offsets = [], [], []
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(self.items):
            if len(w):
                by_size.setdefault(len(w), []).append(i)
                h = grams(w, gram_size(len(w)))
                hashes.append(h), lengths.append(np.full(len(h), len(w))), offsets.append(np.arange(len(h)))
        gram, length, offset = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((hashes, np.uint64), (lengths, np.int64), (offsets, np.int64)))
        # A window depends on the item's length and the gram's place in it: a gram that many items have asks for each once.
        order = np.lexsort((length, offset, gram))
        gram, length, offset = gram[order], length[order], offset[order]
        new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (offset[1:] != offset[:-1]) | (length[1:] != length[:-1]))) if len(gram) else np.empty(0, bool)
        self.gram, self.length, self.offset = gram[new], length[new], offset[new]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.gram & np.uint64(self.maybe.size - 1)).astype(np.int64)] = True
        self.sizes = sorted({gram_size(n) for n in by_size})
        self.tables = {n: (np.array(members), keys(np.stack([self.items[i] for i in members]))) for n, members in by_size.items()}

    def windows(self, w: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, start (in w, may lie before the text) and length of the windows that some item's grams ask for."""
        found = []
        for g in self.sizes:
            h = grams(w, g)
            at = np.flatnonzero(self.maybe[(h & np.uint64(self.maybe.size - 1)).astype(np.int64)])
            text = np.searchsorted(cuts, at, "right") - 1
            inside = at + g <= cuts[np.minimum(text + 1, len(cuts) - 1)]
            at, text = at[inside], text[inside]
            lo, hi = np.searchsorted(self.gram, h[at], "left"), np.searchsorted(self.gram, h[at], "right")
            n = hi - lo
            entry = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append(np.stack((np.repeat(text, n), np.repeat(at, n) - self.offset[entry], self.length[entry]), axis=1))
        f = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 3), np.int64)
        return f[:, 0], f[:, 1], f[:, 2]

    def candidates(self, x: np.ndarray) -> Iterator[tuple[int, int]]:
        """(row, item) of rows of n word hashes that share a key with an item of n words."""
        members, theirs = self.tables[x.shape[1]]
        ours = keys(x)
        seen: set[tuple[int, int]] = set()
        for t in range(ours.shape[1]):
            order = np.argsort(theirs[:, t], kind="stable")
            k = theirs[order, t]
            lo, hi = np.searchsorted(k, ours[:, t], "left"), np.searchsorted(k, ours[:, t], "right")
            for row in np.flatnonzero(hi > lo):
                seen.update((int(row), int(members[order[i]])) for i in range(lo[row], hi[row]))
        return iter(sorted(seen))


def _matches(source, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(*source.value)
        pending: list[tuple] = []  # (row key, window with margins, margin before, n)
        best: dict = {}

        def settle() -> Iterator[pa.RecordBatch]:
            by_size: dict[int, list[tuple]] = {}
            for p in pending:
                by_size.setdefault(p[3], []).append(p)
            for n, group in by_size.items():
                x = np.stack([core for _, _, core, *_ in group])
                for row, item in matcher.candidates(x):
                    doc, around, _, _, begin = group[row]
                    key = doc[0], item
                    if key in best and best[key][0] == 0:
                        continue
                    hit = edit_distance(matcher.items[item].tolist(), around.tolist(), allowed(n))
                    if hit and (key not in best or hit[0] < best[key][0]):
                        best[key] = hit[0], begin + hit[1], begin + hit[2], doc[1], n
            pending.clear()
            rows = [(*doc, matcher.ids[item], d, n, s, e) for (_, item), (d, s, e, doc, n) in best.items()]
            best.clear()
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], id_type)] + [pa.array(c, pa.int64()) for c in cols[1:]], ["doc_id", "text_key", "item_id", "edits", "item_words", "first_word", "end_word"])

        number = 0
        for b in batches:
            ids, text_keys = b.column("doc_id"), b.column("text_key").to_pylist()
            for first, w, cuts in sequences(b.column("_text")):
                text, start, size = matcher.windows(w, cuts)
                for t, s, n in zip(text.tolist(), start.tolist(), size.tolist(), strict=True):
                    lo, hi, slack = cuts[t], cuts[t + 1], allowed(n)
                    core = np.zeros(n, np.uint64)
                    a, z = max(s, lo), min(s + n, hi)
                    core[a - s : z - s] = w[a:z]
                    a, z = max(s - slack, lo), min(s + n + slack, hi)
                    pending.append(((number + first + t, (ids[first + t].as_py(), text_keys[first + t])), w[a:z].copy(), core, n, int(a - lo)))
                if len(pending) >= WINDOWS:
                    yield from settle()  # a document's windows come from one slice, so it is settled at once
            number += b.num_rows
        yield from settle()

    return run


def _hits(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    """The columns of contaminated(), with the text key of the row."""
    spark = docs.sparkSession
    common.ship(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("_text"))
    id_type = rows.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = f"doc_id {id_type.simpleString()}, text_key long, item_id long, edits long, item_words long, first_word long, end_word long"
    parts: list[DataFrame] = []

    def look(block: tuple, last: bool) -> None:
        held = spark.sparkContext.broadcast(block)
        found = rows.mapInArrow(common.tidy(_matches(held, to_arrow_type(id_type))), schema)
        if parts or not last:
            found = common.saved(found, "hits")[0]
            held.destroy()
        parts.append(found)

    block, size = ([], []), 0
    known = items.where(F.col(item_text_col).isNotNull()).select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t"))
    for r in known.toLocalIterator():
        if block[0] and (len(block[0]) == BLOCK_ITEMS or size + len(r.t) > BLOCK_BYTES):
            look(block, False)
            block, size = ([], []), 0
        block[0].append(r.i), block[1].append(r.t)
        size += len(r.t)
    look(block, True)
    return reduce(DataFrame.unionByName, parts)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, edits, item_words, first_word, end_word: one row for each document and item found in it."""
    return _hits(docs, items, id_col, text_col, item_col, item_text_col).drop("text_key")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs without the rows in which an item was found; all columns stay."""
    hit = _hits(docs, items, id_col, text_col, item_col, item_text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text_key").distinct()
    return common.without_rows(docs, id_col, text_col, common.saved(hit, "contaminated")[0])
