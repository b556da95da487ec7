"""Removing repeated passages of words: windows of WINDOW words, partitioned by minimisers as super-k-mers.

A word goes if a window of WINDOW words that covers it also starts in a document of a smaller doc_id. Words are separated
by U+0020 and U+0009 to U+000D, of which kept texts have one space.

1. A window's *minimiser* is its word gram (GRAM words) of smallest hash, the first one of equals. Equal windows have equal
   minimisers. Each block of documents tells its distinct minimisers; those of two documents or blocks go on, and are
   joined back to the blocks that have them. Most text ends here.
2. Consecutive windows about one minimiser are a *super-k-mer*, packed as one string. Each block sends its distinct strings
   of wanted minimisers, with the smallest doc_id of each, to the bucket of the minimiser.
3. A bucket sorts the windows of its distinct strings (by hash; equal hashes are compared by bytes), which tells the windows
   that are equal and the smallest doc_id of each. Blocks get the answers for their strings, told by 128-bit digests.
4. Minimisers with more than HOT strings would fill a bucket: their windows go one by one, as 128-bit digests with a
   doc_id, through Spark's own aggregation (partial sums before the shuffle) and are joined back.
5. The block walks its documents again and removes what the answers cover.

A passage that a third of all documents share costs an entry a block, not a document. Matches never cross documents.

Edge cases: a null text has no words; texts of fewer words than a window stay; documents of equal doc_id don't remove each
other's words; a null doc_id counts as larger than all others; repeated rows get a row each; very long texts are worked on
whole; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm import common
from gazetta.llm.suffix_dedup import _documents, _packed, _rows
from gazetta.llm.textkernel import mix, word_hashes, words

WINDOW, GRAM = 50, 10
#: Bytes of text in a block, on average; strings of a bucket, on average; strings from which a minimiser is hot.
BLOCK_BYTES, BUCKET, HOT = 4 << 20, 8_000, 30_000
#: Words that are cut at once, at least where a block has so many.
STRETCH = 1 << 18
_NO_ID = np.iinfo(np.int64).max
_PLACE = np.uint64(28)  # low bits of a gram's key: its place
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
#: An entry: a string's digest, size, minimiser and smallest id, and whether the block has it under several ids.
ENTRY = np.dtype([("a", "<u8"), ("b", "<u8"), ("print", "<u8"), ("size", "<u4"), ("id", "<i8"), ("several", "?")])
#: An answer: windows first .. first + n - 1 of a string, and the smallest id that has them.
ANSWER = np.dtype([("a", "<u8"), ("b", "<u8"), ("print", "<u8"), ("first", "<u4"), ("n", "<u4"), ("id", "<i8")])


def normal(text: bytes) -> bytes:
    """The words of a text joined by single spaces."""
    return b" ".join(text.split())


def digest(string: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(string, digest_size=16).digest()
    return int.from_bytes(d[:8], "little"), int.from_bytes(d[8:], "little")


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words, from the words' hashes: runs of 2, 4, ... words are put together."""
    parts, size, at, out = h, 1, 0, None
    while size <= n:
        if n & size:
            piece = parts[at:]
            out = piece if out is None else mix(out[: len(piece)] * _MULTIPLIER + piece)
            at += size
        parts = mix(parts[: max(0, len(parts) - size)] * _MULTIPLIER + parts[size:] + np.uint64(size))
        size *= 2
    return out[: max(0, len(h) - n + 1)]


class Pieces:
    """The super-k-mers of documents: document, first and last byte, minimiser of each, and the starts of its words."""

    def __init__(self, texts: list[bytes]):
        """texts: normal."""
        found = [(np.empty(0, np.int64),) * 5 + (np.empty(0, np.uint64),)]
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size < STRETCH * 6):
                size += len(texts[j])
                j += 1
            found.append(self._cut(texts[i:j], i))
            i = j
        self.doc, self.start, self.end, self.first, self.n, self.print = (np.concatenate(x) for x in zip(*found, strict=True))

    @staticmethod
    def _cut(texts: list[bytes], number: int) -> tuple[np.ndarray, ...]:
        raw = np.frombuffer(b"".join(texts), np.uint8)
        offs = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        starts, ends, doc = words(raw, offs)
        none = (np.empty(0, np.int64),) * 5 + (np.empty(0, np.uint64),)
        if len(starts) < WINDOW:
            return none
        g = grams(word_hashes(raw, starts, ends, lower=False), GRAM)
        key = (g >> _PLACE << _PLACE) | np.arange(len(g), dtype=np.uint64)
        width, span = WINDOW - GRAM + 1, 1
        while 2 * span <= width:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        if span < width:
            key = np.minimum(key[: len(key) - (width - span)], key[width - span :])
        # key[i] is now the least of window i; windows that run over a document's end don't count.
        n = len(key)
        good = doc[:n] == doc[WINDOW - 1 : WINDOW - 1 + n]
        opens = good.copy()
        opens[1:] &= (key[1:] != key[:-1]) | ~good[:-1]
        closes = good.copy()
        closes[:-1] &= opens[1:] | ~good[1:]
        first, last = np.flatnonzero(opens), np.flatnonzero(closes)
        base = offs[doc[first]]
        word = first - np.searchsorted(doc, doc[first])  # number of the word in its document
        place = (key[first] & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64)
        return number + doc[first], starts[first] - base, ends[last + WINDOW - 1] - base, word, last - first + 1, g[place]


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct minimisers of a batch's documents by block, with how often each is there and whether in two documents."""
    for b in batches:
        p = Pieces([normal((x.as_py() or "").encode()) for x in b.column("_text")])
        if not len(p.doc):
            continue
        block = b.column("block").to_numpy()[p.doc]
        order = np.lexsort((p.doc, p.print, block))
        block, fp, doc = block[order], p.print[order], p.doc[order]
        first = np.flatnonzero(np.concatenate(([True], (fp[1:] != fp[:-1]) | (block[1:] != block[:-1]))))
        twice = np.maximum.reduceat(doc, first) != doc[first]
        yield pa.RecordBatch.from_arrays([pa.array(block[first], pa.int32()), pa.array(fp[first].view(np.int64)), pa.array(twice), pa.array(np.diff(np.concatenate((first, [len(fp)]))), pa.int32())], ["block", "print", "twice", "n"])


def _texts(docs: pa.Table) -> tuple[list, np.ndarray, list[bytes]]:
    ids, order, texts = _documents(docs) if docs.num_rows else ([], np.empty(0, np.int64), [])
    return ids, order, [normal(t) for t in texts]


def _windows(text: bytes) -> list[bytes]:
    """The windows of a super-k-mer."""
    w = text.split(b" ")
    return [b" ".join(w[i : i + WINDOW]) for i in range(len(w) - WINDOW + 1)]


def _told(names: dict[bytes, list]) -> np.ndarray:
    e = np.empty(len(names), ENTRY)
    for i, (text, (fp, owner, several)) in enumerate(names.items()):
        e[i] = (*digest(text), fp, len(text), owner, several)
    return e


def _strings(buckets: int):
    """A block's distinct strings of wanted minimisers by bucket, and the windows of hot ones."""
    import zstandard

    def run(key: tuple, docs: pa.Table, wanted: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if wanted.num_rows and docs.num_rows:
            prints = wanted.column("print").to_numpy().view(np.uint64)
            order = np.argsort(prints)
            prints, hot = prints[order], wanted.column("hot").to_numpy(zero_copy_only=False)[order]
            _, ids, texts = _texts(docs)
            p = Pieces(texts)
            at = np.minimum(np.searchsorted(prints, p.print), len(prints) - 1)
            hit = np.flatnonzero(prints[at] == p.print)
            distinct: tuple[dict, dict] = ({}, {})
            for d, s, z, fp, h in zip(p.doc[hit].tolist(), p.start[hit].tolist(), p.end[hit].tolist(), p.print[hit].tolist(), hot[at[hit]].tolist(), strict=True):
                text, owner = texts[d][s:z], ids[d]
                for t in _windows(text) if h else (text,):
                    known = distinct[h].get(t)
                    if known is None:
                        distinct[h][t] = [fp, owner, False]
                    elif known[1] != owner:
                        known[1:] = min(known[1], owner), True
            pack, e, all_texts = zstandard.ZstdCompressor(level=3).compress, _told(distinct[0]), list(distinct[0])
            bucket = (mix(e["print"]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)])) if len(order) else [0]
            for s, z in zip(cuts[:-1], cuts[1:], strict=True):
                rows.append((int(bucket[order[s]]), key[0].as_py(), e[order[s:z]].tobytes(), pack(b"".join([all_texts[i] for i in order[s:z].tolist()]))))
            if distinct[1]:
                rows.append((None, key[0].as_py(), _told(distinct[1]).tobytes(), None))
        return pa.Table.from_batches([_rows(["bucket", "block", "entries", "z"], [pa.int64(), pa.int32(), pa.binary(), pa.binary()], rows)])

    return run


def equal_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For the windows of distinct strings, in order: number of its group of equal windows; and of its string."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    starts, ends, doc = words(raw, offs)
    h = grams(word_hashes(raw, starts, ends, lower=False), WINDOW)
    good = np.flatnonzero(doc[: len(h)] == doc[WINDOW - 1 :])
    h, s, z = h[good], starts[good], ends[good + WINDOW - 1]
    order = np.argsort(h, kind="stable")
    a, b = order[:-1], order[1:]
    same = h[a] == h[b]
    at = np.flatnonzero(same)
    # Windows of equal hash are compared, eight bytes at a time.
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    low = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    x, y, size = s[a[at]], s[b[at]], z[a[at]] - s[a[at]]
    equal, live, off = size == z[b[at]] - s[b[at]], np.arange(len(at)), 0
    while len(live := live[equal[live] & (size[live] > off)]):
        m = low[np.minimum(size[live] - off, 8)]
        equal[live] = (eight[x[live] + off] & m) == (eight[y[live] + off] & m)
        off += 8
    group = np.empty(len(h), np.int64)
    group[order] = np.concatenate(([0], np.cumsum(~same)))
    if not equal.all():  # different windows of one hash: told by their words
        odd = np.isin(group, group[b[at[~equal]]])
        names: dict[tuple, int] = {}
        for i in np.flatnonzero(odd).tolist():
            group[i] = len(h) + names.setdefault((int(group[i]), raw[s[i] : z[i]].tobytes()), len(names))
    return group, doc[good]


def _answers(key: tuple, group: pa.Table) -> pa.Table:
    """A bucket's answers to each block: stretches of windows of a string with the smallest id that has them."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    index: dict[bytes, int] = {}
    ids: list[int] = []
    asked = []
    for block, e, z in zip(group.column("block").to_pylist(), group.column("entries"), group.column("z"), strict=True):
        e, body, at, k = np.frombuffer(e.as_buffer(), ENTRY), unpack(z.as_py()), 0, []
        for n, i in zip(e["size"].tolist(), e["id"].tolist(), strict=True):
            text = body[at : at + n]
            at += n
            of = index.setdefault(text, len(ids))
            if of == len(ids):
                ids.append(i)
            elif i < ids[of]:
                ids[of] = i
            k.append(of)
        asked.append((block, e, np.array(k, np.int64)))
    windows, string = equal_windows(list(index))
    owner = np.array(ids, np.int64)[string]
    order = np.lexsort((owner, windows))
    first = np.concatenate(([True], windows[order][1:] != windows[order][:-1]))
    least = np.empty(len(order), np.int64)
    least[order] = owner[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    # Stretches of equal answers in a string.
    begin = np.searchsorted(string, np.arange(len(ids) + 1))
    opens = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (string[1:] != string[:-1]))))
    n, of, answer = np.diff(np.concatenate((opens, [len(least)]))), string[opens], least[opens]
    lo = np.searchsorted(of, np.arange(len(ids) + 1))
    rows = []
    for block, e, k in asked:
        many = lo[k + 1] - lo[k]
        at = np.repeat(lo[k] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        who = np.repeat(np.arange(len(k)), many)
        useful = (answer[at] < e["id"][who]) | e["several"][who]
        at, who = at[useful], who[useful]
        if len(at):
            r = np.empty(len(at), ANSWER)
            for name in ("a", "b", "print"):
                r[name] = e[name][who]
            r["first"], r["n"], r["id"] = opens[at] - begin[of[at]], n[at], answer[at]
            rows.append((block, r.tobytes()))
    return pa.Table.from_batches([_rows(["block", "answers"], [pa.int32(), pa.binary()], rows)])


def _hot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for block, x in zip(b.column("block").to_pylist(), b.column("entries"), strict=True):
            e = np.frombuffer(x.as_buffer(), ENTRY)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(e), block), pa.int32()), *(pa.array(e[c].view(np.int64)) for c in ("a", "b", "print")), pa.array(e["id"]), pa.array(e["several"])], ["block", "a", "b", "print", "id", "several"])


def _hot_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        r = np.empty(b.num_rows, ANSWER)
        for name in ("a", "b", "print"):
            r[name] = b.column(name).to_numpy().view(np.uint64)
        r["first"], r["n"], r["id"] = 0, 1, b.column("least").to_numpy()
        block = b.column("block").to_numpy()
        yield _rows(["block", "answers"], [pa.int32(), pa.binary()], [(int(x), r[block == x].tobytes()) for x in np.unique(block)])


def _cover(texts: list[bytes], order: np.ndarray, answers: np.ndarray, hot: set[int]) -> list[np.ndarray]:
    """For each text the starts (word) and ends of what goes."""
    gone: list[list[tuple[int, int]]] = [[] for _ in texts]
    if not len(answers):
        return [np.empty((0, 2), np.int64)] * len(texts)
    by: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for a, b, _, first, n, i in answers.tolist():
        by.setdefault((a, b), []).append((first, n, i))
    prints = np.unique(answers["print"])
    p = Pieces(texts)
    at = np.minimum(np.searchsorted(prints, p.print), len(prints) - 1)
    for k in np.flatnonzero(prints[at] == p.print).tolist():
        d, word = int(p.doc[k]), int(p.first[k])
        text, mine = texts[d][p.start[k] : p.end[k]], order[d]
        found = by.get(digest(text), []) if int(p.print[k]) not in hot else [(j, 1, i) for j, t in enumerate(_windows(text)) for _, _, i in by.get(digest(t), [])]
        gone[d] += [(word + first, word + first + n + WINDOW - 1) for first, n, i in found if i < mine]
    return [np.array(x, np.int64).reshape(-1, 2) for x in gone]


def _kept(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
    """A block's documents without what the answers cover."""
    ids, order, texts = _texts(docs)
    told = [np.frombuffer(x.as_buffer(), ANSWER) for x in answers.column("answers")] if answers.num_rows else []
    hot = {int(x) for r, h in zip(told, answers.column("hot").to_pylist() if told else [], strict=True) if h for x in np.unique(r["print"])}
    out = []
    for name, text, spans in zip(ids, texts, _cover(texts, order, np.concatenate(told) if told else np.empty(0, ANSWER), hot), strict=True):
        n = text.count(b" ") + 1 if text else 0
        removed = 0
        if len(spans):
            cover = np.zeros(n + 1, np.int64)
            np.add.at(cover, spans[:, 0], 1)
            np.add.at(cover, spans[:, 1], -1)
            goes = np.cumsum(cover[:-1]) > 0
            removed = int(goes.sum())
            text = b" ".join([w for w, g in zip(text.split(b" "), goes.tolist(), strict=True) if not g])
        out.append((name, n, removed, text.decode()))
    return pa.Table.from_batches([_rows(["doc_id", "n_words", "n_removed", "kept"], [pa.int64()] * 3 + [pa.string()], out)])


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) of each row."""
    spark = docs.sparkSession
    common.ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length("_text")), F.lit(blocks)).cast("int"))
    seen, seen_at = common.saved(rows.mapInArrow(common.tidy(_prints), "block int, print long, twice boolean, n int"), "prints")
    shared = seen.groupBy("print").agg(F.count(F.lit(1)).alias("m"), F.max("twice").alias("twice"), F.sum("n").alias("n")).where("twice OR m > 1")
    wanted = seen.select("block", "print").join(shared.select("print", (F.col("n") > hot).alias("hot"), "n").hint("merge"), "print").groupBy("block", "print").agg(F.max("hot").alias("hot"), F.max("n").alias("n"))
    wanted, wanted_at = common.saved(wanted.select("block", "print", "hot", "n"), "wanted")
    strings = wanted.where("NOT hot").count()
    buckets = max(1, -(-strings // BUCKET))
    packed = rows.mapInArrow(_packed, "block int, ids array<long>, sizes array<long>, z binary")
    found, found_at = common.saved(packed.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(_strings(buckets), "bucket long, block int, entries binary, z binary"), "strings")
    answers = found.where("bucket IS NOT NULL").groupBy("bucket").applyInArrow(_answers, "block int, answers binary").withColumn("hot", F.lit(False))
    one = found.where("bucket IS NULL").select("block", "entries").mapInArrow(_hot_rows, "block int, a long, b long, print long, id long, several boolean")
    least = one.groupBy("a", "b").agg(F.min("id").alias("least"))
    single = one.join(least.hint("merge"), ["a", "b"]).where("least < id OR several").mapInArrow(_hot_answers, "block int, answers binary").withColumn("hot", F.lit(True))
    answers, answers_at = common.saved(answers.unionByName(single), "answers")
    common.remove(spark, seen_at, wanted_at, found_at)
    schema = "doc_id long, n_words long, n_removed long, kept string"
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_kept, schema)
