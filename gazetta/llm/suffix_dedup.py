"""Removing repeated substrings: suffix arrays over shards of the text that can repeat.

A byte goes if a LENGTH-byte string that covers it also starts in a document of a smaller doc_id. Suffix arrays of shards
only see what is in the shard, so equal strings must meet in one:

1. Every window of LENGTH bytes names a *minimiser*, the GRAM-byte string of smallest hash in it; equal windows name
   equal minimisers. Fingerprints of the minimisers of each block of documents (told once a block) are dealt by value;
   those that two documents have are sent back to the blocks that have them. Most text ends here.
2. Consecutive windows with one minimiser are a *piece*. Each block sends its distinct pieces of shared minimisers, with
   the smallest doc_id that has each, to the shard that the minimiser's fingerprint names.
3. A shard joins its distinct pieces to one string, sorts its suffixes by induction, and computes, from the permuted
   common prefixes, which windows are equal and the smallest doc_id of each group. Each block gets the answers for its
   pieces, told by a 64-bit hash of the piece (a shard compares the bytes too, and fails on two pieces of one hash).
4. The block walks its documents again and removes what the answers cover.

A passage that a third of all documents share costs one entry a block, not one a document, in 1 to 3. Texts move twice,
packed. Matches never cross documents. Pieces are cut from a document alone, in the same way in each step.

Edge cases: a null text is empty; texts below LENGTH bytes stay; documents of equal doc_id don't remove each other's
bytes; a null doc_id counts as larger than all others; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm import common
from gazetta.llm.suffix_array import permuted_prefixes, suffix_array
from gazetta.llm.textkernel import mix, powers

LENGTH, GRAM = 50, 20
#: Bytes of text in a block, on average; windows that are looked at together.
BLOCK_BYTES, STRETCH = 3 << 20, 1 << 20
_NO_ID = np.iinfo(np.int64).max
_WHERE = np.uint64(24)  # low bits of a window's key: place of the minimiser
_SYMBOL = np.random.default_rng(1).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PIECE = np.dtype([("hash", "<u8"), ("size", "<u4"), ("id", "<i8"), ("several", "?")])
RUN = np.dtype([("hash", "<u8"), ("first", "<u4"), ("n", "<u4"), ("id", "<i8")])


def pieces(raw: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Document number, start, end, fingerprint and hash of the pieces of documents laid end to end, part by part.

    Long documents are cut at multiples of STRETCH windows from their own start, so cuts don't depend on neighbours.
    """
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + STRETCH, "right")) - 1)
        for a in range(int(offs[i]), int(offs[j]), STRETCH) if j == i + 1 else [int(offs[i])]:
            z = min(int(offs[j]), a + STRETCH + LENGTH - 1) if j == i + 1 else int(offs[j])
            if z - a >= LENGTH:
                yield from _pieces(raw[a:z], offs[i : j + 1], i, a)
        i = j


def _pieces(raw: np.ndarray, offs: np.ndarray, first: int, at: int) -> Iterator[tuple[np.ndarray, ...]]:
    n = len(raw)
    up, down = powers(n)
    c = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_SYMBOL[raw] * up[:-1], dtype=np.uint64)))
    key = mix((c[GRAM:] - c[:-GRAM]) * down[: n - GRAM + 1])
    key = (key >> _WHERE << _WHERE) | np.arange(len(key), dtype=np.uint64)
    width, span = LENGTH - GRAM + 1, 1
    while 2 * span <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < width:
        key = np.minimum(key[: len(key) - (width - span)], key[width - span :])
    # key[i] is now the least of window i; windows that run over a document's end don't count.
    docs = np.clip(offs - at, 0, n)
    doc = np.repeat(np.arange(len(docs) - 1), np.diff(docs))[: len(key)]
    good = np.arange(len(key)) + LENGTH <= docs[1:][doc]
    opens = good.copy()
    opens[1:] &= (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | ~good[:-1]
    closes = good.copy()
    closes[:-1] &= opens[1:] | ~good[1:]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + LENGTH
    if len(starts):
        value = mix((c[ends] - c[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        yield first + doc[starts], at + starts, at + ends, key[starts] >> _WHERE, value


def every_piece(raw: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    parts = list(pieces(raw, offs))
    if not parts:
        return [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)] * 2
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in texts]))).astype(np.int64)


def _rows(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names)


def _prints(buckets: int):
    """Fingerprints of a batch's documents, told once a block and dealt by value: (bucket, blocks, entries).

    blocks holds (block, number of entries) in the order of the entries, so a batch makes a row for each bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            block_of = b.column("block").to_numpy()
            doc, _, _, fp, _ = every_piece(*laid_out([(x.as_py() or "").encode() for x in b.column("_text")]))
            rows = []
            if len(fp):
                block = block_of[doc]
                order = np.lexsort((doc, fp, block, fp % np.uint64(buckets)))
                fp, doc, block = fp[order], doc[order], block[order]
                first = np.flatnonzero(np.concatenate(([True], (fp[1:] != fp[:-1]) | (block[1:] != block[:-1]))))
                twice = np.maximum.reduceat(doc, first) != doc[first]
                fp, block = fp[first], block[first].astype(np.int64)
                # 40 bits of fingerprint and a bit: six bytes are all that travels.
                packed = ((fp << np.uint64(1)) | twice).view(np.uint8).reshape(-1, 8)[:, :6]
                bucket = (fp % np.uint64(buckets)).astype(np.int64)
                cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(fp)]))
                for s, z in zip(cuts[:-1], cuts[1:], strict=True):
                    opens = np.concatenate(([0], np.flatnonzero(np.diff(block[s:z])) + 1, [z - s]))
                    told = np.stack((block[s:z][opens[:-1]], np.diff(opens)), axis=1).astype(np.uint32)
                    rows.append((int(bucket[s]), told.tobytes(), packed[s:z].tobytes()))
            yield _rows(["bucket", "blocks", "e"], [pa.int32(), pa.binary(), pa.binary()], rows)

    return run


def _shared(group: pa.Table) -> pa.Table:
    """Of a bucket's entries, the fingerprints that two documents have, by block."""
    prints, blocks = [], []
    for told, e in zip(group.column("blocks"), group.column("e"), strict=True):
        x = np.zeros((len(e.as_buffer()) // 6, 8), np.uint8)
        x[:, :6] = np.frombuffer(e.as_buffer(), np.uint8).reshape(-1, 6)
        prints.append(x.view(np.uint64)[:, 0])
        of = np.frombuffer(told.as_buffer(), np.uint32).reshape(-1, 2)
        blocks.append(np.repeat(of[:, 0].astype(np.int32), of[:, 1]))
    p, block = np.concatenate(prints), np.concatenate(blocks)
    order = np.argsort(p >> np.uint64(1), kind="stable")
    p, block = p[order], block[order]
    fp = p >> np.uint64(1)
    first = np.flatnonzero(np.concatenate(([True], fp[1:] != fp[:-1])))
    n = np.diff(np.concatenate((first, [len(fp)])))
    good = np.repeat((n > 1) | (np.bitwise_or.reduceat(p, first) & np.uint64(1) != 0), n)
    fp, block = fp[good], block[good]
    order = np.argsort(block, kind="stable")
    fp, block = fp[order], block[order]
    cuts = np.concatenate(([0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(fp)])) if len(fp) else [0]
    rows = [(int(block[s]), np.unique(fp[s:z]).tobytes()) for s, z in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.Table.from_batches([_rows(["block", "prints"], [pa.int32(), pa.binary()], rows)])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's documents by block: one compressed row for each block."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    for b in batches:
        blocks, ids, rows = b.column("block").to_numpy(), b.column("doc_id"), []
        texts = [(x.as_py() or "").encode() for x in b.column("_text")]
        for block in np.unique(blocks):
            at = np.flatnonzero(blocks == block)
            rows.append((int(block), [ids[int(i)].as_py() for i in at], [len(texts[i]) for i in at], pack(b"".join([texts[i] for i in at]))))
        yield _rows(["block", "ids", "sizes", "z"], [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()], rows)


def _documents(group: pa.Table) -> tuple[list, np.ndarray, list[bytes]]:
    """ids, the same with null as the largest, and texts of a block, in a fixed order."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    docs = []
    for ids, sizes, z in zip(group.column("ids").to_pylist(), group.column("sizes").to_pylist(), group.column("z"), strict=True):
        raw, at = unpack(z.as_py()), 0
        for i, n in zip(ids, sizes, strict=True):
            docs.append((_NO_ID if i is None else i, raw[at : at + n], i))
            at += n
    return [x[2] for x in docs], np.array([x[0] for x in docs], np.int64), [x[1] for x in docs]


def _candidates(shards: int):
    """A block's distinct pieces of shared minimisers, by shard."""
    import zstandard

    def run(key: tuple, docs: pa.Table, shared: pa.Table) -> pa.Table:
        names, types = ["shard", "block", "pieces", "z"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        rows: list[tuple] = []
        if shared.num_rows and docs.num_rows:
            prints = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in shared.column("prints")]))
            _, ids, texts = _documents(docs)
            raw, offs = laid_out(texts)
            doc, start, end, fp, value = every_piece(raw, offs)
            at = np.minimum(np.searchsorted(prints, fp), len(prints) - 1)
            hit = prints[at] == fp
            doc, start, end, fp, value = (x[hit] for x in (doc, start, end, fp, value))
            if len(doc):
                owner = ids[doc]
                shard = (mix(fp) % np.uint64(shards)).astype(np.int64)
                order = np.lexsort((owner, value, shard))
                value, owner, shard, start, end = (x[order] for x in (value, owner, shard, start, end))
                first = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (shard[1:] != shard[:-1]))))
                e = np.empty(len(first), PIECE)
                e["hash"], e["size"], e["id"] = value[first], (end - start)[first], owner[first]
                e["several"] = np.maximum.reduceat(owner, first) != owner[first]
                shard, start, end = shard[first], start[first], end[first]
                pack, body = zstandard.ZstdCompressor(level=3).compress, raw.tobytes()
                cuts = np.concatenate(([0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(e)]))
                for s, z in zip(cuts[:-1], cuts[1:], strict=True):
                    joined = b"".join([body[x:y] for x, y in zip(start[s:z].tolist(), end[s:z].tolist(), strict=True)])
                    rows.append((int(shard[s]), key[0].as_py(), e[s:z].tobytes(), pack(joined)))
        return pa.Table.from_batches([_rows(names, types, rows)])

    return run


def least_ids(parts: list[bytes], ids: np.ndarray) -> list[np.ndarray]:
    """For each part, for each of its windows: the smallest id of the parts that hold an equal window."""
    sizes = np.array([len(p) for p in parts], np.int64)
    if not len(sizes):
        return []
    raw = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    s = np.empty(len(raw) + 1, np.uint16)
    s[:-1] = raw
    s[:-1] += 2
    s[begin + sizes] = 1
    s[-1] = 0
    windows = sizes - LENGTH + 1
    starts = np.repeat(begin - np.concatenate(([0], np.cumsum(windows)[:-1])), windows) + np.arange(windows.sum())
    number = np.full(len(s), -1, np.int64)
    number[starts] = np.arange(len(starts))
    sa = suffix_array(s, LENGTH)
    sa = sa[number[sa] >= 0]
    same = permuted_prefixes(raw, sa, LENGTH)
    first = np.flatnonzero(np.concatenate(([True], ~same)))
    owner = np.repeat(ids, windows)[number[sa]]
    least = np.empty(len(sa), np.int64)
    least[number[sa]] = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.concatenate((first, [len(sa)]))))
    return np.split(least, np.cumsum(windows)[:-1])


def _answers(key: tuple, group: pa.Table) -> pa.Table:
    """A shard's answers to each block: runs of windows of a piece, with the smallest id that has them."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    index: dict[int, int] = {}
    parts: list[bytes] = []
    ids: list[int] = []
    asked = []
    for block, p, z in zip(group.column("block").to_pylist(), group.column("pieces"), group.column("z"), strict=True):
        e, body, at = np.frombuffer(p.as_buffer(), PIECE), unpack(z.as_py()), 0
        asked.append((block, e))
        for h, n, i in zip(e["hash"].tolist(), e["size"].tolist(), e["id"].tolist(), strict=True):
            if h in index:
                k = index[h]
                if parts[k] != body[at : at + n]:
                    raise ValueError("different pieces share a hash")
                ids[k] = min(ids[k], i)
            else:
                index[h] = len(parts)
                parts.append(body[at : at + n])
                ids.append(i)
            at += n
    least = least_ids(parts, np.array(ids, np.int64))
    size = np.array([len(x) for x in least], np.int64)
    flat = np.concatenate(least) if least else np.empty(0, np.int64)
    part = np.repeat(np.arange(len(size)), size)
    # Runs of equal answers in a piece, and where each piece's begin.
    first = np.flatnonzero(np.concatenate(([True], (flat[1:] != flat[:-1]) | (part[1:] != part[:-1])))) if len(flat) else np.empty(0, np.int64)
    n = np.diff(np.concatenate((first, [len(flat)])))
    begin = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else np.empty(0, np.int64)
    of, answer = part[first], flat[first]
    offset = first - begin[of]
    lo = np.searchsorted(of, np.arange(len(size) + 1))
    rows = []
    for block, e in asked:
        k = np.array([index[h] for h in e["hash"].tolist()], np.int64)
        count = lo[k + 1] - lo[k]
        at = np.repeat(lo[k] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        who = np.repeat(np.arange(len(k)), count)
        useful = (answer[at] < e["id"][who]) | e["several"][who]
        at, who = at[useful], who[useful]
        if len(at):
            r = np.empty(len(at), RUN)
            r["hash"], r["first"], r["n"], r["id"] = e["hash"][who], offset[at], n[at], answer[at]
            rows.append((block, r.tobytes()))
    return pa.Table.from_batches([_rows(["block", "runs"], [pa.int32(), pa.binary()], rows)])


def _kept(keep_text: bool):
    """A block's documents without what the answers cover."""

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids, order_ids, texts = _documents(docs) if docs.num_rows else ([], np.empty(0, np.int64), [])
        raw, offs = laid_out(texts)
        cover = np.zeros(len(raw) + 1, np.int32)
        runs = np.concatenate([np.frombuffer(x.as_buffer(), RUN) for x in answers.column("runs")]) if answers.num_rows else np.empty(0, RUN)
        if len(runs):
            runs = runs[np.argsort(runs["hash"], kind="stable")]
            doc, start, _, _, value = every_piece(raw, offs)
            lo, hi = np.searchsorted(runs["hash"], value, "left"), np.searchsorted(runs["hash"], value, "right")
            n = hi - lo
            at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            r, base = runs[at], np.repeat(start, n)
            gone = r["id"] < np.repeat(order_ids[doc], n)
            r, base = r[gone], base[gone]
            np.add.at(cover, base + r["first"], 1)
            np.add.at(cover, base + r["first"] + r["n"] + LENGTH - 1, -1)
        removed = np.cumsum(cover[:-1]) > 0
        out = []
        for i, name in enumerate(ids):
            a, z = offs[i], offs[i + 1]
            m = removed[a:z]
            spans = int(np.count_nonzero(m[1:] & ~m[:-1]) + (len(m) > 0 and bool(m[0])))
            left = raw[a:z][~m].tobytes() if spans else texts[i]
            out.append((name, len(texts[i]), int(m.sum()), spans, hashlib.sha256(left).hexdigest(), *[left] * keep_text))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_text
        return pa.Table.from_batches([_rows(names, [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * keep_text, out)])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and, if asked for, the kept bytes) of each row."""
    spark = docs.sparkSession
    common.ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length("_text")), F.lit(blocks)).cast("int"))
    prints = rows.mapInArrow(_prints(blocks), "bucket int, blocks binary, e binary")
    shared, _ = common.saved(prints.groupBy("bucket").applyInArrow(_shared, "block int, prints binary"), "shared")
    packed = rows.mapInArrow(_packed, "block int, ids array<long>, sizes array<long>, z binary")
    found = packed.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_candidates(blocks), "shard int, block int, pieces binary, z binary")
    answers, _ = common.saved(found.groupBy("shard").applyInArrow(_answers, "block int, runs binary"), "answers")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_kept(keep_bytes), schema)
