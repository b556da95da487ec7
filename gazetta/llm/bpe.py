"""Byte-level BPE by backtracking over longest matches.

The bytes of a piece are read as Latin-1 characters, so that an Aho-Corasick automaton over the vocabulary reports all
tokens at all places of the piece. The encoder walks from the left, takes the longest token that is compatible with the
token before it, and backtracks where none is; a place that once led nowhere is never tried again, which keeps the walk
linear in the piece. Two tokens are compatible if merging their joined bytes by rank gives just these two; answers are
memoised. A sequence whose neighbours are all compatible is the one that the rank merges produce, so ids are exact.

Edge cases: a null or empty text has no tokens; very long pieces (runs of spaces or letters) take linear time; equal
rows are encoded alike; other columns are not looked at. Caches are bounded and start afresh when full and with each task.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm import common

#: Bounds of the memo tables of a worker: pieces, and pairs of tokens.
PIECES, PAIRS = 200_000, 300_000
#: Longer pieces aren't kept in the memo table.
PIECE_CHARS = 200


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from a file of lines: base64 of the token's bytes, a space, its rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


def merge_by_rank(ranks: dict[bytes, int], piece: bytes, stop: int = 1) -> list[bytes]:
    """The defining procedure: merge the adjacent pair of lowest rank, leftmost first, until none or `stop` parts are left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > stop:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Pieces(dict):
    """Piece of text -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        import ahocorasick

        self.ranks = ranks
        self.whole = {k: v.to_bytes(4, "little") for k, v in ranks.items()}
        top = max(ranks.values(), default=-1) + 1
        self.token, self.sizes, self.shorter = [b""] * top, [0] * top, [-1] * top
        self.pairs: dict[int, bool] = {}
        self.split: dict[int, tuple[int, int] | None] = {}
        self.automaton = ahocorasick.Automaton()
        for k, v in ranks.items():
            self.token[v], self.sizes[v] = k, len(k)
        # Tokens that the merges don't reach from their own bytes stand for a whole piece only, never inside one.
        inner = {k: v for k, v in ranks.items() if len(k) == 1 or self.parts(v) is not None}
        for k, v in inner.items():
            self.shorter[v] = next((inner[k[:i]] for i in range(len(k) - 1, 0, -1) if k[:i] in inner), -1)
            self.automaton.add_word(k.decode("latin-1"), v)
        self.automaton.make_automaton()

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "surrogatepass")
        out = self.whole.get(raw)
        if out is None:
            out = b"".join([i.to_bytes(4, "little") for i in self.encode(raw)])
        if len(piece) <= PIECE_CHARS:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = out
        return out

    def forget(self) -> None:
        """Empty the memo tables."""
        self.clear()
        self.pairs.clear()

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge joins into this one; None for a byte or if merges don't reach it."""
        if (known := self.split.get(token, self)) is self:
            raw = self.token[token]
            known = None
            if len(raw) > 1:
                pair = merge_by_rank(self.ranks, raw, stop=2)
                if len(pair) == 2 and (r := self.ranks[pair[0]]) < token and (s := self.ranks[pair[1]]) < token:
                    known = (r, s)
            self.split[token] = known
        return known

    def compatible(self, a: int, b: int) -> bool:
        if (known := self.pairs.get(a << 32 | b)) is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[a << 32 | b] = self.stays_apart(a, b)
        return known

    def stays_apart(self, a: int, b: int) -> bool:
        """Undo merges beside the border, latest first; whether none across it would have come earlier.

        A merge has a higher rank than the merges it builds on, so merges happen in order of rank, and from left to
        right among equals: the left side's goes before one across the border of the same rank, the right side's after.
        """
        token, ranks, before = self.token, self.ranks, 1 << 62
        while True:
            across = ranks.get(token[a] + token[b])
            if across is not None and across < before:
                return False
            left, right = self.parts(a), self.parts(b)
            if left is not None and (right is None or a > b):
                before, a = a, left[1]
            elif right is not None:
                before, b = b + 1, right[0]
            else:
                return True

    def encode(self, raw: bytes) -> list[int]:
        text, n, sizes, shorter, pairs = raw.decode("latin-1"), len(raw), self.sizes, self.shorter, self.pairs
        longest = self.automaton.iter_long
        path = [t for _, t in longest(text)]
        # Mostly each longest match agrees with the one before it; so many of them stay.
        good, last = 0, -1
        for t in path:
            if last >= 0:
                ok = pairs.get(last << 32 | t)
                if not (self.compatible(last, t) if ok is None else ok):
                    break
            last = t
            good += 1
        if good == len(path):
            return path
        t = path[good]
        del path[good:]
        at = sum([sizes[x] for x in path])
        dead = bytearray(n + 1)
        while True:
            last = path[-1] if path else -1
            while t >= 0:
                if not dead[at + sizes[t]]:
                    ok = True if last < 0 else pairs.get(last << 32 | t)
                    if self.compatible(last, t) if ok is None else ok:
                        break
                t = shorter[t]
            if t >= 0:
                path.append(t)
                at += sizes[t]
                if at == n:
                    return path
                t = next(longest(text, at))[1]
            else:
                if not path:
                    raise ValueError("the vocabulary can't spell this piece")
                dead[at] = 1
                t = path.pop()
                at -= sizes[t]
                t = shorter[t]

    def decode(self, ids: memoryview | list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_coders: dict[bytes, Pieces] = {}


def coder(data: bytes) -> Pieces:
    """The coder of a rank file, one for each worker process."""
    key = hashlib.sha256(data).digest()
    if key not in _coders:
        _coders.clear()
        _coders[key] = Pieces(parse_ranks(data))
    return _coders[key]


#: The split pattern that quick_split() stands for, as published with the vocabulary (fixed value).
GPT2_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def quick_split() -> Callable[[str], list[str]]:
    """findall of GPT2_PATTERN for texts without characters beyond U+FFFF, by the far faster standard module.

    The standard module has no Unicode properties, so the classes are spelled out as ranges (it looks them up in a
    bitmap up to U+FFFF).
    """
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))

    def ranges(prop: str) -> str:
        codes, out, i = [ord(c) for c in regex.findall(prop, every)], [], 0
        while i < len(codes):
            j = i
            while j + 1 < len(codes) and codes[j + 1] == codes[j] + 1:
                j += 1
            out.append(f"\\u{codes[i]:04x}-\\u{codes[j]:04x}")
            i = j + 1
        return "".join(out)

    space, letter, number = (ranges(p) for p in (r"\s", r"\p{L}", r"\p{N}"))
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+").findall


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of the pattern in a text, from left to right."""
    import regex

    split = regex.compile(pattern).findall
    if pattern != GPT2_PATTERN:
        return split
    quick = quick_split()
    return lambda text: quick(text) if text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else split(text)


def text_encoder(data: bytes, pattern: str) -> tuple[Callable[[str], bytes], Pieces]:
    """A function from a text to its ids (little-endian, 4 bytes each), and the coder behind it."""
    pieces, split = coder(data), splitter(pattern)
    get = pieces.__getitem__
    return lambda text: b"".join(map(get, split(text))), pieces


def _columns(source, pattern: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pieces = text_encoder(source.value, pattern)
        for b in batches:
            n, sha, back, ids = [], [], [], []
            for x in b.column("_text"):
                e = encode(x.as_py() or "")
                n.append(len(e) // 4)
                sha.append(hashlib.sha256(e).hexdigest())
                back.append(hashlib.sha256(pieces.decode(memoryview(e).cast("I"))).hexdigest())
                if keep_ids:
                    ids.append(memoryview(e).cast("I").tolist())
            added = [pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())] + ([pa.array(ids, pa.list_(pa.int64()))] if keep_ids else [])
            kept = [i for i, name in enumerate(b.schema.names) if name != "_text"]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in kept] + added, [b.schema.names[i] for i in kept] + ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids)
        pieces.forget()

    return run


def encode_texts(docs: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in keep, n_tokens, ids_sha256, decoded_sha256 (and ids) for each row. The rank file (about 1 MB) is broadcast.

    The Latin-1 view needs each single byte in the vocabulary; a file without one of them is refused here.
    """
    spark = docs.sparkSession
    common.ship(spark)
    ranks = parse_ranks(rank_file)
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"no token for the bytes {missing[:5]}")
    source = spark.sparkContext.broadcast(rank_file)
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_text")
    schema = f"{kinds}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * keep_ids
    return rows.mapInArrow(common.tidy(_columns(source, pattern, keep_ids)), schema)
