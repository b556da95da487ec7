"""Array code over the bytes of Arrow string columns: words and their hashes, without a Python object for each word."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: A slice of a column that is worked on at once has so many bytes, or one text.
SLICE_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: White space and all other ASCII characters that are neither letters nor digits.
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i up to n."""
    if len(_powers.get("up", ())) <= n:
        for k, x in (("up", _BASE), ("down", _INVERSE)):
            a = np.full(max(n + 1, SLICE_BYTES + 1), x, np.uint64)
            a[0] = 1
            _powers[k] = np.multiply.accumulate(a)
    return _powers["up"][: n + 1], _powers["down"][: n + 1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each text's offset (one more than texts); null is empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and offs[-1] > offs[0] else np.empty(0, np.uint8)
    return raw, offs - offs[0]


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a column: index of the first text, bytes, offsets. A part has about `size` bytes, or one longer text."""
    raw, offs = flat(column)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        yield i, raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def words(raw: np.ndarray, offs: np.ndarray, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word: maximal runs without separators, inside one text."""
    if not len(raw):
        return (np.empty(0, np.int64),) * 3
    space = separators[raw]
    opens = np.concatenate(([True], space[:-1]))
    closes = np.concatenate((space[1:], [True]))
    full = offs[1:] > offs[:-1]
    opens[offs[:-1][full]] = True
    closes[offs[1:][full] - 1] = True
    starts, ends = np.flatnonzero(~space & opens), np.flatnonzero(~space & closes) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


#: Words of more bytes than this are told by blake2b, the others by mixing in eight bytes after eight.
LONG_WORD = 64
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_NEXT = np.uint64(0x9FB21C651E98DF25)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, with A-Z lower-cased if asked for.

    Each eight bytes are mixed into all bits of the hash before the next ones come (a polynomial of the bytes modulo 2**64
    would give whole families of long words one hash).
    """
    size = (ends - starts).astype(np.int64)
    h = mix(size.astype(np.uint64) + _BASE)
    if not len(size):
        return h
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[:-8] = _LOWER[raw] if lower else raw
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    at, left, s = np.arange(len(size)), size, starts
    short = size <= LONG_WORD
    if not short.all():
        at, left, s = at[short], size[short], starts[short]
        for i in np.flatnonzero(~short).tolist():
            h[i] = int.from_bytes(hashlib.blake2b(padded[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    while len(at):
        h[at] = mix((h[at] ^ (eight[s] & _LOW_BYTES[np.minimum(left, 8)])) * _NEXT + _BASE)
        more = left > 8
        at, left, s = at[more], left[more] - 8, s[more] + 8
    return h


def shingle_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words; of fewer words, of the whole sequence; of none, empty."""
    if not len(w):
        return w
    k = min(k, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + w[i : len(w) - k + 1 + i])
    return h
