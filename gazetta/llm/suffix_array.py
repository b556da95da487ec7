"""Suffix arrays by induced sorting, in array operations, and permuted common prefixes.

The steps are those of SA-IS: suffixes are classified as smaller (S) or larger (L) than their successor; leftmost S
suffixes (LMS) are put into their buckets, L and S suffixes are induced from them, which sorts the LMS substrings; these
are named, the string of names is sorted, and its order is induced to all suffixes. An induction walks the buckets (the
256 bytes and a separator), a bucket at a time: what a bucket's suffixes induce is appended to the other buckets by one
stable counting sort, and what they induce into their own bucket is the next round of the same bucket.

Only the order of the first `depth` characters matters to the caller. The string of names is therefore not sorted by
another induction - its alphabet is as large as the string, a bucket each - but by rank doubling until `depth`
characters are covered; ties beyond that stay in text order.
"""

from __future__ import annotations

import numpy as np

from gazetta.llm.textkernel import mix, powers

_SYMBOL = np.random.default_rng(11).integers(0, 1 << 63, 258, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def s_types(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last is (the string ends with the only 0)."""
    n = len(s)
    up = np.empty(n, bool)
    rising, falling = s[:-1] < s[1:], s[:-1] > s[1:]
    at = np.where(rising | falling, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    up[:-1] = np.where(following == n, True, rising[np.minimum(following, n - 2)])
    up[-1] = True
    return up


class Inducer:
    def __init__(self, s: np.ndarray, up: np.ndarray):
        self.s, self.up, self.n = s, up, len(s)
        self.counts = np.bincount(s, minlength=258)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        self.chars = np.flatnonzero(self.counts)

    def _append(self, sa: np.ndarray, at: np.ndarray, j: np.ndarray, step: int) -> None:
        """Put j, in order, at the free ends of their buckets; at moves by step for each."""
        c = self.s[j]
        order = np.argsort(c, kind="stable")
        j, c = j[order], c[order]
        n = np.bincount(c, minlength=258)
        rank = np.arange(len(c)) - np.repeat(np.cumsum(n) - n, n)
        sa[at[c] + step * rank] = j
        at += step * n

    def __call__(self, lms: np.ndarray) -> np.ndarray:
        """All suffixes in the order induced by that of the LMS suffixes."""
        s, up = self.s, self.up
        sa = np.full(self.n, -1, np.int64)
        tails = self.ends - 1
        self._append(sa, tails, lms[::-1], -1)
        heads = self.starts.copy()
        for c in self.chars:
            done = self.starts[c]
            while done < heads[c]:  # L suffixes of this bucket, those it induces into itself in further rounds
                q = sa[done : heads[c]]
                done = heads[c]
                j = q[q > 0] - 1
                self._append(sa, heads, j[~up[j]], 1)
            q = sa[tails[c] + 1 : self.ends[c]]
            j = q[q > 0] - 1
            self._append(sa, heads, j[~up[j]], 1)
        tails = self.ends - 1
        sa[0], tails[0] = self.n - 1, -1  # the end, which nothing induces
        for c in self.chars[::-1]:
            done = self.ends[c] - 1
            while done > tails[c]:
                q = sa[tails[c] + 1 : done + 1][::-1]
                done = tails[c]
                j = q[q > 0] - 1
                self._append(sa, tails, j[up[j]], -1)
            q = sa[self.starts[c] : heads[c]][::-1]
            j = q[q > 0] - 1
            self._append(sa, tails, j[up[j]], -1)
        return sa


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of s (values 0..257; 0 is the last one and only there) in the order of their first `depth` characters at least."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    up = s_types(s)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = up[1:] & ~up[:-1]
    is_lms[n - 1] = True
    lms = np.flatnonzero(is_lms)
    induce = Inducer(s, up)
    sa = induce(lms)
    found = sa[is_lms[sa]]
    # Names: equal LMS substrings (up to the next LMS suffix, its first character included) share one.
    up_to, down = powers(n)
    c = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_SYMBOL[s] * up_to[:-1], dtype=np.uint64)))
    ends = np.minimum(np.concatenate((lms[1:], [n - 1])) + 1, n)
    value = mix((c[ends] - c[lms]) * down[lms] + (ends - lms).astype(np.uint64))
    place = np.zeros(n, np.int64)
    place[lms] = np.arange(len(lms))
    in_order = place[found]
    name = np.concatenate(([0], np.cumsum(value[in_order][1:] != value[in_order][:-1])))
    rank = np.empty(len(lms), np.int64)
    rank[in_order] = name
    covered = 1
    while rank.max() + 1 < len(rank) and 2 * covered < depth + 2:
        following = np.full(len(rank), -1, np.int64)
        following[:-covered] = rank[covered:]
        _, rank = np.unique(rank * (len(rank) + 1) + following + 1, return_inverse=True)
        covered *= 2
    return induce(lms[np.argsort(rank, kind="stable")])


def permuted_prefixes(raw: np.ndarray, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """For each of the sorted suffixes but the first: whether it shares its first `depth` bytes with the one before.

    Pairs are compared in text order, eight bytes at a time, so reads run through the text beside one jump each.
    """
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    word = np.zeros(len(raw), np.uint64)
    for k in range(8):
        word |= padded[k : k + len(raw)].astype(np.uint64) << np.uint64(8 * k)
    a, b = suffixes[1:], suffixes[:-1]
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    same = np.ones(len(a), bool)
    for at in [*range(0, depth - 7, 8), depth - 8]:
        live = np.flatnonzero(same)
        same[live] = word[a[live] + at] == word[b[live] + at]
    out = np.empty(len(a), bool)
    out[order] = same
    return out
