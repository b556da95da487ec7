"""Near-duplicate detection: universal hash minima, banding, verification on full sets, connected components.

1. Each document's set of word shingles gives HASHES minima under universal hash functions (a*h + b mod 2**32), BANDS
   band keys of them, and an *odd sketch*: bit i is the parity of the set's members that fall on i. Equal sets are one
   *class*, told by a 128-bit digest of the set; from here on only classes count, so exact copies meet nowhere. A bucket
   is the classes that share a band key; of buckets with the same members one stays.
2. Each bucket is dealt in blocks of about BLOCK members; all blocks of a bucket also hold its HEADS most popular members
   (those that share buckets with most others, that is the middle of a group of copies). Within a block all pairs are
   looked at, but only a forest of likely links leaves it, nearest pairs first: fewer rows than members. The bits in which
   two odd sketches differ are never more than the members in which the sets differ, so this signature verification
   rules out nothing that is similar.
3. The pairs of the forests are verified on the full sets, read again from the texts; links give components, by
   alternating large-star and small-star.
4. What a forest left out matters only where one of its own pairs was refused, and blocks saw only their own members and
   the heads. So in buckets of several blocks, or that told a refused pair, and that still hold several components, the
   members outside the largest one meet all members, in pairs of blocks, refused pairs aside. As long as these outsiders are OUTSIDE blocks at
   most, a member has 2 * OUTSIDE rows at most. Where they are more (texts of one template that are just not similar, say), members
   are compared by their full sets instead: ordered rare members first (by SLOTS counters), similar sets share one of their
   first members, of which the smaller set needs (1 - t) / (1 + t) of its size, less than what tells it from any set that
   isn't similar. Classes that meet in such a member, the smaller one's share asking, form groups as buckets do. This is
   exact, and rows follow the sets' sizes. Again only forests leave a task, and the step repeats in the groups that told a
   refused pair (with more forests each time, less than half a block has members) until there are none. Nothing is capped.
5. Membership of classes and documents is joined back.

With similarity 0.8, 240 minima in 40 bands of 6 miss a pair of exactly that similarity with probability 5e-6.

Edge cases: documents without words or text have an empty set and are alone; fewer words than a shingle count as one
shingle; equal rows are linked; rows of one doc_id are told apart by their sets; a null doc_id counts as larger than
all others, so its component is null only where all ids in it are; an empty table gives no rows; other columns are not
looked at. drop_near_duplicates keeps one row of each component, the one of the smallest doc_id (and of repeated rows
one), and all documents without words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm import common
from gazetta.llm.components import components
from gazetta.llm.textkernel import mix, shingle_hashes, slices, word_hashes, words

BANDS, ROWS = 40, 6
HASHES = BANDS * ROWS
#: Members of a block, on average, and members that all blocks of a bucket hold.
BLOCK, HEADS = 512, 4
#: Blocks of members outside a bucket's largest component up to which they meet all its members in pairs of blocks: 16 rows a
#: member at most.
OUTSIDE = 8
#: Forests that a block tells of when it is looked at again, and by how many times more each time after.
TRIES = 16
#: Counters by which members of sets are told to be rare or common where full sets are compared by their rarest members.
SLOTS = 1 << 16
#: Bits of an odd sketch: a power of two, at least so many for each member of the set and at least so many in all.
BITS, LEAST_BITS = 8, 512
_rng = np.random.default_rng(8)
_A = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]
_BAND = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text of a column its sorted distinct shingle hashes."""
    for _, raw, offs in slices(column):
        starts, ends, text = words(raw, offs)
        w = word_hashes(raw, starts, ends)
        cuts = np.searchsorted(text, np.arange(len(offs)))
        for i in range(len(offs) - 1):
            yield np.unique(shingle_hashes(w[cuts[i] : cuts[i + 1]], k))


def signature(s: np.ndarray) -> np.ndarray:
    """HASHES minima of a set of 64-bit hashes."""
    h = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), 2048):
        x = _A * h[None, i : i + 2048]
        x += _B
        np.minimum(out, x.min(axis=1), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    return mix((sig.reshape(BANDS, ROWS).astype(np.uint64) * _BAND).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def set_key(s: bytes) -> bytes:
    return hashlib.blake2b(s, digest_size=16).digest()


def odd_sketch(s: np.ndarray) -> bytes:
    """The parities of a set's members by their low bits."""
    bits = LEAST_BITS
    while bits < BITS * len(s):
        bits *= 2
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(bool), bitorder="little").tobytes()


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, key, bands, sketches = [], [], [], []
            for s in shingle_sets(b.column("_text"), k):
                n.append(len(s))
                key.append(set_key(s.tobytes()) if len(s) else None)
                bands.append(band_keys(signature(s)) if len(s) else None)
                sketches.append(odd_sketch(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["doc_id", "text_key", "n_shingles", "set_key", "bands", "sketch"],
            )

    return run


def _sets(k: int):
    """The sets of the texts of wanted classes (rows may share a key and differ)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s.tobytes() for s in shingle_sets(b.column("_text"), k)]
            out = pa.RecordBatch.from_arrays([b.column("id"), pa.array(sets, pa.binary())], ["id", "s"])
            yield out.filter(pa.array([set_key(s) == x.as_py() for s, x in zip(sets, b.column("id"), strict=True)], pa.bool_()))

    return run


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many members of sets fall on each counter."""
    counts = np.zeros(SLOTS, np.int64)
    for b in batches:
        for s in b.column("s"):
            counts += np.bincount((np.frombuffer(s.as_buffer(), np.uint64) % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], ["slot", "n"])


def rarest(s: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The members of a set by which any similar set meets it, and how many of them suffice towards larger sets.

    All sets are put into one order, rare members first. Of two similar sets the first common member stands among the
    first n - ceil(t n) + 1 of either, and of the smaller one among the first n - ceil(2 t n / (1 + t)) + 1.
    """
    n = len(s)
    ordered = s[np.lexsort((s, counts[(s % np.uint64(SLOTS)).astype(np.int64)]))]
    return ordered[: n + (-percent * n) // 100 + 1], n + (-2 * percent * n) // (100 + percent) + 1


def _rarest(counts, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, s in zip(b.column("id"), b.column("s"), strict=True):
                first, few = rarest(np.frombuffer(s.as_buffer(), np.uint64), counts.value, percent)
                yield pa.RecordBatch.from_arrays([pa.array([i.as_py()] * len(first), pa.binary()), pa.array(first.view(np.int64)), pa.array(np.arange(len(first)) < few)], ["id", "key", "asks"])

    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column("sa"), b.column("sb"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            yield b.select(["a", "b"]).append_column("ok", pa.array(ok, pa.bool_()))

    return run


def likely_pairs(sketches: list[bytes], size: np.ndarray, asks: np.ndarray, comp: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (x, y) of different components, x asking, that sizes and odd sketches allow to be similar; and their distance."""
    length = np.array([len(s) for s in sketches])
    bits = {n: np.frombuffer(b"".join(sketches[i] for i in np.flatnonzero(length == n)), np.uint64).reshape(-1, n // 8) for n in np.unique(length).tolist()}
    out = [(np.empty(0, np.int64),) * 2 + (np.empty(0),)]
    for n, mine in bits.items():
        # Sizes of similar sets are in one power of two or in the next; a longer sketch folds to the shorter one.
        others = [(n, mine)]
        if 2 * n in bits:
            w = bits[2 * n].shape[1] // 2
            others.append((2 * n, bits[2 * n][:, :w] ^ bits[2 * n][:, w:]))
        at = np.flatnonzero(length == n)
        for m, theirs in others:
            there = np.flatnonzero(length == m)
            for row, x in enumerate(at):
                if m == n and not asks[x]:
                    continue
                good = (comp[there] != comp[x]) & (100 * np.minimum(size[there], size[x]) >= percent * np.maximum(size[there], size[x]))
                if m == n:
                    good &= ~asks[there] | (there > x)
                else:
                    good &= asks[there] | asks[x]
                if good.any():
                    y = np.flatnonzero(good)
                    both = (size[there[y]] + size[x]).astype(np.int64)
                    differ = np.bitwise_count(theirs[y] ^ mine[row]).sum(axis=1, dtype=np.int64)
                    near = (100 + percent) * differ <= (100 - percent) * both
                    y, differ, both = there[y[near]], differ[near], both[near]
                    out.append((np.full(len(y), x), y, differ / both))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def forests(x: np.ndarray, y: np.ndarray, distance: np.ndarray, comp: np.ndarray, tries: int) -> np.ndarray:
    """Numbers of the edges (x, y) of `tries` forests over components, nearest first, no edge in two of them."""
    order = np.argsort(distance, kind="stable")
    taken: list[int] = []
    for _ in range(tries):
        if not len(order):
            break
        root = np.arange(comp.max() + 1)

        def find(c: int, root: np.ndarray = root) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        left, more = order, []
        while len(left):
            for e in left[:1024]:
                a, b = find(comp[x[e]]), find(comp[y[e]])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    more.append(int(e))
            left = left[1024:]
            while (root != root[root]).any():
                root[:] = root[root]
            left = left[root[comp[x[left]]] != root[comp[y[left]]]]
        taken += more
        order = order[~np.isin(order, more)]
    return np.array(taken, np.int64)


def _links(percent: int, tries: int):
    """The likely links of a block (or of a pair of blocks) that could join components, as forests."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        ids = group.column("id").to_pylist()
        # A head may also be a member of the block, and one that asks also be asked.
        first = {(i, ask): at for at, (i, ask) in reversed(list(enumerate(zip(ids, group.column("asks").to_pylist(), strict=True))))}
        at = np.array(sorted(first.values()), np.int64)
        group, ids = group.take(pa.array(at)), [ids[i] for i in at]
        _, comp = np.unique(np.array([(c or i).hex() for c, i in zip(group.column("comp").to_pylist(), ids, strict=True)]), return_inverse=True)
        size, asks = group.column("n").to_numpy(), group.column("asks").to_numpy(zero_copy_only=False)
        x, y, distance = likely_pairs(group.column("sketch").to_pylist(), size, asks, comp, percent)
        refused = [frozenset(r or ()) for r in group.column("refused").to_pylist()]
        if any(refused):
            good = np.array([ids[j] not in refused[i] for i, j in zip(x.tolist(), y.tolist(), strict=True)], bool)
            x, y, distance = x[good], y[good], distance[good]
        edges = forests(x, y, distance, comp, tries)
        pairs = [(max(ids[i], ids[j]), min(ids[i], ids[j])) for i, j in zip(x[edges].tolist(), y[edges].tolist(), strict=True)]
        return pa.table({"key": pa.array([key[0].as_py()] * len(pairs), pa.int64()), "a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())})

    return run


LINKS = "key long, a binary, b binary"


class Finder:
    """The steps over one table of documents. Joins of tables that grow with it are merge joins at every size: one plan, that
    small tables show as it is on large ones. Only what fetches the texts of wanted classes is broadcast if it is counted to
    be small (common.sized), so that the texts stay where they are; else they are shuffled once."""

    def __init__(self, docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str):
        self.spark, self.k, self.percent, self.saved_paths = docs.sparkSession, shingle, percent, []
        common.ship(self.spark)
        self.rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("_text"))
        self.signed = self.save(self.rows.mapInArrow(common.tidy(_sign(shingle)), "doc_id long, text_key long, n_shingles long, set_key binary, bands array<long>, sketch binary"), "signed")
        self.sets: list[DataFrame] = []

    def save(self, df: DataFrame, label: str) -> DataFrame:
        out, path = common.saved(df, label)
        self.saved_paths.append(path)
        return out

    def done(self) -> None:
        common.remove(self.spark, *self.saved_paths)

    def buckets(self) -> DataFrame:
        """id, n, sketch, at (band and size of each of its buckets), popularity of the classes that share a bucket."""
        banded = self.signed.where("set_key IS NOT NULL").select(F.col("set_key").alias("id"), F.col("n_shingles").cast("int").alias("n"), F.explode("bands").alias("band"))
        hashed = F.xxhash64("id")
        shared = self.save(banded.groupBy("band").agg(F.min(hashed).alias("lo"), F.max(hashed).alias("hi")).where("lo != hi").select("band"), "shared")
        members = self.save(banded.join(shared.hint("merge"), "band").distinct(), "members")
        sizes = members.groupBy("band").agg(F.count(F.lit(1)).cast("int").alias("m"), F.min("id").alias("lo"), F.max("id").alias("hi"), F.sum(hashed % (1 << 40)).alias("s"))
        sizes = self.save(sizes.groupBy("m", "lo", "hi", "s").agg(F.min("band").alias("band")).select("band", "m"), "sizes")
        by_class = members.join(sizes.hint("merge"), "band").groupBy("id", "n").agg(F.collect_list(F.struct("band", "m")).alias("at"), F.sum("m").alias("popularity"))
        wanted = self.save(by_class, "wanted")
        sketches = self.signed.select(F.col("set_key").alias("id"), "sketch").join(wanted.select("id").hint("merge"), "id", "left_semi").groupBy("id").agg(F.max("sketch").alias("sketch"))
        return self.save(wanted.join(sketches.hint("merge"), "id"), "classes")

    def within(self, classes: DataFrame) -> DataFrame:
        """Likely links within blocks, and with the heads of their buckets."""
        each = classes.select("id", "n", "popularity", F.inline("at"))
        large = each.where(F.col("m") > BLOCK).withColumn("k", F.row_number().over(Window.partitionBy("band").orderBy(F.col("popularity").desc(), "id")))
        heads = large.where(F.col("k") <= HEADS).select("id", "band", F.explode(F.sequence(F.lit(0), F.ceil(F.col("m") / BLOCK).cast("int") - 1)).alias("block"))
        block = F.pmod(F.xxhash64("id", "band"), F.ceil(F.col("m") / BLOCK)).cast("int").alias("block")
        rows = classes.select("id", "n", "sketch", F.inline("at")).select("id", "n", "sketch", "band", block)
        rows = rows.unionByName(classes.select("id", "n", "sketch").join(heads, "id"))
        rows = rows.withColumns({"asks": F.lit(True), "comp": F.lit(None).cast("binary"), "refused": F.array().cast("array<binary>")})
        return rows.groupBy("band", "block").applyInArrow(_links(self.percent, 1), LINKS)

    def slots(self, classes: DataFrame, linked: DataFrame, missed: DataFrame) -> list[DataFrame]:
        """Members (key, id, asks) of the groups in which links may have been missed between components: buckets of several
        blocks, or of a refused pair (missed: their keys); and what members of buckets with many outsiders meet by."""
        each = classes.select("id", F.inline("at")).join(linked.withColumnsRenamed({"node": "id", "component": "comp"}).hint("merge"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        inside = each.groupBy("band", "m", "comp").agg(F.count(F.lit(1)).alias("c"))
        mixed = inside.groupBy("band", "m").agg(F.max("c").alias("c"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
        mixed = mixed.join(missed.select(F.col("key").alias("band"), F.lit(True).alias("missed")).hint("merge"), "band", "left").where((F.col("m") > BLOCK) | F.col("missed"))
        mixed = self.save(mixed.select("band", (F.col("m") - F.col("c") > OUTSIDE * BLOCK).alias("many")), "mixed")
        held = self.save(each.select("band", "id").join(mixed.hint("merge"), "band"), "held")
        out = [self.save(held.where("NOT many").select(F.col("band").alias("key"), "id", F.lit(None).cast("boolean").alias("asks")), "slots")]
        if not mixed.where("many").isEmpty():
            out.append(self.save(self.rarest_members(self.save(held.where("many").select("id").distinct(), "hot")), "rarest"))
        return out

    def across(self, classes: DataFrame, slots: list[DataFrame], linked: DataFrame, refused: DataFrame, tries: int) -> DataFrame | None:
        """Likely links (with the key of their group) between components of each group."""
        found, blocks = [], lambda n: F.ceil(n / BLOCK).cast("int")
        for rows in slots:
            if rows.isEmpty():
                continue
            ids = rows.select("id").distinct()
            both = refused.select(F.col("a").alias("id"), F.col("b").alias("of")).unionByName(refused.select(F.col("b").alias("id"), F.col("a").alias("of")))
            partners = both.join(ids.hint("merge"), "id", "left_semi").groupBy("id").agg(F.collect_set("of").alias("refused"))
            placed = classes.select("id", "n", "sketch").join(ids.hint("merge"), "id", "left_semi").join(linked.withColumnsRenamed({"node": "id", "component": "comp"}).hint("merge"), "id", "left")
            placed = self.save(placed.withColumn("comp", F.coalesce("comp", "id")).join(partners.hint("merge"), "id", "left"), "placed")
            # Classes are joined as one row each, with what they meet by as an array: no join's rows follow the sets' sizes.
            each = rows.groupBy("id").agg(F.collect_list(F.struct("key", "asks")).alias("by"))
            told = self.save(each.join(placed.select("id", "comp").hint("merge"), "id").select("id", "comp", F.inline("by")), "told")
            inside = told.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.count_if("asks").alias("ask"), F.max(F.col("asks").isNull()).alias("bucket"))
            groups = inside.groupBy("key").agg(F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("top"), F.sum("ask").alias("ask"), F.max("bucket").alias("bucket"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
            # In a bucket those outside its largest component ask, in other groups those whose share says so.
            asking = F.when(F.col("bucket"), F.col("m") - F.col("top.c")).otherwise(F.col("ask"))
            groups = self.save(groups.select("key", F.col("top.comp").alias("top"), blocks(F.col("m")).alias("js"), blocks(asking).alias("is")).where(F.col("is") > 0), "groups")
            met = told.join(groups.hint("merge"), "key").select("id", F.struct("key", "js", "is", F.coalesce("asks", F.col("comp") != F.col("top")).alias("asks")).alias("by"))
            met = met.groupBy("id").agg(F.collect_list("by").alias("by")).join(placed.hint("merge"), "id").select("id", "n", "sketch", "comp", "refused", F.inline("by"))
            found.append(self.pairs_of_blocks(met).groupBy("key", "i", "j").applyInArrow(_links(self.percent, tries), LINKS))
        return reduce(DataFrame.unionByName, found) if found else None

    def looked_at(self, links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """What verified() tells of links, and the keys of the groups of refused ones: only there may others be missed."""
        links = self.save(links, "links")
        told = self.verified(links.select("a", "b").distinct())
        return told, self.save(links.join(told.where("NOT ok").select("a", "b").hint("merge"), ["a", "b"], "left_semi").select("key").distinct(), "missed")

    @staticmethod
    def pairs_of_blocks(rows: DataFrame) -> DataFrame:
        """Members of groups (key) that ask, a block of them for each block of all members; js, is: how many blocks."""
        part = lambda n: F.pmod(F.xxhash64("id", "key"), F.col(n)).cast("int")
        every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
        at = lambda i, j, asks: F.struct(i.alias("i"), j.alias("j"), F.lit(asks).alias("asks"))
        none = F.array().cast("array<struct<i:int,j:int,asks:boolean>>")
        asking = F.when(F.col("asks"), F.transform(every("js"), lambda j: at(part("is"), j, True))).otherwise(none)
        asked = F.transform(every("is"), lambda i: at(i, part("js"), False))
        return rows.select("key", "id", "n", "sketch", "comp", "refused", F.inline(F.concat(asking, asked)))

    def rarest_members(self, wanted: DataFrame) -> DataFrame:
        """id, key (a member of the set), asks: the members by which similar sets of wanted classes (id) must meet."""
        sets = self.sets_of(wanted).join(wanted.hint("merge"), "id", "left_semi")
        counts = np.zeros(SLOTS, np.int64)
        for r in sets.mapInArrow(common.tidy(_slots), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow().to_batches():
            counts[r.column("slot").to_numpy()] = r.column("n").to_numpy()
        return sets.mapInArrow(common.tidy(_rarest(self.spark.sparkContext.broadcast(counts), self.percent)), "id binary, key long, asks boolean")

    def sets_of(self, wanted: DataFrame) -> DataFrame:
        """id, s (full set) of the wanted classes, and of all others that are known; texts are read for new ones only."""
        for known in self.sets:
            wanted = wanted.join(known.select("id"), "id", "left_anti")
        # One document of each wanted class; null ids count as well.
        source = self.signed.select(F.col("set_key").alias("id"), "doc_id", "text_key").join(wanted.hint("merge"), "id", "left_semi")
        source = self.save(source.groupBy("id").agg(F.min(F.struct("doc_id", "text_key")).alias("of")).select("id", "of.*"), "sources")
        texts = self.rows.alias("t").join(common.sized(source.alias("s")), (F.col("t.text_key") == F.col("s.text_key")) & F.col("t.doc_id").eqNullSafe(F.col("s.doc_id"))).select("id", "_text")
        if not self.sets or not source.isEmpty():
            self.sets.append(self.save(texts.mapInArrow(common.tidy(_sets(self.k)), "id binary, s binary").groupBy("id").agg(F.first("s").alias("s")), "sets"))
        return reduce(DataFrame.unionByName, self.sets)

    def verified(self, close: DataFrame) -> DataFrame:
        """Pairs (a, b) of classes, with ok: whether they are similar by their full sets."""
        close = self.save(close, "pairs")
        every = self.sets_of(close.select(F.col("a").alias("id")).union(close.select("b")).distinct())
        pairs = close
        for side in ("a", "b"):
            pairs = pairs.join(every.select(F.col("id").alias(side), F.col("s").alias(f"s{side}")).hint("merge"), side, "left")
        lost = F.when(F.col("sa").isNull() | F.col("sb").isNull(), F.raise_error(F.lit("a class has no set"))).otherwise(F.col("sa"))
        return self.save(pairs.select("a", "b", lost.alias("sa"), "sb").mapInArrow(common.tidy(_similar(self.percent)), "a binary, b binary, ok boolean"), "verified")

    def joined(self, linked: DataFrame, more: DataFrame) -> DataFrame:
        """Components of the links so far and of more links between their members."""
        for side in ("a", "b"):
            more = more.join(linked.select(F.col("node").alias(side), "component"), side, "left").withColumn(side, F.coalesce("component", side)).drop("component")
        return components(linked.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more.select("a", "b")))

    def run(self) -> DataFrame:
        """doc_id, text_key, n_shingles, root for each row: the rows of a component share their root, which is null without words."""
        classes = self.buckets()
        told, missed = self.looked_at(self.within(classes))
        refused, linked, tries = told.where("NOT ok"), components(told.where("ok")), TRIES
        slots = self.slots(classes, linked, missed)
        while (links := self.across(classes, slots, linked, refused, tries)) is not None:
            told, missed = self.looked_at(links)
            if told.isEmpty():
                break
            refused, linked, tries = refused.unionByName(told.where("NOT ok")), self.joined(linked, told.where("ok")), TRIES * tries
            slots = [self.save(rows.join(missed.hint("merge"), "key", "left_semi"), "slots") for rows in slots]
        thin = self.signed.select("doc_id", "text_key", "n_shingles", "set_key")
        roots = thin.join(linked.withColumnRenamed("node", "set_key").hint("merge"), "set_key", "left").select("doc_id", "text_key", "n_shingles", F.coalesce("component", "set_key").alias("root"))
        roots, _ = common.saved(roots, "roots")
        self.done()
        return roots


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row: components of 100 * intersection >= percent * union."""
    roots = Finder(docs, shingle, percent, id_col, text_col).run()
    first = roots.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    out = roots.join(first, "root", "left").select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component; all columns stay."""
    roots = Finder(docs, shingle, percent, id_col, text_col).run()
    return common.one_of_each(docs, id_col, text_col, roots.select("doc_id", "text_key", F.col("root").alias("group")))
