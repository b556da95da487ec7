"""WARC archives with a merged capture index.

Writing: a run is the list of records of one output file. Of records with equal payloads (by SHA-1, of at least
``revisit_from`` bytes) the one with the smallest page_id is a response, the others are revisit records that name its record
id. Spark's text writer writes the archives: each row is a record up to its last line feed, which is the row separator, so a
file's bytes are exactly its records, one after the other, in gzip. Pages are written by classes of size (a folder each), so
that every archive's bytes are bounded while long pages don't make the archives of the others small.

Reading: every archive is parsed by Content-Length as a stream, which gives a *capture run* of each archive, locally
sorted by (URL key, timestamp, page_id), and packed into blocks by range of the URL key. The external index merge takes,
for each range, the runs' sorted blocks, as they are and each read as it is needed, through a k-way loser tree: the ranges
in order are one global capture history. The ranges come from a sample of keys that grows with the number of captures; every
record is indexed. A task of the merge holds a range, some ROWS_PER_PART captures without their payloads.

Edge cases: a null page is an empty payload; a null url has the empty key; repeated rows with one page_id and payload are
all responses, or all revisits of the same response; rows without a page_id are responses (no id can name them); an empty
table gives no archive and no rows; very long pages are archives by themselves; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm import common

#: Pages and payload bytes of an archive at most (a longer page is an archive by itself), and the sizes that part classes.
RECORDS, ARCHIVE_BYTES = 1000, 1 << 29
CLASSES = (1 << 19, 1 << 22, 1 << 25)
#: Keys that are looked at for the ranges of the merge: so many at least, and so many for each range.
KEY_SAMPLE, KEYS_PER_PART = 20_000, 8
#: Captures that a task of the merge holds, on average.
ROWS_PER_PART = 20_000
#: Captures have no time of their own in the table; page_id seconds after this stand for it (fixed value).
EPOCH = 1_577_836_800
_URI = "urn:page:"


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the top down, then path and query, without scheme, www and fragment."""
    u = (url or "").strip().lower().partition("#")[0]
    host, slash, path = re.sub(r"^[a-z][a-z0-9+.-]*://", "", u).partition("/")
    name, _, port = host.rpartition("@")[2].partition(":")
    labels = name.removeprefix("www.").split(".")
    return ",".join(reversed(labels)) + (f":{port}" if port not in ("", "80", "443") else "") + ")/" + path if u else ""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _stamp(seconds: int) -> str:
    import datetime

    return datetime.datetime.fromtimestamp(EPOCH + seconds % (1 << 31), datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record. A revisit has an empty block; its digest and length are those of the full payload."""
    revisit = refers_to is not None
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_URI}{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {re.sub(r'[\r\n]', ' ', url or '')}",
        f"WARC-Date: {_stamp(page_id or 0)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: <{_URI}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = b"" if revisit else payload
    return ("\r\n".join([*lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def records(data: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """Headers, block and offset of each record of an archive's (uncompressed) bytes, given in pieces."""
    buffer, offset = bytearray(), 0

    def need(n: int) -> bool:
        while len(buffer) < n:
            piece = next(data, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while need(1):
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not need(len(buffer) + 1):
                raise ValueError("a record's header doesn't end")
        first, *rest = bytes(buffer[:end]).decode().split("\r\n")
        if not first.startswith("WARC/1."):
            raise ValueError(f"no WARC record: {first[:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest)}
        size = int(headers["content-length"])
        if not need(end + 4 + size + 4):
            raise ValueError("a record is cut short")
        yield headers, bytes(buffer[end + 4 : end + 4 + size]), offset
        del buffer[: end + 8 + size]
        offset += end + 8 + size


def inflated(data: bytes, piece: int = 1 << 20) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, in pieces."""
    z, rest = zlib.decompressobj(31), data
    while rest:
        out = z.decompress(rest, piece)
        if out:
            yield out
        rest = z.unconsumed_tail
        if z.eof:
            rest, z = z.unused_data, zlib.decompressobj(31)


class LoserTree:
    """Merges k sorted iterators: each step replays one leaf's path of about log2(k) matches."""

    def __init__(self, runs: list[Iterator]):
        self.runs, self.k = runs, len(runs)
        self.head = [next(r, None) for r in runs]
        self.tree = [-1] * max(1, self.k)  # tree[0]: the winner, others: the losers of their match
        for leaf in range(self.k):
            self.replay(leaf, building=True)

    def beats(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def replay(self, leaf: int, building: bool = False) -> None:
        node, winner = (leaf + self.k) // 2, leaf
        while node > 0:
            other = self.tree[node]
            if other < 0:
                if building:
                    self.tree[node] = winner
                    return
            elif self.beats(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        while self.k:
            w = self.tree[0]
            if self.head[w] is None:
                return
            yield self.head[w]
            self.head[w] = next(self.runs[w], None)
            self.replay(w)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for i, u, h, d, r in zip(*(b.column(c) for c in ("page_id", "url", "html", "digest", "refers_to")), strict=True):
            digest = base64.b32encode(bytes.fromhex(d.as_py())).decode()
            out.append(record(i.as_py(), u.as_py(), (h.as_py() or "").encode(), digest, r.as_py())[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def write_archives(pages: DataFrame, path: str, revisit_from: int = 0) -> None:
    """Write page_id, url, html as archives below path (any file system that Spark writes to)."""
    spark = pages.sparkSession
    common.ship(spark)
    html = common.text_or_empty("html")
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(html).alias("digest"), F.octet_length(html).alias("size"))
    # Only digests that occur twice are looked up again; partial minima come before the shuffle, Spark splits hot digests.
    first = known.where(F.col("size") >= revisit_from).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = known.join(first, "digest", "left").withColumn("refers_to", F.when(F.col("page_id") != F.col("first_id"), F.col("first_id")))
    present = known.agg(*(F.count_if(_of_class(k)).alias(str(k)) for k in range(len(CLASSES) + 1))).first()
    for k, bound in enumerate([*CLASSES, ARCHIVE_BYTES]):
        if present[k] or (k == 0 and not any(present)):
            made = joined.where(_of_class(k)).mapInArrow(_records, "record binary").select(F.col("record").cast("string").alias("value"))
            made.write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", max(1, min(RECORDS, ARCHIVE_BYTES // bound))).text(f"{path}/class={k}")


def _of_class(k: int):
    """Whether a page's size is in a class: above all smaller bounds, up to its own (the last class has none)."""
    inside = F.col("size") > (CLASSES[k - 1] if k else -1)
    return inside & (F.col("size") <= CLASSES[k]) if k < len(CLASSES) else inside


# Columns of the capture index.
CAPTURE = pa.schema(
    [("url_key", pa.string()), ("timestamp", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    + [("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64())]
)
_COLUMNS = "url_key string, timestamp string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long"


def _order(x: tuple) -> tuple:
    """Sort key of a capture: URL key, time, id (null last), place."""
    return x[0], x[1], x[2] is None, x[2] or 0, x[7], x[8]


def _id(uri: str | None) -> int | None:
    return int(uri[len(_URI) + 1 : -1]) if uri and len(uri) > len(_URI) + 2 else None


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each archive's captures as a sorted run."""
    for b in batches:
        for name, content in zip(b.column("path"), b.column("content"), strict=True):
            run = []
            for h, block, offset in records(inflated(content.as_py())):
                digest, revisit = h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"] == "revisit"
                if not revisit and payload_digest(block) != digest:
                    raise ValueError("a payload differs from its digest")
                size = int(h["x-payload-length"]) if revisit else len(block)
                run.append((url_key(h.get("warc-target-uri")), h["warc-date"], _id(h["warc-record-id"]), size, digest, h["warc-type"], _id(h.get("warc-refers-to")), name.as_py(), offset))
            run.sort(key=_order)
            yield pa.RecordBatch.from_pylist([dict(zip(CAPTURE.names, x, strict=True)) for x in run], schema=CAPTURE)


_BLOCK = pa.schema([("part", pa.int32()), ("captures", pa.list_(pa.struct(CAPTURE)))])


def _parts(bounds: list[tuple]):
    """Cuts sorted runs into sorted blocks, one for each range they touch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = zip(*(b.column(c).to_pylist() for c in ("url_key", "timestamp", "page_id")), strict=True)
            # A row without an id comes after all ids of its key and time.
            of = list(zip((bisect_right(bounds, (u, t, i is None, i or 0)) for u, t, i in keys), b.column("archive").to_pylist(), strict=True))
            rows = pa.StructArray.from_arrays([b.column(c) for c in CAPTURE.names], fields=list(CAPTURE))
            cuts = [0, *(i for i in range(1, len(of)) if of[i] != of[i - 1]), len(of)]
            blocks = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rows)
            yield pa.RecordBatch.from_arrays([pa.array([of[i][0] for i in cuts[:-1]], pa.int32()), blocks], schema=_BLOCK)

    return run


def _block(captures: pa.ListScalar) -> Iterator[tuple]:
    """(sort key, capture) of a sorted block, some at a time."""
    rows = captures.values
    for at in range(0, len(rows), 256):
        for x in rows.slice(at, 256).to_pylist():
            row = tuple(x.values())
            yield _order(row), row


def _merge(key: tuple, group: pa.Table) -> pa.Table:
    merged = [x for _, x in LoserTree([_block(c) for c in group.column("captures")])]
    out = pa.Table.from_pylist([dict(zip(CAPTURE.names, x, strict=True)) for x in merged], schema=CAPTURE)
    return out.append_column("part", pa.array([key[0].as_py()] * len(merged), pa.int32())).append_column("rank", pa.array(range(len(merged)), pa.int64()))


def capture_index(spark: SparkSession, path: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """The captures of all archives below path, with part and rank: ordered by them, a global capture history."""
    common.ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    runs, _ = common.saved(files.mapInArrow(_captures, _COLUMNS), "captures")
    n = runs.count()
    # Bounds of the ranges, from a sample by hash; (key, time, id) splits one URL's long history too.
    parts = max(1, -(-n // rows_per_part))
    sampled = runs.where(F.pmod(F.xxhash64("page_id", "offset"), F.lit(max(1, n // max(KEY_SAMPLE, KEYS_PER_PART * parts)))) == 0)
    keys = sorted(map(tuple, sampled.select("url_key", "timestamp", F.col("page_id").isNull(), F.coalesce("page_id", F.lit(0))).collect())) if n > rows_per_part else []
    bounds = [keys[i * len(keys) // parts] for i in range(1, parts)] if keys else []
    blocks = runs.mapInArrow(_parts(bounds), f"part int, captures array<struct<{', '.join(c.replace(' ', ':') for c in _COLUMNS.split(', '))}>>")
    return blocks.groupBy("part").applyInArrow(_merge, _COLUMNS + ", part int, rank long")


def archived(pages: DataFrame, path: str, revisit_from: int = 0) -> DataFrame:
    """Write the pages to archives below path, read them back and return the merged capture index."""
    write_archives(pages, path, revisit_from)
    return capture_index(pages.sparkSession, path)
