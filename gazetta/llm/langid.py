"""Language identification by compression.

For each language a zstandard raw-content dictionary is cut from labelled rows. A text is reduced to lower-case letters
and single spaces and compressed block by block (so that a long text profits from the dictionaries all along) with each
dictionary; the language of the smallest total wins. The margin is (second - smallest) / second; texts below
``MARGIN`` are rejected.

The training rows: of each language, the ROWS rows of the smallest hash of (id, length), those above ROW_BYTES after all
others; whole texts are taken in this order until they come to DICT_BYTES. These three bounds of the labelled sample are
parameters; everything else covers all rows and whole texts, and texts of every length are treated alike. What is sent to
the driver is bounded by the number of language codes times ROWS texts, and to the workers times DICT_BYTES and a text.

Edge cases: null texts and texts without a letter are ``und`` with score 0 and rejected; rows without a language don't
teach; without any labelled row all texts are ``und``; ties go to the code that sorts first; with one language only the
score is 1; equal texts get equal answers, for only the text is looked at. identify()'s own columns replace columns of the
same name; keep_identified() gives the input's columns back whatever their names.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from gazetta.llm import common

ROWS, ROW_BYTES, DICT_BYTES = 200, 16 << 10, 96 << 10
#: Bytes of a block that is compressed by itself.
BLOCK = 4096
#: Smallest margin that is accepted.
MARGIN = 0.002
#: Compression level, the same for all texts.
LEVEL = 6
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def held_out(column: str = "doc_id"):
    """The rows that are never learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letters(text: str) -> str:
    """Lower-case letters in NFC, anything between them one space; empty if there is no letter."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    s = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return s if any(map(str.isalpha, s)) else ""


def train(docs: DataFrame, rows: int = ROWS, size: int = DICT_BYTES, row_bytes: int = ROW_BYTES) -> dict[str, bytes]:
    """Language -> dictionary. docs: doc_id, text, lang of the rows to learn from."""
    n = F.octet_length("text")
    known = docs.where(F.col("lang").isNotNull() & (n > 0)).select("lang", "doc_id", F.col("text").alias("t"), F.xxhash64("doc_id", n).alias("h"), (n > row_bytes).alias("long"))
    # The rank's bound reaches below the shuffle (WindowGroupLimit), so a hot language sends `rows` rows per task.
    order = Window.partitionBy("lang").orderBy("long", "h", "doc_id", "t")
    picked = known.withColumn("k", F.row_number().over(order)).where(F.col("k") <= rows).select("lang", "k", "t").collect()
    out: dict[str, list[bytes]] = {}
    for r in sorted(picked, key=lambda r: (r["lang"], r["k"])):
        taught = out.setdefault(r["lang"], [])
        if sum(map(len, taught)) < size:
            taught.append(letters(r["t"]).encode())
    return {lang: b" ".join(filter(None, t)) for lang, t in out.items() if any(t)}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self.langs = sorted(dictionaries)
        self.coders = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def __call__(self, text: str | None) -> tuple[str, float]:
        s = letters(text or "").encode()
        if not s or not self.langs:
            return "und", 0.0
        blocks = [s[i : i + BLOCK] for i in range(0, len(s), BLOCK)]
        sizes = [sum(map(len, map(c, blocks))) for c in self.coders]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.langs[0], 1.0
        second = min(x for i, x in enumerate(sizes) if i != best)
        return self.langs[best], (second - sizes[best]) / second


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(model.value)
        for b in batches:
            got = [classify(x.as_py()) for x in b.column("_text")]
            kept = [i for i, name in enumerate(b.schema.names) if name != "_text"]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], [*(b.schema.names[i] for i in kept), "lang_pred", "score"])

    return run


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns in keep (default: all) of docs, with lang_pred and score; narrow."""
    spark = docs.sparkSession
    common.ship(spark)
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
    rows = docs.select(F.struct(*names).alias("row"), F.col(text_col).alias("_text"))
    schema = StructType([rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(common.tidy(_predict(spark.sparkContext.broadcast(dictionaries))), schema).select("row.*", "lang_pred", "score")


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """docs, all columns as they are, without the rows whose language isn't told with a clear margin."""
    whole = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return identify(whole, dictionaries, keep=["row"]).where(accepted()).select("row.*")


def accepted(margin: float = MARGIN):
    """Of the columns of identify(): whether the answer is a language and its margin isn't narrow."""
    return (F.col("lang_pred") != "und") & (F.col("score") >= margin)
