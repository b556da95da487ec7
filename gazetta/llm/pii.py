"""Information-theoretic sanitisation of personal data, by DataFrame functions only.

Base spans are e-mail addresses, IP addresses, card and phone numbers found by patterns. Their values are the protected
entities. A term (a word of letters and digits, with a letter, of any length, outside base spans) in a document with an
entity discloses it as far as seeing the term tells the entity:
from the corpus, PMI(e; t) = log2(n(e,t) N / (n(e) n(t))), measured against the entity's information content
IC(e) = log2(N / n(e)); N counts distinct texts (copies count once), n(e), n(t) those with the entity or the term,
n(e,t) those with both, wherever they stand in it. Terms with PMI >= DISCLOSURE * IC are generalised, from REMOVAL * IC
on removed, at each place in the document; no support is asked for, as most entities occur once. Documents without
personal data stay as they are; base spans always stay.

Positions are code points, from 0, end exclusive. The patterns are rewritten so that Java's matcher, which recurses in
repeated groups and retries inside runs, takes linear time and no stack on any text; what they match is the same.

Edge cases: a null text is empty; rows are told apart by themselves, so null and repeated ids keep their own spans; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.llm import common

KINDS = ["email", "ip", "card", "phone", "term"]
#: Shares of the entity's information content from which a term is generalised and removed.
DISCLOSURE, REMOVAL = 0.8, 0.95

_JOINED = "\x01"  # stands for a separator inside a chain, one code point for one
_FROM_RUN = r"(?s)\G(.*?)((?:\G|(?<![{0}])){1})"
EMAIL = _FROM_RUN.format(r"A-Za-z0-9._%+\x01-", r"[A-Za-z0-9._%+\x01-]++@[A-Za-z0-9-]++\x01[A-Za-z0-9\x01-]*+")
IP = _FROM_RUN.format("0-9", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = r"(?s)\G(.*?)([0-9\x01]{12,}+)"
PHONE = r"(?s)\G(.*?)(\+[0-9][\x20().0-9-]+[0-9])"
TERM = r"(?s)\G([^\p{L}\p{N}]*+)([\p{L}\p{N}]++)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body names it (also inside its own lambdas)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def located(text: Column, pattern: str) -> Column:
    """Array of (start, end, m) of group 2 of a pattern whose matches tile the text from its start.

    Ends are prefix sums of the matches' lengths, taken from sums over blocks of 128 (a fold that appends to an array
    would copy it at every step).
    """
    whole, match = (F.regexp_extract_all(text, F.lit(pattern), F.lit(i)) for i in (0, 2))

    def spans(sizes: Column, found: Column) -> Column:
        blocks = F.when(F.size(sizes) > 0, F.transform(F.sequence(F.lit(0), F.floor(F.size(sizes) / 128).cast("int")), lambda b: _sum(F.slice(sizes, b * 128 + 1, 128))))

        def at(before: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                block = F.floor(i / 128).cast("int")
                end = F.get(before, block) + _sum(F.slice(sizes, block * 128 + 1, i % 128 + 1))
                return F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("m"))

            return F.transform(found, one)

        return let(blocks, lambda sums: let(F.transform(sums, lambda x, i: _sum(F.slice(sums, F.lit(1), i))), at))

    return let(F.transform(whole, F.length), lambda sizes: let(match, lambda found: spans(sizes, found)))


def joined(text: Column, around: str, separators: str) -> Column:
    """The text with single separators between two characters of a class marked."""
    return F.regexp_replace(F.translate(text, _JOINED, "\x02"), f"(?<=[{around}]){separators}(?=[{around}])", _JOINED)


def luhn(digits: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, -i, F.lit(1)).cast("int")
        twice = d * 2
        return (acc + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    """Array of (start, kind index, end) in order; the text must not be null."""
    digits = lambda m: F.regexp_replace(m, "[^0-9]", "")
    part = "^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"
    checks = [
        (F.contains(text, F.lit("@")), lambda: located(joined(text, "A-Za-z0-9-", r"\."), EMAIL), lambda m: F.lit(True)),
        (text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), lambda: located(text, IP), lambda m: F.forall(F.split(m, r"\."), lambda p: p.rlike(part))),
        (
            text.rlike("[0-9][0-9 -]{10,}[0-9]"),
            lambda: located(joined(text, "0-9", "[ -]"), CARD),
            lambda m: F.when(F.length(digits(m)).between(12, 19), luhn(digits(m))).otherwise(F.lit(False)),
        ),
        (F.contains(text, F.lit("+")), lambda: located(text, PHONE), lambda m: F.length(digits(m)).between(9, 15)),
    ]

    def of_kind(k: int, maybe: Column, find, valid) -> Column:
        good = F.filter(find(), lambda s: valid(s["m"]))
        as_span = F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end")))
        return F.when(maybe, as_span).otherwise(F.array().cast("array<struct<start:int,k:int,end:int>>"))

    return F.array_sort(F.concat(*(of_kind(k, *c) for k, c in enumerate(checks))))


def blanked(text: Column, spans: Column) -> Column:
    """The text with base spans (in order, they may overlap) as spaces, so that positions stay."""
    kind = "struct<pos:int,out:array<string>>"

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] > acc["pos"], F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"])).otherwise(F.lit(""))
        hole = F.repeat(F.lit(" "), s["end"] - F.greatest(s["start"], acc["pos"]))
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), F.concat(acc["out"], F.array(gap, hole)).alias("out")).cast(kind)

    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out")).cast(kind)
    return F.aggregate(spans, start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["pos"] + 1, F.length(text))))


def entities(text: Column, spans: Column) -> Column:
    """The distinct entities that the base spans of a text show."""

    def one(s: Column) -> Column:
        value = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        same = F.when(s["k"] == 0, F.lower(value)).when(s["k"] == 1, value).otherwise(F.regexp_replace(value, "[^0-9]", ""))
        return F.concat_ws(":", s["k"].cast("string"), same)

    return F.array_distinct(F.transform(spans, one))


def terms(text: Column, spans: Column) -> Column:
    """Array of (start, end, term) for the terms of a text outside its base spans."""
    found = F.filter(located(blanked(text, spans), TERM), lambda s: s["m"].rlike(r"\p{L}"))
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lower(s["m"]).alias("term")))


def words(text: Column) -> Column:
    """The distinct words of a text, in lower case."""
    return F.array_distinct(F.transform(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: F.lower(w)))


def disclosing_terms(docs: DataFrame, units: DataFrame, n_texts: int, disclosure: float = DISCLOSURE) -> DataFrame:
    """key, term, share (PMI / IC, the greatest of the text's entities) of the terms whose share reaches the threshold.

    docs: key and text of every row; units: key, entities, terms of each distinct text with entities.
    """
    shown = units.select("key", F.explode("entities").alias("entity"))
    n_e = shown.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).where(F.col("n_e") < n_texts)
    # A text's words go through the shuffle that drops copies, not the text.
    once = docs.select("key", F.concat_ws(" ", words(F.col("text"))).alias("words")).dropDuplicates(["key"])
    n_t = once.select(F.explode(F.split("words", " ")).alias("term")).where(F.col("term").rlike(r"\p{L}")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    held = units.select("key", F.explode(F.array_distinct(F.transform("terms", lambda t: t["term"]))).alias("term"))
    counted = held.join(n_t, "term", "left").withColumn("n_t", F.coalesce("n_t", F.lit(1)))
    # As n(e,t) <= n(e), the threshold can be reached up to this n(t) only; the margin is for rounding.
    most = F.pow(F.col("n_e").cast("double"), F.lit(disclosure)) * float(max(n_texts, 1)) ** (1 - disclosure) * (1 + 1e-9)
    content = lambda n_e: F.log2(F.lit(float(n_texts)) / n_e)
    told = shown.join(n_e, "entity").withColumn("most", most)
    # A term that stands in one text alone tells every entity of it (PMI = IC); and the entities that stand in one text alone
    # are told alike by its terms. So these don't meet: the former are flagged as they are, of the latter one is looked at.
    some = told.groupBy("key").agg(F.max("most").alias("most"))
    # Both are taken from one saved join, so that a text's terms are dealt once.
    held, _ = common.saved(counted.join(some, "key").where("n_t <= most").drop("most"), "held")
    alone = held.where("n_t = 1").select("key", "term", F.lit(1.0).alias("share"))
    several = held.where("n_t > 1")
    first = told.where("n_e = 1").groupBy("key").agg(F.min("entity").alias("entity"), F.first("n_e").alias("n_e"), F.first("most").alias("most"))
    looked_at = told.where("n_e > 1").select("key", "entity", "n_e", "most").unionByName(first)
    pairs, _ = common.saved(looked_at.join(several, "key").where("n_t <= most").drop("most"), "pairs")
    both = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"), F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t"))
    pmi = F.log2(F.col("n_et") * F.lit(float(n_texts)) / (F.col("n_e") * F.greatest("n_t", "n_et")))
    flagged = both.select("entity", "term", (pmi / content(F.col("n_e"))).alias("share")).where(F.col("share") >= disclosure)
    met = pairs.select("key", "entity", "term").join(flagged, ["entity", "term"]).select("key", "term", "share")
    return met.unionByName(alone).groupBy("key", "term").agg(F.max("share").alias("share"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE, keep_text: bool = False) -> DataFrame:
    """doc_id, spans (base), added (start, k, end, share) and, if asked for, text of each row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), common.text_or_empty(text_col).alias("text"))
    key = F.unhex(F.sha2("text", 256)).alias("key")
    spotted = rows.select(key, "doc_id", base_spans(F.col("text")).alias("spans"), "text")
    some = F.size("spans") > 0
    shown, held = (F.when(some, f(F.col("text"), F.col("spans"))).alias(f.__name__) for f in (entities, terms))
    base, _ = common.saved(spotted.select("key", "doc_id", "spans", shown, held, *["text"] * keep_text), "spans")
    # A number stands for the digest of a text wherever its terms are dealt: a quarter of the bytes, and they compress.
    personal = base.where(some).select("key", "entities", "terms").dropDuplicates(["key"])
    units, _ = common.saved(personal.withColumn("unit", F.monotonically_increasing_id()), "personal")
    numbered = units.select(F.col("unit").alias("key"), "entities", "terms")
    flagged = disclosing_terms(rows.select(key, "text"), numbered, base.select("key").distinct().count(), disclosure)
    added = numbered.select("key", F.inline("terms")).join(flagged, ["key", "term"])
    added = added.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", F.lit(4).alias("k"), "end", "share"))).alias("added"))
    added = units.select("key", "unit").join(added.withColumnRenamed("key", "unit"), "unit").drop("unit")
    none = F.array().cast("array<struct<start:int,k:int,end:int,share:double>>")
    columns = ["doc_id", "spans", F.coalesce("added", none).alias("added"), *["text"] * keep_text]
    return base.where(some).join(added, "key", "left").select(columns).unionByName(base.where(~some).withColumn("added", none).select(columns))


def _told(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", names[s["k"]], s["start"].cast("string"), s["end"].cast("string"))))


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the SHA-256 of the base spans, and all spans in order, of find_personal_data()'s rows."""
    of_kind = lambda k: F.filter("spans", lambda s: s["k"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS[:4])]
    every = F.array_sort(F.concat("spans", F.transform("added", lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end")))))
    return found.select("doc_id", *counts, F.sha2(_told(F.col("spans")), 256).alias("base_sha256"), _told(every).alias("spans"))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE, removal: float = REMOVAL) -> DataFrame:
    """doc_id and text with base spans named by kind, disclosing terms generalised to [term] or, above removal, removed."""
    found = find_personal_data(docs, id_col, text_col, disclosure, keep_text=True)
    names = F.array(*(F.lit(f"[{k}]") for k in KINDS))
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), names[s["k"]].alias("name")))
    terms = F.transform("added", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["share"] >= removal, F.lit("")).otherwise(names[4]).alias("name")))
    kind = "struct<pos:int,out:array<string>>"
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] > acc["pos"], F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"])).otherwise(F.lit(""))
        name = F.when(s["start"] >= acc["pos"], s["name"]).otherwise(F.lit(""))  # of overlapping spans the first names the hole
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), F.concat(acc["out"], F.array(gap, name)).alias("out")).cast(kind)

    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out")).cast(kind)
    made = F.aggregate(F.array_sort(F.concat(base, terms)), start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["pos"] + 1, F.length(text))))
    return found.select("doc_id", made.alias("text"))
