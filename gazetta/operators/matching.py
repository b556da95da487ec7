"""Whole-word matching of many spellings in many addresses, as an equality join.

A spelling matches between two word boundaries (a change between [0-9A-Za-z_] and anything else). An address is cut once
into its runs of word and of other characters; every sequence of runs, up to the longest spelling, is a piece, and pieces
are joined by hash with the dictionary; no pattern is ever tried. Of one area's overlapping matches, the leftmost and
then the longest stays.

A dictionary that is small enough is broadcast. Beyond that its spellings are a *trie*: a table of all their beginnings,
run by run. Pieces then grow by a run at a time, and only those that some spelling goes on from are dealt again.

Areas that are spelled alike match alike. A dictionary may so hold a class in the place of their codes (gazetteer.alike());
then matches of classes are what is dealt, gathered and scored, and their areas come last (spread()), where nothing moves.

Equal addresses match alike too: match_areas() matches each different text once. What is scored mixes the addresses of an
idx, so there it is the *unit* that is matched and scored once: the different addresses of an idx, in order (units()).

The matcher is case-sensitive unless spellings() is told otherwise; then letters are folded one by one (folded()), so that
places in the folded text are places in the address, whose own text and positions are reported.
"""

from __future__ import annotations

import re
import sys
from functools import cache, reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions.text import let, running_total

#: Rows up to which a dictionary or gazetteer is fetched once, put into later plans as rows and broadcast (some 100 bytes
#: each); beyond it Spark joins as it sees fit.
LOCAL_ROWS = 100_000
#: Rows of a table made of the gazetteer (some 200 bytes each) up to which Spark broadcasts it where it stands last in a plan.
BROADCAST_ROWS = 1_000_000
_RUNS = "[0-9A-Za-z_]+|[^0-9A-Za-z_]+"
#: Letters outside ASCII that fold to a letter of ASCII; a piece that holds one may have more runs than its spelling.
_INTO_ASCII = "[\u017f\u212a]"


class Spellings(NamedTuple):
    """A dictionary (kind, code, name, level, variant) with what the matcher has to know of it before it plans."""

    table: DataFrame
    most_runs: int
    longest: int
    local: bool  # few enough to be broadcast
    case_sensitive: bool = True
    members: DataFrame | None = None  # kind, class, name, code, where the table's codes are classes


@cache
def _fold() -> tuple[str, str]:
    """Letters and what they fold to, one character each: upper case and variant forms to the common lower case."""
    pairs = {}
    for c in map(chr, range(sys.maxunicode + 1)):
        to = up.lower() if len(up := c.upper()) == 1 and len(up.lower()) == 1 else c.lower()
        if to != c and len(to) == 1:
            pairs[c] = to
    return "".join(pairs), "".join(pairs.values())


def folded(text: Column) -> Column:
    """The text with every letter folded to one character, so lengths and positions stay (unlike lower-casing, by which
    U+0130 becomes two characters)."""
    return F.translate(text, *_fold())


def runs(text: Column) -> Column:
    """The maximal runs of word characters and of others; only ASCII letters, digits and _ are word characters."""
    return F.regexp_extract_all(text, F.lit(_RUNS), F.lit(0))


def local_rows(df: DataFrame) -> pa.Table | None:
    """The rows of df if they are few, else None; one job."""
    head = df.limit(LOCAL_ROWS + 1).toArrow()
    return head if head.num_rows <= LOCAL_ROWS else None


def spellings(dictionary: DataFrame, case_sensitive: bool = True, fetched: pa.Table | None = None, members: DataFrame | None = None) -> Spellings:
    """A dictionary made ready once, so that no later plan makes the spellings again. fetched: its rows, where known;
    members: the areas of its classes (kind, class, name, code), if its codes are classes."""
    if not case_sensitive and fetched is None:
        dictionary = dictionary.withColumn("variant", folded(F.col("variant"))).distinct()
    rows = fetched if fetched is not None else local_rows(dictionary)
    if rows is not None:
        words = rows.column("variant").to_pylist()
        table = dictionary.sparkSession.createDataFrame(rows, dictionary.schema)
        return Spellings(table, max((len(re.findall(_RUNS, w)) for w in words), default=0), max(map(len, words), default=0), True, case_sensitive, members)
    most = dictionary.agg(F.max(F.size(runs(F.col("variant")))), F.max(F.length("variant"))).first()
    return Spellings(dictionary, *most, False, case_sensitive, members)


def windows(addresses: DataFrame, known: Spellings) -> DataFrame:
    """idx, addr, start_idx, w (runs, as many as a spelling may have) for each place between two boundaries.

    The runs are taken from the address once, outside every lambda; what is exploded are short windows of them.
    """
    cut = addresses.select("idx", "addr", runs(F.col("addr")).alias("runs"))
    is_word = lambda run: run.rlike("^[0-9A-Za-z_]")
    # The ends of a text are boundaries only beside a word character.
    opens = F.when(is_word(F.get("runs", F.lit(0))), 0).otherwise(1)
    closes = F.size("runs") - F.when(is_word(F.get("runs", F.size("runs") - 1)), 0).otherwise(1)
    most = F.lit(known.most_runs)
    if not known.case_sensitive:
        most = F.when(F.col("addr").rlike(_INTO_ASCII), F.lit(known.longest)).otherwise(most)

    def from_each(before: Column) -> Column:
        at = lambda i: F.struct(F.get(before, i).alias("s"), F.slice("runs", i + 1, F.least(F.col("most"), F.col("z") - i)).alias("w"))
        return F.when(F.col("a") < F.col("z"), F.transform(F.sequence("a", F.col("z") - 1), at))

    bounded = cut.withColumns({"a": opens, "z": closes, "most": most, "sizes": F.transform("runs", F.length)})
    return bounded.select("idx", "addr", F.inline(let(running_total(F.col("sizes")), from_each)).alias("start_idx", "w"))


def _spelled(piece: Column, known: Spellings) -> Column:
    return piece if known.case_sensitive else folded(piece)


def hits_by_pieces(addresses: DataFrame, known: Spellings) -> DataFrame:
    """idx, addr, start_idx and the columns of the dictionary for each piece that is a spelling; every piece is looked up."""
    each = windows(addresses, known)
    grown = F.transform(F.sequence(F.lit(1), F.size("w")), lambda j: F.array_join(F.slice("w", F.lit(1), j), ""))
    pieces = each.select("idx", "addr", "start_idx", F.explode(grown).alias("piece")).withColumn("variant", _spelled(F.col("piece"), known))
    return pieces.drop("piece").join(F.broadcast(known.table) if known.local else known.table, "variant")


def trie(known: Spellings) -> DataFrame:
    """prefix, ends (whether it is a spelling), goes_on (whether some spelling is longer) for all beginnings of spellings."""
    cut = known.table.select("variant").distinct().select(runs(F.col("variant")).alias("w"))
    begun = cut.select(F.size("w").alias("n"), F.posexplode(F.transform("w", lambda x, i: F.array_join(F.slice("w", F.lit(1), i + 1), ""))).alias("i", "prefix"))
    return begun.groupBy("prefix").agg(F.max(F.col("i") + 1 == F.col("n")).alias("ends"), F.max(F.col("i") + 1 < F.col("n")).alias("goes_on"))


def hits_by_trie(addresses: DataFrame, known: Spellings) -> DataFrame:
    """The same by the trie: at each step only the pieces that some spelling goes on from grow by a run.

    Folded letters can make one run of several; texts that hold such a letter are looked up by pieces.
    """
    at_hand = F.broadcast if known.local else lambda df: df
    beginnings, found = at_hand(trie(known)), []
    plain = addresses if known.case_sensitive else addresses.where(~F.col("addr").rlike(_INTO_ASCII))
    state = windows(plain, known).withColumn("prefix", _spelled(F.get("w", F.lit(0)), known))
    for step in range(1, known.most_runs + 1):
        met = state.join(beginnings, "prefix")
        found.append(met.where("ends").select("idx", "addr", "start_idx", F.col("prefix").alias("variant")))
        going = met.where(F.col("goes_on") & (F.size("w") > step))
        state = going.select("idx", "addr", "start_idx", "w", F.concat("prefix", _spelled(F.get("w", F.lit(step)), known)).alias("prefix"))
    if not found:
        return hits_by_pieces(addresses, known)
    hits = reduce(DataFrame.unionByName, found).join(at_hand(known.table), "variant")
    if known.case_sensitive:
        return hits
    return hits.unionByName(hits_by_pieces(addresses.where(F.col("addr").rlike(_INTO_ASCII)), known))


#: Spans that one fold appends to an array; each append copies it.
_FOLD = 64


def _leftmost_longest(spans: Column) -> Column:
    """Of spans (s, minus length), those that begin behind the end of the one kept before.

    A fold in parts: what a part keeps is one element of the fold over parts, so no long array is copied at each span.
    """
    spans_type = "array<struct<s:int,e:int>>"
    kind, outer = f"struct<last:int,kept:{spans_type}>", f"struct<last:int,kept:array<{spans_type}>>"
    ended = lambda x: F.struct(x["s"].alias("s"), (x["s"] - x["m"] - 1).alias("e"))

    def step(acc: Column, x: Column) -> Column:
        more = F.struct((x["s"] - x["m"] - 1).alias("last"), F.concat(acc["kept"], F.array(ended(x))).alias("kept"))
        return F.when(x["s"] > acc["last"], more.cast(kind)).otherwise(acc).cast(kind)

    def part(acc: Column, some: Column) -> Column:
        start = F.struct(acc["last"].alias("last"), F.array().cast(spans_type).alias("kept")).cast(kind)
        return let(F.aggregate(some, start, step), lambda x: F.struct(x["last"].alias("last"), F.concat(acc["kept"], F.array(x["kept"])).alias("kept")).cast(outer))

    def fold(ordered: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(ordered) - 1) / _FOLD).cast("int")), lambda i: F.slice(ordered, i * _FOLD + 1, _FOLD))
        start = F.struct(F.lit(-1).alias("last"), F.array().cast(f"array<{spans_type}>").alias("kept")).cast(outer)
        return F.aggregate(parts, start, part, lambda acc: F.flatten(acc["kept"]))

    return F.when(F.size(spans) == 1, F.transform(spans, ended).cast(spans_type)).otherwise(let(F.sort_array(spans), fold))


def match_areas(addresses: DataFrame, dictionary: DataFrame | Spellings, case_sensitive: bool = True, by_trie: bool | None = None) -> DataFrame:
    """idx, addr, kind, code, name, level, start_idx, end_idx (inclusive; both are places in addr as it is given).

    A dictionary that is used for several tables is prepared once by spellings(). by_trie: how to look it up (by default
    by the trie if it is too large for a broadcast).
    """
    known = dictionary if isinstance(dictionary, Spellings) else spellings(dictionary, case_sensitive)
    return spread(match_once(addresses, known, by_trie), known)


def spread(matches: DataFrame, known: Spellings) -> DataFrame:
    """Matches of classes as matches of their areas (as they are, where the dictionary has codes)."""
    if known.members is None:
        return matches
    return matches.withColumnRenamed("code", "class").join(known.members, ["kind", "class", "name"]).select(*matches.columns)


def dealt(rows: DataFrame, *by: str) -> DataFrame:
    """Rows dealt by idx (or other columns), which makes many tasks of a small file; with a fixed number of partitions, as
    their bytes don't tell the work. Before what groups by the same columns, as Spark drops it behind that."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *(by or ["idx"]))


def units(addresses: DataFrame) -> DataFrame:
    """idx, unit: the different addresses of each idx in order, of which all follows that is matched and scored of it."""
    return addresses.groupBy("idx").agg(F.sort_array(F.collect_set("addr")).alias("unit"))


def match_units(units: DataFrame, known: Spellings) -> DataFrame:
    """match_classes() of the different units, each as the idx of its addresses."""
    return match_classes(dealt(units.select(F.col("unit").alias("idx"))).distinct().select("idx", F.explode("idx").alias("addr")), known)


def match_once(addresses: DataFrame, known: Spellings, by_trie: bool | None = None) -> DataFrame:
    """match_classes() in which equal addresses are matched once. Rows of a class lie together in each task, so what is spread
    over its areas repeats and takes little room where it is written."""
    rows, texts = addresses.select("idx", "addr").distinct(), dealt(addresses.select(F.col("addr").alias("idx"))).distinct()
    found = _kept(texts.select("idx", F.col("idx").alias("addr")), known, by_trie)
    return _placed(dealt(rows.join(found.drop("idx"), "addr")).sortWithinPartitions("kind", "name", "code"))


def match_classes(addresses: DataFrame, known: Spellings, by_trie: bool | None = None) -> DataFrame:
    """match_areas() with what the dictionary has as codes, be they classes, for addresses that rarely are equal."""
    return _placed(_kept(addresses, known, by_trie))


def _kept(addresses: DataFrame, known: Spellings, by_trie: bool | None) -> DataFrame:
    """idx, addr, kind, code, name, level, kept: an array of spans (s, e)."""
    # Addresses are dealt before they are cut into pieces. What is found is in place for all that follows.
    rows = dealt(addresses.select("idx", "addr"))
    look = hits_by_trie if (not known.local if by_trie is None else by_trie) else hits_by_pieces
    hits = look(rows, known).select("idx", "addr", "kind", "code", "name", "level", "start_idx", F.length("variant").alias("n"))
    by_area = hits.groupBy("idx", "addr", "kind", "code", "name", "level")
    return by_area.agg(_leftmost_longest(F.collect_set(F.struct(F.col("start_idx").alias("s"), (-F.col("n")).alias("m")))).alias("kept"))


def _placed(kept: DataFrame) -> DataFrame:
    return kept.select("idx", "addr", "kind", "code", "name", "level", F.inline("kept").alias("s", "e")).select(
        "idx", "addr", "kind", "code", "name", "level", F.col("s").cast("long").alias("start_idx"), F.col("e").cast("long").alias("end_idx")
    )


def match_table(matches: DataFrame, kind: str) -> DataFrame:
    """The matches of one kind, with the columns idx, addr, <kind>, <kind>_code, start_idx, end_idx."""
    return matches.where(F.col("kind") == kind).select("idx", "addr", F.col("name").alias(kind), F.col("code").alias(f"{kind}_code"), "start_idx", "end_idx")


def gathered(matches: DataFrame) -> DataFrame:
    """idx, and each: an array of (addr, areas), areas an array of (kind, code, name, spans), spans (s, e) in order of s.

    Usually an idx has one address. The address stands once, not beside each match. Matches of match_areas() are dealt by
    idx already, so nothing moves.
    """
    spans = F.sort_array(F.collect_set(F.struct(F.col("start_idx").alias("s"), F.col("end_idx").alias("e")))).alias("spans")
    by_area = matches.groupBy("idx", "addr", "kind", "code", "name").agg(spans)
    by_addr = by_area.groupBy("idx", "addr").agg(F.collect_list(F.struct("kind", "code", "name", "spans")).alias("areas"))
    return by_addr.groupBy("idx").agg(F.collect_list(F.struct("addr", "areas")).alias("each"))
