"""Scoring strategies: combinations of matched areas that lie in order and belong together in the gazetteer.

A strategy is a row of STRATEGIES. The matches of an address are one row (gathered()), and one expansion runs all of them:
each area of it is looked up once in the gazetteer, which names for each strategy the areas it may go on with; these, and
their spans that come later, are found by binary search in the address's areas and spans (which are in order), so the work
follows what is found, not the square of an address's matches, and the matching stands once in the plan. What has the same
score is spread over the gazetteer's rows only afterwards, by a join with blocks of them, so a task that writes holds few
rows at a time, however many a score is of.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions.text import let
from gazetta.plans.gazetteer import KINDS

AREAS = ["ward_code", "ward", "district_code", "district", "province_code", "province"]
RESULT = ["idx", "addr", *AREAS, "score"]


class Strategy(NamedTuple):
    name: str
    areas: tuple[str, ...]
    factor: float
    gaps: bool = True  # whether half the distance between neighbours counts against the score


# The factors; the order is that of preference among equal scores.
STRATEGIES = [
    Strategy("wdp", ("ward", "district", "province"), 3.0),
    Strategy("wd", ("ward", "district"), 1.5),
    Strategy("wp", ("ward", "province"), 1.5, gaps=False),
    Strategy("dp", ("district", "province"), 2.0),
    Strategy("p", ("province",), 0.5),
    Strategy("d", ("district",), 0.2),
    Strategy("w", ("ward",), 0.02),
]
#: Columns of a gazetteer with classes (gazetteer.classed()), in the place of the codes in AREAS.
CLASSES = ["ward_class", "district_class", "province_class"]
#: Rows of the gazetteer that lie together in members(). Spark copies and holds all rows that it makes of one of a join.
BLOCK = 64


def _length(match: Column) -> Column:
    return match["e"] - match["s"] + 1


def _extended(s: Strategy, total: Column, before: Column, match: Column) -> Column:
    """The sum of lengths, less gaps, of a chain of matches with one more."""
    longer = total + _length(match).cast("double")
    return longer - (match["s"] - before["e"]).cast("double") * F.lit(0.5) if s.gaps else longer


def _place(ordered: Column, below: Callable[[Column], Column]) -> Column:
    """How many of an array's elements are below a border, which those in front of it are: by binary search."""
    start = F.struct(F.lit(0).alias("lo"), F.size(ordered).alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.shiftright(acc["lo"] + acc["hi"], 1)
        up = (acc["lo"] < acc["hi"]) & below(F.get(ordered, middle))
        return F.struct(F.when(up, middle + 1).otherwise(acc["lo"]).alias("lo"), F.when(up, acc["hi"]).otherwise(middle).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.length(F.bin(F.size(ordered)))), start, halve, lambda acc: acc["lo"])


def _named(areas: Column, kind: str) -> Column:
    """Spans of the area of a kind that the gazetteer row names: an array for each address that has it (areas: in order)."""
    of = lambda x: F.struct(x["code"].alias("code"), x["name"].alias("name"))
    key = F.struct(F.col(f"_{kind}_code").alias("code"), F.col(f"_{kind}").alias("name"))
    found = let(_place(areas, lambda x: of(x) < key), lambda lo: F.slice(areas, lo + 1, _place(areas, lambda x: of(x) <= key) - lo))
    return F.transform(found, lambda x: x["spans"])


def _after(named: Column, end: Column) -> Column:
    """Of arrays of spans in order, the spans that begin behind `end`."""
    rest = lambda spans: let(_place(spans, lambda x: x["s"] <= end), lambda lo: F.slice(spans, lo + 1, F.size(spans) - lo))
    return F.flatten(F.transform(named, rest))


def _scored(s: Strategy) -> Column:
    """An array of the scores of all chains of a strategy that begin with a span of the first area."""
    told = lambda total: total * F.lit(s.factor)
    length = lambda first: _length(first).cast("double")
    spans, all_of = F.col("_spans"), lambda area: F.col(f"_named_{area}")
    if len(s.areas) == 1:
        return F.transform(spans, lambda first: told(length(first)))
    second = all_of(s.areas[1])
    if len(s.areas) == 2:
        return F.flatten(F.transform(spans, lambda first: F.transform(_after(second, first["e"]), lambda m: told(_extended(s, length(first), first, m)))))

    def of(first: Column) -> Column:
        more = lambda m: F.transform(_after(all_of(s.areas[2]), m["e"]), lambda x: told(_extended(s, _extended(s, length(first), first, m), m, x)))
        return F.flatten(F.transform(_after(second, first["e"]), more))

    return F.flatten(F.transform(spans, of))


def _looked_up(gazetteer: DataFrame, strategies: list[Strategy], classes: bool) -> tuple[DataFrame, list[str]]:
    """The gazetteer's rows for each strategy: with its number, the area that it begins with (kind, code, name) and the others
    that it needs (with _ in front, null if it doesn't need them); and the names of all these columns."""
    rows, key = gazetteer.select(*AREAS, *CLASSES * classes).distinct(), "class" if classes else "code"

    def begun(s: Strategy) -> Column:
        code = lambda k: F.col(f"{k}_{key}")
        need = lambda k, c: (c if k in s.areas[1:] else F.lit(None).cast("string"))
        others = [x for k in KINDS[1:] for x in (need(k, code(k)).alias(f"_{k}_code"), need(k, F.col(k)).alias(f"_{k}"))]
        known = reduce(Column.__and__, (code(k).isNotNull() & F.col(k).isNotNull() for k in s.areas))
        return F.when(known, F.struct(F.lit(STRATEGIES.index(s)).alias("strategy"), F.lit(s.areas[0]).alias("kind"), code(s.areas[0]).alias("code"), F.col(s.areas[0]).alias("name"), *others))

    every = rows.select(*AREAS, F.explode(F.array_compact(F.array(*map(begun, strategies)))).alias("_b"))
    by = ["strategy", "kind", "code", "name", *(f"_{c}" for c in AREAS[2:])]
    return every.select(*AREAS, *(F.col(f"_b.{c}").alias(c) for c in by)), by


def lookup(gazetteer: DataFrame, fan_out: bool = True, strategies: list[Strategy] = STRATEGIES, classes: bool = False) -> DataFrame:
    """For each strategy the combinations of areas in the gazetteer that it may score: strategy, kind, code and name of the
    first area, those of the others, and of (fan-out: what members() knows the combination by) or, without fan-out, member:
    the gazetteer's row of it that wins the tie rule.

    classes: of a gazetteer with classes (gazetteer.classed()), for matches of classes.
    """
    every, by = _looked_up(gazetteer, strategies, classes)
    if fan_out:
        return every.select(*by).distinct().select(*by, _of(by))
    return every.groupBy(*by).agg(F.min(F.struct("ward_code", "district_code", "province_code", "ward", "district", "province")).alias("member"))


def _of(by: list[str]) -> Column:
    return F.unhex(F.sha2(F.to_json(F.struct(*by)), 256)).alias("of")


def members(gazetteer: DataFrame, strategies: list[Strategy] = STRATEGIES, classes: bool = False) -> DataFrame:
    """of, and block: an array of the AREAS of gazetteer's rows, BLOCK of them at most; together those that a combination of
    lookup() stands for."""
    every, by = _looked_up(gazetteer, strategies, classes)
    place = F.row_number().over(Window.partitionBy("of").orderBy(*AREAS))
    placed = every.select(_of(by), F.struct(*AREAS).alias("row"), *AREAS).select("of", "row", F.floor((place - 1) / BLOCK).alias("_block"))
    return placed.groupBy("of", "_block").agg(F.sort_array(F.collect_list("row")).alias("block")).drop("_block")


def chains(gathered: DataFrame, areas: DataFrame, strategies: list[Strategy] = STRATEGIES, best_of_each: bool = False) -> DataFrame:
    """idx, addr, strategy, scores (of every chain of matches), of, for all strategies, to be told() and spread() over members().

    areas: of lookup(). best_of_each (areas without fan-out): the RESULT columns and the strategy, with the best chain for each
    row of lookup(); the score is null if there is none.
    """
    kinds = [k for k in KINDS if any(s.areas[0] == k for s in strategies)]

    def all_of(kind: str) -> Column:
        mine = lambda x: F.transform(F.filter(x["areas"], lambda a: a["kind"] == kind), lambda a: F.struct(a["code"], a["name"], a["spans"]))
        return F.sort_array(F.flatten(F.transform("each", mine))).alias(f"_all_{kind}")

    rows = gathered.select("idx", *map(all_of, KINDS[1:]), F.inline("each").alias("addr", "_areas"))
    first = F.filter("_areas", lambda a: a["kind"].isin(kinds))
    rows = rows.select("idx", "addr", *(f"_all_{k}" for k in KINDS[1:]), F.inline(first).alias("_kind", "_code", "_name", "_spans"))
    rows = rows.join(areas, (F.col("_kind") == F.col("kind")) & (F.col("_code") == F.col("code")) & (F.col("_name") == F.col("name")))
    # Only what the address has all areas of is scored.
    there = lambda k: F.col(f"_{k}_code").isNull() | F.exists(f"_all_{k}", lambda a: (a["code"] == F.col(f"_{k}_code")) & (a["name"] == F.col(f"_{k}")))
    rows = rows.where(reduce(Column.__and__, map(there, KINDS[1:])))
    # The spans of the other areas are columns of their own, so that they are looked up once.
    later = lambda k: F.when(F.col(f"_{k}_code").isNotNull(), _named(F.col(f"_all_{k}"), k)).alias(f"_named_{k}")
    told = "member" if best_of_each else "of"
    rows = rows.select("idx", "addr", "strategy", "_spans", told, *map(later, KINDS[1:]))
    scored = F.array().cast("array<double>")
    for s in strategies:
        scored = F.when(F.col("strategy") == STRATEGIES.index(s), _scored(s)).otherwise(scored)
    if best_of_each:
        return rows.select("idx", "addr", *(F.col(f"member.{c}").alias(c) for c in AREAS), F.array_max(scored).alias("score"), "strategy")
    return rows.select("idx", "addr", "strategy", scored.alias("scores"), "of").where(F.size("scores") > 0)


def all_scores(gathered: DataFrame, areas: DataFrame, strategies: list[Strategy] = STRATEGIES, best_of_each: bool = False) -> DataFrame:
    """chains(), told()."""
    found = chains(gathered, areas, strategies, best_of_each)
    return found if best_of_each else told(found)


def told(chains: DataFrame) -> DataFrame:
    """idx, addr, strategy, score, of: a row for each score of chains()."""
    return chains.select("idx", "addr", "strategy", F.explode("scores").alias("score"), "of")


def spread(scores: DataFrame, members: DataFrame) -> DataFrame:
    """The RESULT columns and the strategy's number: a row for each row of the gazetteer that a score is of."""
    met = scores.join(members, "of").select("idx", "addr", "score", "strategy", F.inline("block"))
    return met.select(*RESULT, "strategy")


def best(scores: DataFrame) -> DataFrame:
    """One row for each idx: highest score, then earliest strategy, then smallest codes. The minimum of an ordered struct, so
    partial results can be merged."""
    order = F.struct((-F.col("score")).alias("below"), "strategy", "ward_code", "district_code", "province_code", "addr", "ward", "district", "province")
    top = scores.groupBy("idx").agg(F.min(F.when(F.col("score").isNotNull(), order)).alias("b"))
    return top.select("idx", *(F.col(f"b.{c}").alias(c) for c in RESULT[1:-1]), (-F.col("b.below")).alias("score"), F.col("b.strategy").alias("strategy"))
