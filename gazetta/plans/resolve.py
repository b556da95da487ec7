"""From raw addresses to the best structured address."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gazetta.functions.text import normalize_strings
from gazetta.operators import matching, scoring
from gazetta.plans import gazetteer as gz


class Known(NamedTuple):
    """A gazetteer made ready: the spellings of its classes, and its rows with classes, broadcast if they are few."""

    spellings: matching.Spellings
    gazetteer: DataFrame
    names: dict[str, int]  # areas, long_names: counted as the spellings were made
    rows: int = 0  # how many there are, at least


def prepare(gazetteer: DataFrame, case_sensitive: bool = True) -> Known:
    """One job fetches spellings and rows; a gazetteer that is too large for that stays a plan. Its spellings are those of
    its classes, which are fetched by themselves if they are few."""
    seen, again = Observation("areas"), Observation("all areas")
    alike = gz.alike(gazetteer)
    rows, members = gz.classed(gazetteer, alike), alike.where("name IS NOT NULL").select("kind", "class", "name", "code")
    spelled = gz.dictionary_of_classes(gz.alike(gazetteer, seen))
    if not case_sensitive:
        spelled = spelled.withColumn("variant", matching.folded(F.col("variant"))).distinct()
    head = matching.local_rows(spelled.withColumn("spelled", F.lit(True)).unionByName(rows.withColumn("spelled", F.lit(False)), allowMissingColumns=True))
    if head is None:
        many = rows.count()
        at_hand = F.broadcast if many <= matching.BROADCAST_ROWS else lambda df: df
        return Known(matching.spellings(gz.dictionary_of_classes(gz.alike(gazetteer, again)), case_sensitive, members=at_hand(members)), at_hand(rows), again.get, many)
    told = head.column("spelled")
    d = head.filter(told).select(spelled.columns)
    g = head.filter(pc.invert(told)).select(rows.columns)
    return Known(matching.spellings(spelled, case_sensitive, fetched=d, members=F.broadcast(members)), F.broadcast(gazetteer.sparkSession.createDataFrame(g, rows.schema)), seen.get, g.num_rows)


def _at_hand(df: DataFrame, known: Known, times: int = 1) -> DataFrame:
    """A table of so many rows for each of the gazetteer's, broadcast if they are few."""
    return F.broadcast(df) if times * known.rows <= matching.BROADCAST_ROWS else df


def _every(matches: DataFrame, known: Known, strategies: list[scoring.Strategy], units: DataFrame | None = None) -> DataFrame:
    """Every score for matches; of units: for matches of their classes, which are scored once for all idx of a unit."""
    areas, members = (f(known.gazetteer, strategies=strategies, classes=units is not None) for f in (scoring.lookup, scoring.members))
    scored = scoring.chains(matching.gathered(matches), _at_hand(areas, known, len(strategies)), strategies)
    if units is not None:
        # What is spread over the same rows of the gazetteer lies together, so it repeats and takes little room where it is written.
        scored = matching.dealt(_of_units(units, scored)).sortWithinPartitions("of")
    return scoring.spread(scoring.told(scored), _at_hand(members, known, len(strategies)))


def _of_units(units: DataFrame, told: DataFrame) -> DataFrame:
    """What is told of units (as idx) for each idx that has them."""
    return units.join(told.withColumnRenamed("idx", "unit"), "unit").select(*told.columns)


def _best(matches: DataFrame, known: Known, classes: bool) -> DataFrame:
    areas = _at_hand(scoring.lookup(known.gazetteer, False, classes=classes), known, len(scoring.STRATEGIES))
    return scoring.best(scoring.chains(matching.gathered(matches), areas, best_of_each=True))


def scores(addresses: DataFrame, known: Known, strategies: list[scoring.Strategy] = scoring.STRATEGIES) -> DataFrame:
    """Every score of the strategies for addresses (idx, addr): classes are matched and scored, once for each different unit of
    addresses; units' idx and classes' areas come last. Only areas of the kinds that the strategies need are matched."""
    units, kinds = matching.units(addresses), sorted({k for s in strategies for k in s.areas})
    spelled = known.spellings._replace(table=known.spellings.table.where(F.col("kind").isin(kinds)))
    return _every(matching.match_units(units, spelled), known, strategies, units)


def all_scores(matches: DataFrame, known: Known) -> DataFrame:
    """Every score of every strategy for matches as match_areas() gives them."""
    return _every(matches, known, scoring.STRATEGIES)


def best_scores(matches: DataFrame, known: Known) -> DataFrame:
    return _best(matches, known, False)


def resolve(addresses: DataFrame, gazetteer: DataFrame | Known) -> DataFrame:
    """The best answer for each idx of addresses (idx, addr), with the number of the strategy that gave it.

    gazetteer: prepared (prepare()) where several tables are resolved by one.

    An address without any match has no row (see unresolved()); rows that share an idx are mixed, and one is kept.
    """
    known = gazetteer if isinstance(gazetteer, Known) else prepare(gazetteer)
    units = matching.units(normalize_strings(addresses.select("idx", "addr")))
    return _of_units(units, _best(matching.match_units(units, known.spellings), known, True))


def resolve_observed(addresses: DataFrame, gazetteer: DataFrame | Known) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """resolve(), and a function that, once its rows have been written, tells how many rows came, had an answer (in all and
    by strategy) or had none, without a second job. Rows are taken to have an idx of their own."""
    came, answered = Observation("addresses"), Observation("answers")
    rows = addresses.select("idx", "addr").observe(came, F.count(F.lit(1)).alias("rows"))
    by = [F.count_if(F.col("strategy") == i).alias(s.name) for i, s in enumerate(scoring.STRATEGIES)]
    result = resolve(rows, gazetteer).observe(answered, F.count(F.lit(1)).alias("matched"), *by)

    def metrics() -> dict[str, int]:
        told = came.get | answered.get
        return told | {"unresolved": told["rows"] - told["matched"]}

    return result, metrics


def resolve_matches(wards: DataFrame, districts: DataFrame, provinces: DataFrame, gazetteer: DataFrame | Known) -> DataFrame:
    """The same from stored match tables (as match_table() makes them). From sources.store, best_scores() moves nothing."""
    known = gazetteer if isinstance(gazetteer, Known) else prepare(gazetteer)
    tables = [(wards, "ward"), (districts, "district"), (provinces, "province")]
    a, b, c = (t.select("idx", "addr", F.lit(k).alias("kind"), F.col(f"{k}_code").alias("code"), F.col(k).alias("name"), "start_idx", "end_idx") for t, k in tables)
    return best_scores(a.unionByName(b).unionByName(c), known)


def unresolved(addresses: DataFrame, resolved: DataFrame) -> DataFrame:
    """The addresses that have no answer."""
    return addresses.join(resolved.select("idx"), "idx", "left_anti")
