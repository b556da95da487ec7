"""The official areas: one row for each ward, with its district and province; and the dictionary of their spellings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gazetta.functions.text import DISTRICT_LEVELS, PROVINCE_LEVELS, WARD_LEVELS, level_of, remove_accents, strip_prefix
from gazetta.functions.variants import area_variants, checked, long_name

KINDS = ["ward", "district", "province"]
COLUMNS = [f"{k}{x}" for k in KINDS for x in ("_code", "", "_level")]


def build_gazetteer(wards: DataFrame, districts: DataFrame, provinces: DataFrame) -> DataFrame:
    """Join the three lists; levels come from the full names, which then lose their unit word."""
    joined = wards.join(districts, "district_code").join(provinces, "province_code")
    levels = dict(zip(KINDS, (WARD_LEVELS, DISTRICT_LEVELS, PROVINCE_LEVELS), strict=True))
    out = []
    for kind, words in levels.items():
        name = F.col(f"{kind}_name")
        bare = F.lower(strip_prefix(name, words))
        out += [F.col(f"{kind}_code"), (F.regexp_replace(bare, r"(?U)^\s+", "") if kind == "district" else bare).alias(kind), level_of(name, words).alias(f"{kind}_level")]
    return joined.select(*out)


def from_government_list(rows: DataFrame) -> DataFrame:
    """The flat list of wards by the government's headings, normalised, to the same columns."""
    from gazetta.functions.text import first_match, normalize_strings

    # The list's headings.
    names = {"Mã": "ward_code", "Tên": "ward", "Cấp": "ward_level", "Mã QH": "district_code", "Quận Huyện": "district", "Mã TP": "province_code", "Tỉnh / Thành Phố": "province"}
    flat = normalize_strings(rows.drop("Tên Tiếng Anh").withColumnsRenamed(names))
    return flat.select(
        "ward_code", strip_prefix(F.col("ward"), WARD_LEVELS, ignore_case=False).alias("ward"), "ward_level",
        "district_code", F.ltrim(strip_prefix(F.col("district"), DISTRICT_LEVELS, ignore_case=False)).alias("district"), first_match(F.col("district"), "^(?:" + "|".join(DISTRICT_LEVELS) + ")").alias("district_level"),
        "province_code", strip_prefix(F.col("province"), PROVINCE_LEVELS, ignore_case=False).alias("province"), first_match(F.col("province"), "^(?:" + "|".join(PROVINCE_LEVELS) + ")").alias("province_level"),
    )


def distinct_areas(gazetteer: DataFrame, kind: str) -> DataFrame:
    """code, name, level of the areas of a kind."""
    return gazetteer.select(F.col(f"{kind}_code").alias("code"), F.col(kind).alias("name"), F.col(f"{kind}_level").alias("level")).distinct()


def areas(gazetteer: DataFrame) -> DataFrame:
    """kind, code, name, level of all areas, from one pass over the gazetteer."""
    one = lambda k: F.struct(F.lit(k).alias("kind"), F.col(f"{k}_code").alias("code"), F.col(k).alias("name"), F.col(f"{k}_level").alias("level"))
    return gazetteer.select(F.inline(F.array(*map(one, KINDS)))).distinct()


def _spelled(areas: DataFrame) -> DataFrame:
    """kind, code, name, level, variants: spellings are unaccented; only wards go without abbreviations."""
    known = areas.where("name IS NOT NULL").withColumn("name", checked(F.col("name")))
    # What a generator gives is computed once, however often the spellings below name it, and stays out of their lambdas.
    plain = known.select("*", F.inline(F.array(F.struct(remove_accents("name").alias("_name"), remove_accents("level").alias("_level")))))
    return plain.withColumn("variants", area_variants(F.col("_name"), F.col("_level"), shorten=F.col("kind") != "ward")).drop("_name", "_level")


def variants(gazetteer: DataFrame, kind: str) -> DataFrame:
    """code, name, level, variants of the areas of a kind."""
    return _spelled(areas(gazetteer).where(F.col("kind") == kind)).drop("kind")


def dictionary(gazetteer: DataFrame, observation: Observation | None = None) -> DataFrame:
    """kind, code, name, level, variant: a row for each spelling of each area. A name with an empty word is an error.

    observation: gets areas and long_names (the number of names with more words than there are rules for) as it is made.
    """
    every = areas(gazetteer)
    if observation is not None:
        every = every.observe(observation, F.count(F.lit(1)).alias("areas"), F.count_if(long_name(F.col("name"))).alias("long_names"))
    return _spelled(every).select("kind", "code", "name", "level", F.explode("variants").alias("variant"))


def alike(gazetteer: DataFrame, observation: Observation | None = None) -> DataFrame:
    """kind, code, name, class, levels of all areas. Areas of one kind, name and class are spelled alike, so they match
    alike: the class tells the levels under which an area stands, of which all its spellings follow but for the name."""
    every = areas(gazetteer)
    if observation is not None:
        every = every.observe(observation, F.count(F.lit(1)).alias("areas"), F.count_if(long_name(F.col("name"))).alias("long_names"))
    by_area = every.groupBy("kind", "code", "name").agg(F.sort_array(F.collect_set(F.struct("level"))).alias("levels"))
    return by_area.withColumn("class", F.to_json("levels"))


def dictionary_of_classes(alike: DataFrame) -> DataFrame:
    """dictionary() with a class instead of each code: its rows follow the different names, not the areas."""
    classes = alike.select("kind", F.col("class").alias("code"), "name", "levels").distinct()
    return _spelled(classes.select("kind", "code", "name", F.inline("levels"))).select("kind", "code", "name", "level", F.explode("variants").alias("variant"))


def classed(gazetteer: DataFrame, alike: DataFrame) -> DataFrame:
    """The codes and names of the gazetteer's rows, with the class of each code (null where there is no code or name)."""
    rows = gazetteer.select(*(c for k in KINDS for c in (f"{k}_code", k))).distinct()
    for k in KINDS:
        own = alike.where(F.col("kind") == k).select(F.col("code").alias(f"{k}_code"), F.col("name").alias(k), F.col("class").alias(f"{k}_class"))
        rows = rows.join(own, [f"{k}_code", k], "left")
    return rows


def variant_counts(gazetteer: DataFrame) -> DataFrame:
    return dictionary(gazetteer).groupBy("kind").agg(F.count(F.lit(1)).alias("n_variants"))
