"""The address resolver against golden values, a regular expression and the SQL of the queries."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gazetta.functions import text
from gazetta.functions.variants import area_variants, name_variants, well_formed
from gazetta.operators import matching, scoring
from gazetta.plans import gazetteer as gz
from gazetta.plans import resolve

GAZ = "ward_code string, ward string, ward_level string, district_code string, district string, district_level string, province_code string, province string, province_level string"


@pytest.fixture(scope="module")
def gazetteer(spark):
    return spark.createDataFrame([("00001", "ben nghe", "phuong", "001", "1", "quan", "79", "ho chi minh", "thanh pho")], GAZ)


@pytest.mark.parametrize(
    ("name", "level", "shorten", "names", "total"),
    [
        ("2", "phuong", False, 1, 5),
        ("ben nghe", "phuong", False, 2, 10),
        ("ba dinh", "quan", True, 7, 35),
        ("ha noi", "thanh pho", True, 7, 28),
        ("ho chi minh", "thanh pho", True, 2, 8),
        ("bac tu liem", "quan", True, 4, 20),
        ("thanh hoa", "tinh", True, 9, 36),
        ("a b c d", "unknown", True, 1, 1),
        ("a b c d e f", None, True, 1, 1),
    ],
)
def test_variant_counts(spark, name, level, shorten, names, total):
    df = spark.createDataFrame([(name, level)], "n string, l string")
    row = df.select(F.size(name_variants(F.col("n"), shorten)).alias("names"), F.size(area_variants(F.col("n"), F.col("l"), shorten)).alias("total")).first()
    assert (row.names, row.total) == (names, total)


def test_scores_of_the_golden_address(spark, gazetteer):
    addresses = spark.createDataFrame([(1, "ben nghe, q1, hcm"), (2, "hcm, q1, ben nghe")], "idx long, addr string")
    matches = matching.match_areas(addresses, gz.dictionary(gazetteer))
    got = {(r.idx, r.strategy): r.score for r in resolve.all_scores(matches, resolve.prepare(gazetteer)).collect()}
    names = [s.name for s in scoring.STRATEGIES]
    want = {"wdp": 30.0, "wd": 12.75, "wp": 16.5, "dp": 7.0, "p": 1.5, "d": 0.4, "w": 0.16}
    assert {names[k[1]]: v for k, v in got.items() if k[0] == 1} == pytest.approx(want)
    assert {names[k[1]]: v for k, v in got.items() if k[0] == 2} == pytest.approx({"p": 1.5, "d": 0.4, "w": 0.16})


def test_resolve_and_unresolved(spark, gazetteer):
    addresses = spark.createDataFrame([(1, "  Ben Nghe,  Q1, HCM"), (2, "nowhere"), (3, None), (4, "")], "idx long, addr string")
    best = resolve.resolve(addresses, gazetteer)
    assert [(r.idx, r.ward_code, r.score, r.strategy) for r in best.collect()] == [(1, "00001", 30.0, 0)]
    assert sorted(r.idx for r in resolve.unresolved(addresses, best).collect()) == [2, 3, 4]


def test_stored_match_tables_give_the_same(spark, gazetteer):
    addresses = spark.createDataFrame([(1, "ben nghe, q1, hcm")], "idx long, addr string")
    matches = matching.match_areas(addresses, gz.dictionary(gazetteer))
    got = resolve.resolve_matches(*(matching.match_table(matches, k) for k in gz.KINDS), gazetteer).collect()
    assert got == resolve.resolve(addresses, gazetteer).collect()


def test_overlapping_spellings_of_one_area_are_told_once(spark):
    g = spark.createDataFrame([("1", "ba dinh", "quan")], "code string, name string, level string")
    d = g.select(F.lit("district").alias("kind"), "code", "name", "level", F.explode(area_variants(F.col("name"), F.col("level"))).alias("variant"))
    a = spark.createDataFrame([(1, "so 5 quan ba dinh; ba dinh 😀 ba dinh")], "idx long, addr string")
    assert sorted((r.start_idx, r.end_idx) for r in matching.match_areas(a, d).collect()) == [(5, 16), (19, 25), (29, 35)]


WORDS = ["a", "a b", "b-a", "k.a", "q1", "1", "hà", "ab"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="abk1q.-; hàh😀", max_size=24), min_size=40, max_size=40))
def test_span_join_is_a_leftmost_longest_alternation(spark, texts):
    d = spark.createDataFrame([("ward", "1", "n", "l", w) for w in WORDS], "kind string, code string, name string, level string, variant string")
    a = spark.createDataFrame(list(enumerate(texts)), "idx long, addr string")
    got: dict[int, list] = {}
    for r in matching.match_areas(a, d).collect():
        got.setdefault(r.idx, []).append((r.start_idx, r.end_idx))
    pattern = re.compile(r"\b(?:" + "|".join(re.escape(w) for w in sorted(WORDS, key=len, reverse=True)) + r")\b", re.ASCII)
    assert {i: sorted(v) for i, v in got.items()} == {i: s for i, t in enumerate(texts) if (s := [(m.start(), m.end() - 1) for m in pattern.finditer(t)])}


def test_text_functions(spark):
    df = spark.createDataFrame([("   TỈNH  Hà\tNội \t", 1), (None, 2)], "s string, n int")
    assert [r.s for r in text.normalize_strings(df).collect()] == ["tỉnh hà\tnội", None]
    row = spark.createDataFrame([("TỈNH Hà Nội", "Đắk Lắk", "xã Phường")], "a string, b string, c string").select(
        text.strip_prefix(F.col("a"), text.PROVINCE_LEVELS).alias("a"), text.remove_accents("b").alias("b"), text.level_of(F.col("c"), text.WARD_LEVELS).alias("c"), text.first_match(F.col("b"), "x").alias("d"), well_formed(F.lit("a  b")).alias("e")
    )
    assert row.first()[:] == ("Hà Nội", "Dak Lak", "phường", None, False)


def test_gazetteer_from_lists(spark):
    w = spark.createDataFrame([("1", "Phường Bến Nghé", "9")], "ward_code string, ward_name string, district_code string")
    d = spark.createDataFrame([("9", "Quận 1", "79")], "district_code string, district_name string, province_code string")
    p = spark.createDataFrame([("79", "Thành phố Hồ Chí Minh")], "province_code string, province_name string")
    assert gz.build_gazetteer(w, d, p).first()[:] == ("1", "bến nghé", "phường", "9", "1", "quận", "79", "hồ chí minh", "thành phố")


def test_empty_inputs(spark, gazetteer):
    none = spark.createDataFrame([], "idx long, addr string")
    assert resolve.resolve(none, gazetteer).count() == 0
    assert resolve.resolve(spark.createDataFrame([(1, "a")], "idx long, addr string"), gazetteer.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["normalize_addr", "gazetteer_join", "variants_district", "match_ward", "score_wdp", "infer_best", "unresolved"])
def test_queries_agree_with_their_sql(spark, name):
    import duckdb

    from gazetta import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("supplier", "part", "nation", "region", "customer", "documents"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, sf)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = [want.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
