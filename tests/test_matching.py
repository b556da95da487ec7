"""Trie, folded letters, parts of texts, the store of matches, native accent removal and observed counts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gazetta.functions import text
from gazetta.operators import containment, matching, scoring
from gazetta.plans import gazetteer as gz
from gazetta.plans import resolve
from gazetta.sources import readers, store, writers
from gazetta.streaming.resolving import resolve_stream

GAZ = "ward_code string, ward string, ward_level string, district_code string, district string, district_level string, province_code string, province string, province_level string"
ROWS = [
    ("00001", "ben nghe", "phuong", "001", "1", "quan", "79", "ho chi minh", "thanh pho"),
    ("00002", "da kao", "phuong", "001", "1", "quan", "79", "ho chi minh", "thanh pho"),
    ("00003", "ben nghe", "xa", "002", "ba dinh", "quan", "01", "ha noi", "thanh pho"),
]


@pytest.fixture(scope="module")
def gazetteer(spark):
    return spark.createDataFrame(ROWS, GAZ)


@pytest.fixture(scope="module")
def addresses(spark):
    rng = random.Random(2)
    words = ["ben nghe", "p.da kao", "q1", "quan 1", "hcm", "ho chi minh", "ba dinh", "ha noi", "so 5", "ben", "tp ", ",", ";", "xa"]
    made = [rng.choice([" ", ", "]).join(rng.choice(words) for _ in range(rng.randint(0, 7))) for _ in range(80)]
    rows = [(i, re.sub(" +", " ", a).strip()) for i, a in enumerate(made)] + [(90, None), (91, "")]
    return spark.createDataFrame(rows, "idx long, addr string")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def nodes(df, name):
    return len(re.findall(name, df._jdf.queryExecution().executedPlan().toString()))


def test_the_trie_finds_the_same(spark, gazetteer, addresses):
    known = matching.spellings(gz.dictionary(gazetteer))
    want = rows_of(matching.match_areas(addresses, known))
    assert rows_of(matching.match_areas(addresses, known, by_trie=True)) == want and len(want) > 100
    steps = matching.trie(known)
    told = {r.prefix: (r.ends, r.goes_on) for r in steps.collect()}
    assert told["ben"] == (False, True) and told["ben nghe"] == (True, False) and told["phuong ben nghe"] == (True, False)
    none = matching.spellings(gz.dictionary(gazetteer).limit(0))
    assert matching.match_areas(addresses, none, by_trie=True).count() == 0


def test_a_large_dictionary_goes_by_the_trie(spark, gazetteer, addresses, monkeypatch):
    want = rows_of(resolve.resolve(addresses, gazetteer))
    monkeypatch.setattr(matching, "LOCAL_ROWS", 3)
    known = resolve.prepare(gazetteer)
    assert not known.spellings.local
    assert rows_of(resolve.resolve(addresses, known)) == want


@pytest.mark.parametrize("by_trie", [False, True])
def test_letters_are_folded_in_place(spark, by_trie):
    d = spark.createDataFrame([("ward", "1", "n", "l", w) for w in ["skb", "STRAẞE", "Σας", "k s"]], "kind string, code string, name string, level string, variant string")
    texts = ["İ SKB", "x ſKb", "İstraße", "ß straße İ STRASSE", "ΣΑΣ σας", "K ſ, K S", "skbx", "sKbK"]
    a = spark.createDataFrame(list(enumerate(texts)), "idx long, addr string")
    found = matching.match_areas(a, matching.spellings(d, case_sensitive=False), by_trie=by_trie)
    # Boundaries are those of ASCII word characters in the address itself, so only ASCII letters end a word.
    got = {(r.idx, r.addr[r.start_idx : r.end_idx + 1]) for r in found.collect()}
    assert got == {(0, "SKB"), (2, "straße"), (3, "straße"), (5, "K S"), (7, "sKb")} | {(1, "ſKb")} - {(1, "ſKb")}


def test_parts_of_texts(spark):
    rng = random.Random(9)
    intervals = [(b, f"p{k}", s, s + rng.choice([0, 3, 40, 900]) - rng.randint(0, 1)) for b in (1, 2) for k, s in enumerate(rng.sample(range(2000), 40))]
    spans = [(rng.randint(1, 3), s, s + rng.randint(0, 30), "extra") for s in rng.choices(range(2000), k=300)]
    want = []
    for b, s, e, x in spans:
        inside = [(k, lo) for c, k, lo, hi in intervals if c == b and lo <= s and e <= hi]
        want += [(b, s - lo, e - lo, x, k) for k, lo in inside] or [(b, s, e, x, None)]
    left, right = spark.createDataFrame(spans, "batch int, start_idx long, end_idx long, x string"), spark.createDataFrame(intervals, "batch int, part string, from_idx long, to_idx long")
    for width in (7, 256):
        met = containment.contained(left, right, ["batch"], width)
        assert rows_of(met) == sorted(want, key=repr)
        assert nodes(met, "NestedLoop|Cartesian") == 0


def test_combined_addresses_match_as_by_themselves(spark, gazetteer, addresses):
    known = matching.spellings(gz.dictionary(gazetteer))
    texts, parts = containment.combined(addresses, F.floor(F.col("idx") / 7))
    spans = matching.match_areas(texts, known).select(F.col("idx").alias("batch"), "kind", "code", "name", "start_idx", "end_idx")
    got = containment.contained(spans, parts, ["batch"]).select("idx", "kind", "code", "name", "start_idx", "end_idx")
    assert rows_of(got) == rows_of(matching.match_areas(addresses, known).select(got.columns))


def test_one_matching_and_no_window_in_the_plan(spark, gazetteer, addresses):
    best = resolve.resolve(addresses, gazetteer)
    best.collect()
    plan = best._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"Generate explode\(transform", plan)) == 1 and "Window" not in plan
    assert len(re.findall("REPARTITION_BY_NUM", plan)) == 1


def test_many_matches_cost_what_they_give(spark, gazetteer):
    """Chains found by binary search are those of all pairs; an address of thousands of matches of other areas is no work."""
    text_ = "ben nghe, " + "ba dinh " * 40 + "q1 " + "ha noi " * 30 + "hcm"
    a = spark.createDataFrame([(1, text_), (2, "ba dinh, " * 4000)], "idx long, addr string")
    known = resolve.prepare(gazetteer)
    matches = matching.match_areas(a, known.spellings).cache()
    got = {}
    for r in resolve.all_scores(matches, known).where("idx = 1").collect():
        got.setdefault(scoring.STRATEGIES[r.strategy].name, []).append(r.score)
    spans = {}
    for r in matches.where("idx = 1").collect():
        spans.setdefault(r.code, []).append((r.start_idx, r.end_idx))
    size = lambda m: m[1] - m[0] + 1
    pairs = lambda xs, ys: [(x, y) for x in xs for y in ys if x[1] < y[0]]
    want = []
    for ward, district, province in (("00001", "001", "79"), ("00003", "002", "01")):
        for w, d in pairs(spans[ward], spans[district]):
            want += [3.0 * (size(w) + size(d) + size(p) - (d[0] - w[1]) * 0.5 - (p[0] - d[1]) * 0.5) for _, p in pairs([d], spans[province])]
    assert sorted(got["wdp"]) == pytest.approx(sorted(want)) and len(want) > 1200
    assert len(got["wd"]) == 41 and len(got["wp"]) == 31
    assert matches.where("idx = 2").count() == 4000
    assert resolve.best_scores(matches.where("idx = 2"), known).count() == 1
    matches.unpersist()


def test_store_of_matches_is_scored_in_place(spark, gazetteer, addresses, tmp_path):
    known = resolve.prepare(gazetteer)
    matches = matching.match_areas(addresses, known.spellings)
    path = f"file://{tmp_path}/matches"
    store.save_matches(matches, "stored_matches", path, buckets=4)
    again = store.open_matches(spark, "stored_matches", path, buckets=4)
    assert rows_of(again) == rows_of(matches.select(store.COLUMNS))
    spark.sql("DROP TABLE stored_matches")
    again = store.open_matches(spark, "stored_matches", path, buckets=4)
    gathered = matching.gathered(again)
    assert nodes(gathered, "Exchange") == 0
    best = scoring.best(scoring.all_scores(gathered, F.broadcast(scoring.lookup(known.gazetteer, False)), best_of_each=True))
    assert nodes(best, "Exchange hashpartitioning\\(idx") == 0
    assert rows_of(best) == rows_of(resolve.resolve(addresses, known))
    spark.sql("DROP TABLE stored_matches")


def test_match_tables_round_trip(spark, gazetteer, addresses, tmp_path):
    matches = matching.match_areas(addresses, gz.dictionary(gazetteer))
    for kind in gz.KINDS:
        table = matching.match_table(matches, kind)
        writers.write_matches(table, str(tmp_path / kind))
        assert rows_of(readers.read_matches(spark, f"{tmp_path}/{kind}.parquet", kind).select(table.columns)) == rows_of(table)
        lines = spark.read.option("header", True).csv(f"{tmp_path}/{kind}.csv")
        assert lines.columns == ["index", "addr", kind, f"{kind} code", "start_idx", "end_idx"] and lines.count() == table.count()
    tables = [readers.read_matches(spark, f"{tmp_path}/{k}.parquet", k) for k in gz.KINDS]
    assert rows_of(resolve.resolve_matches(*tables, gazetteer)) == rows_of(resolve.resolve(addresses, gazetteer))


def test_government_list(spark):
    names = "`Mã` string, `Tên` string, `Tên Tiếng Anh` string, `Cấp` string, `Mã QH` string, `Quận Huyện` string, `Mã TP` string, `Tỉnh / Thành Phố` string"
    rows = [("00001", "Phường  Phúc Xá ", None, "Phường", "001", "Quận Ba Đình", "01", "Thành phố Hà Nội"), ("9", "Xã Xã Tắc", "x", "Xã", "2", "Thị xã  A", "3", "Tỉnh B")]
    got = gz.from_government_list(spark.createDataFrame(rows, names))
    assert got.columns == gz.COLUMNS
    assert [tuple(r) for r in got.collect()] == [("00001", "phúc xá", "phường", "001", "ba đình", "quận", "01", "hà nội", "thành phố"), ("9", "xã tắc", "xã", "2", "a", "thị xã", "3", "b", "tỉnh")]


def test_prefixes_with_and_without_case(spark):
    df = spark.createDataFrame([("XÃ A",), ("xã A",)], "s string")
    strip = lambda **k: [r.s for r in df.select(text.strip_prefix(F.col("s"), text.WARD_LEVELS, **k).alias("s")).collect()]
    assert strip() == ["A", "A"] and strip(ignore_case=False) == ["XÃ A", "A"]


def test_accents_of_every_character(spark):
    import pandas as pd

    chars = [chr(c) for c in [*range(1, 0xD800), *range(0xE000, 0x110000)]]
    df = spark.createDataFrame(pd.DataFrame({"i": range(len(chars)), "c": chars}))
    out = df.select("i", text.remove_accents("c").alias("plain"))
    assert nodes(out, "Python|Arrow") == 0
    got = out.toPandas().set_index("i")["plain"]
    assert [(c, got[i]) for i, c in enumerate(chars) if got[i] != text._unaccented(c)] == []
    joined = "".join(chars[::53])
    rows = spark.createDataFrame([(joined,), ("한국 ½ ﬁ Đắk Lắk",), (None,), ("",)], "c string").select(text.remove_accents("c").alias("c")).collect()
    assert [r.c for r in rows] == [text._unaccented(joined), text._unaccented("한국 ½ ﬁ Đắk Lắk"), None, ""]


def test_only_characters_that_change_are_decomposed(monkeypatch):
    """The table of accents is made before every first query: most characters stay as they are and are left out."""
    of, came = text._unaccented, []
    monkeypatch.setattr(text, "_unaccented", lambda s: came.append(s) or of(s))
    made = text._table.__wrapped__()
    assert len(came) < 10_000 and {"đ", "Đ", "é", "\u0301", "ﬁ"} <= set(came)
    assert made == text._table() and made.to[made.single.index("đ")] == "d"


def test_names_are_checked(spark, gazetteer):
    wrong = gazetteer.limit(1).withColumn("ward", F.lit("ben  nghe"))
    with pytest.raises(Exception, match="empty word"):
        gz.dictionary(wrong).collect()
    long = gazetteer.limit(1).withColumn("ward", F.lit("a b c d e f"))
    assert resolve.prepare(long).names == {"areas": 3, "long_names": 1}


def test_counts_are_observed(spark, gazetteer, addresses, tmp_path):
    result, metrics = resolve.resolve_observed(addresses, gazetteer)
    result.write.parquet(str(tmp_path / "out"))
    told, n = metrics(), spark.read.parquet(str(tmp_path / "out")).count()
    assert (told["rows"], told["matched"], told["unresolved"]) == (82, n, 82 - n)
    by = {scoring.STRATEGIES[r.strategy].name: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("strategy").count().collect()}
    assert {k: v for k, v in told.items() if k in by} == by and sum(by.values()) == n
    addresses.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("idx long, addr string").parquet(str(tmp_path / "in"))
    reports = []
    resolve_stream(stream, gazetteer, str(tmp_path / "streamed"), str(tmp_path / "state"), lambda number, m: reports.append(m)).awaitTermination()
    assert [(sum(m["rows"] for m in reports), sum(m["matched"] for m in reports))] == [(82, n)]


def test_equal_addresses_are_matched_once(spark, gazetteer, monkeypatch):
    """However many idx have the same addresses; those of one idx are scored together."""
    known, kept, came = resolve.prepare(gazetteer), matching._kept, []
    monkeypatch.setattr(matching, "_kept", lambda rows, *more: came.append(rows.count()) or kept(rows, *more))
    texts = ["p.ben nghe, q1, hcm", "ben nghe", "quan 1", "hcm"]
    rows = [(i, texts[i % 2]) for i in range(100)] + [(7, texts[0]), (200, texts[2]), (200, texts[3]), (201, None), (None, texts[2])]
    a = spark.createDataFrame(rows, "idx long, addr string")
    got = rows_of(matching.match_areas(a, known.spellings))
    assert came == [5]  # four texts and null
    assert got == rows_of(matching.spread(matching.match_classes(a, known.spellings), known.spellings))
    came.clear()
    # Units: three texts by themselves, the two of idx 7 and of idx 200, and none.
    assert rows_of(resolve.scores(a, known)) == rows_of(resolve.all_scores(matching.match_areas(a, known.spellings), known))
    assert came[0] == 3 + 2 + 2


def test_few_bytes_make_many_tasks(spark, gazetteer):
    """Texts of parts are matched by as many tasks as are asked for, however few bytes they are."""
    a = spark.createDataFrame([(i, "p.ben nghe, q1, hcm") for i in range(400)], "idx long, addr string")
    known = resolve.prepare(gazetteer).spellings
    texts, _ = containment.combined(a, F.floor(F.col("idx") / 50))
    assert matching.match_classes(texts, known).rdd.getNumPartitions() == 4
    assert matching.match_areas(a, known).rdd.getNumPartitions() == 4


def test_areas_that_are_spelled_alike_come_last(spark, monkeypatch):
    """Wards of one name and level are one class: the dictionary and the matches don't grow with them, results do."""
    monkeypatch.setattr(matching, "LOCAL_ROWS", 350)
    rows = [(f"{i:05}", "ben nghe", ["phuong", "xa"][i % 2], "001", "1", "quan", "79", "ho chi minh", "thanh pho") for i in range(300)]
    known = resolve.prepare(spark.createDataFrame(rows, GAZ))
    a = spark.createDataFrame([(1, "p.ben nghe, q1, hcm"), (2, "ben nghe")], "idx long, addr string")
    assert known.spellings.local
    of = lambda m, i: [r for r in m.where("kind = 'ward'").collect() if r.idx == i]
    classes, areas = matching.match_classes(a, known.spellings), matching.match_areas(a, known.spellings)
    assert len(of(classes, 1)) == 2 and len(of(areas, 1)) == 300
    assert {(r.code, r.start_idx) for r in of(areas, 1)} == {(f"{i:05}", 2 * (i % 2)) for i in range(300)}
    assert rows_of(resolve.scores(a, known)) == rows_of(resolve.all_scores(areas, known))
    assert [(r.idx, r.ward_code) for r in resolve.resolve(a, known).orderBy("idx").collect()] == [(1, "00000"), (2, "00000")]


def test_scores_are_spread_by_blocks(spark, monkeypatch):
    """However many wards a score is of, few rows are made of one row of a join; all of them are told, and once."""
    monkeypatch.setattr(scoring, "BLOCK", 7)
    rows = [(f"{i:05}", ["ben nghe", "da kao"][i % 2], "phuong", f"{i % 3:03}", ["1", "ba dinh", "2"][i % 3], "quan", "79", "ho chi minh", "thanh pho") for i in range(100)]
    known = resolve.prepare(spark.createDataFrame([*rows, *rows[:5]], GAZ))
    for classes in (False, True):
        of = {}
        for r in scoring.members(known.gazetteer, [scoring.STRATEGIES[4]], classes).collect():
            of.setdefault(bytes(r.of), []).append([m.ward_code for m in r.block])
        (blocks,) = of.values()
        assert sorted(map(len, blocks)) == [2] + [7] * 14 and sorted(sum(blocks, [])) == [r[0] for r in rows]
    a = spark.createDataFrame([(1, "p.ben nghe, q1, hcm"), (2, "hcm, hcm"), (3, "ba dinh")], "idx long, addr string")
    got = resolve.scores(a, known)
    assert rows_of(got) == rows_of(resolve.all_scores(matching.match_areas(a, known.spellings), known))
    by = {(r.idx, r.strategy): (r["count"], r.codes) for r in got.groupBy("idx", "strategy").agg(F.count("*").alias("count"), F.count_distinct("ward_code").alias("codes")).collect()}
    assert by[1, 4] == (100, 100) and by[2, 4] == (200, 100) and by[3, 5] == (33, 33) and by[1, 6] == (50, 50)


def test_only_what_is_scored_is_matched(spark, gazetteer, addresses, monkeypatch):
    known, match, found = resolve.prepare(gazetteer), matching.match_units, []
    monkeypatch.setattr(matching, "match_units", lambda *a: found.append(match(*a)) or found[-1])
    every = resolve.scores(addresses, known)
    for i, s in enumerate(scoring.STRATEGIES):
        assert rows_of(resolve.scores(addresses, known, [s])) == rows_of(every.where(F.col("strategy") == i))
        assert {r.kind for r in found[-1].select("kind").distinct().collect()} == set(s.areas)
