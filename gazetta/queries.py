"""The resolver's queries, on a gazetteer and addresses made from the TPC-H-like tables, and the same in SQL for DuckDB.

The SQL is written from the rules, not from the Spark plans: it shares no code with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions import text
from gazetta.operators import containment, matching, scoring
from gazetta.plans import gazetteer as gz
from gazetta.plans import resolve

GAZETTEER = """
SELECT lpad(CAST(s.s_suppkey AS STRING), 5, '0') AS ward_code, lower(p.p_name) AS ward,
 CASE s.s_suppkey % 3 WHEN 0 THEN 'phuong' WHEN 1 THEN 'xa' ELSE 'thi tran' END AS ward_level,
 lpad(CAST(n.n_nationkey AS STRING), 3, '0') AS district_code, replace(lower(n.n_name), '_', ' ') AS district,
 CASE n.n_nationkey % 4 WHEN 0 THEN 'quan' WHEN 1 THEN 'huyen' WHEN 2 THEN 'thi xa' ELSE 'thanh pho' END AS district_level,
 lpad(CAST(r.r_regionkey AS STRING), 2, '0') AS province_code, lower(r.r_name) AS province,
 CASE r.r_regionkey % 2 WHEN 0 THEN 'tinh' ELSE 'thanh pho' END AS province_level
FROM supplier s JOIN part p ON p.p_partkey = s.s_suppkey
 JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey"""

ADDRESSES = """
SELECT CAST(c.c_custkey AS BIGINT) AS idx, CASE c.c_custkey % 8
 WHEN 0 THEN concat('12 ', g.ward_level, ' ', g.ward, ', ', g.district_level, ' ', g.district, ', ', g.province_level, ' ', g.province)
 WHEN 1 THEN concat(g.ward, ' ', g.district, ' ', g.province)
 WHEN 2 THEN concat('so 3 ', g.ward, ', ', g.district)
 WHEN 3 THEN concat('  So 4  ', upper(g.ward), ',  ', g.province)
 WHEN 4 THEN concat(g.district, ', ', g.province)
 WHEN 5 THEN concat('to 1; ', g.province)
 WHEN 6 THEN concat(g.province, ', ', g.district, ', ', g.ward)
 ELSE concat('khong ro ', CAST(c.c_custkey AS STRING)) END AS addr
FROM (SELECT c_custkey, CAST(c_custkey % k.n AS BIGINT) AS w FROM customer CROSS JOIN (SELECT count(*) AS n FROM supplier) k) c
 JOIN gaz g ON CAST(g.ward_code AS BIGINT) = c.w"""

#: The same in mixed case, with letters that lower-casing makes longer, and with one (U+212A) that folds to ASCII.
MIXED = """
SELECT idx, CASE idx % 4 WHEN 0 THEN upper(addr) WHEN 1 THEN concat('İß ', addr) WHEN 2 THEN replace(addr, 'k', 'K') ELSE addr END AS addr FROM addresses"""
#: Addresses in a text of their own for the queries on parts: so many of them, and those of every tenth idx aren't parts.
IN_A_TEXT, NO_PART = 50, 10

#: Full names, with their unit words in mixed case, for the queries on unit words.
FULL_NAMES = """
SELECT lpad(CAST(s_suppkey AS STRING), 5, '0') AS ward_code,
 concat(CASE s_suppkey % 4 WHEN 0 THEN 'Phường ' WHEN 1 THEN 'XÃ ' WHEN 2 THEN 'Thị Trấn ' ELSE '' END, s_name) AS ward_name,
 lpad(CAST(s_nationkey AS STRING), 3, '0') AS district_code FROM supplier"""
FULL_DISTRICTS = """
SELECT lpad(CAST(n_nationkey AS STRING), 3, '0') AS district_code,
 concat(CASE n_nationkey % 5 WHEN 0 THEN 'QUẬN ' WHEN 1 THEN 'Huyện ' WHEN 2 THEN 'Thị xã ' WHEN 3 THEN 'thành phố ' ELSE '' END, n_name) AS district_name,
 lpad(CAST(n_regionkey AS STRING), 2, '0') AS province_code FROM nation"""
FULL_PROVINCES = """
SELECT lpad(CAST(r_regionkey AS STRING), 2, '0') AS province_code,
 concat(CASE r_regionkey % 3 WHEN 0 THEN 'TỈNH ' WHEN 1 THEN 'Thành phố ' ELSE '' END, r_name) AS province_name FROM region"""


def _sql(spark: SparkSession, sf_dir: str, query: str, **frames: DataFrame) -> DataFrame:
    names = [t for t in ("supplier", "part", "nation", "region", "customer") if f" {t}" in query]
    return spark.sql(_named(query, names, frames), **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names}, **frames)


def _named(query: str, names: list[str], frames: dict) -> str:
    for t in names:
        for word in ("FROM", "JOIN"):
            query = query.replace(f"{word} {t}", f"{word} {{{t}}}")
    for t in frames:
        query = query.replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
    return query


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, GAZETTEER)


def raw_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, ADDRESSES, gaz=gazetteer(spark, sf_dir))


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.normalize_strings(raw_addresses(spark, sf_dir))


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_areas(addresses(spark, sf_dir), resolve.prepare(gazetteer(spark, sf_dir)).spellings)


def _match(kind: str):
    return lambda spark, sf_dir: matching.match_table(_matches(spark, sf_dir), kind)


def _variants(kind: str):
    return lambda spark, sf_dir: gz.variants(gazetteer(spark, sf_dir), kind).select("code", "name", "level", F.explode("variants").alias("variant"))


def _score(s: scoring.Strategy):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return resolve.scores(addresses(spark, sf_dir), resolve.prepare(gazetteer(spark, sf_dir)), [s]).drop("strategy")

    return query


def _full(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(_sql(spark, sf_dir, q) for q in (FULL_NAMES, FULL_DISTRICTS, FULL_PROVINCES))


def _strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _full(spark, sf_dir)[0]
    return w.select("ward_code", F.lower(text.strip_prefix(F.col("ward_name"), text.WARD_LEVELS)).alias("ward"))


def _level_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, d, p = _full(spark, sf_dir)
    rows = [(w, "ward", text.WARD_LEVELS), (d, "district", text.DISTRICT_LEVELS), (p, "province", text.PROVINCE_LEVELS)]
    a, b, c = (t.select(F.lit(k).alias("kind"), F.col(f"{k}_code").alias("code"), text.level_of(F.col(f"{k}_name"), words).alias("level")) for t, k, words in rows)
    return a.unionByName(b).unionByName(c)


def _first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _full(spark, sf_dir)[1]
    return d.select("district_code", F.lower(text.first_match(F.col("district_name"), "^(?:" + "|".join(text.DISTRICT_LEVELS) + ")")).alias("level"))


def _remove_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", F.sha2(text.remove_accents("text"), 256).alias("text_sha256"))


def _all_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.scores(addresses(spark, sf_dir), resolve.prepare(gazetteer(spark, sf_dir)))


_MATCH = ["idx", "addr", "kind", "code", "name", "start_idx", "end_idx"]


def _match_by_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_areas(addresses(spark, sf_dir), resolve.prepare(gazetteer(spark, sf_dir)).spellings, by_trie=True).select(*_MATCH)


def _match_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = spark.sql(MIXED.replace("FROM addresses", "FROM {addresses}"), addresses=addresses(spark, sf_dir))
    found = matching.match_areas(mixed, resolve.prepare(gazetteer(spark, sf_dir), case_sensitive=False).spellings)
    return found.select(*_MATCH, F.substring("addr", F.col("start_idx").cast("int") + 1, (F.col("end_idx") - F.col("start_idx")).cast("int") + 1).alias("matched"))


def _match_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts, parts = containment.combined(addresses(spark, sf_dir), F.floor(F.col("idx") / IN_A_TEXT))
    known = resolve.prepare(gazetteer(spark, sf_dir)).spellings
    spans = matching.match_classes(texts, known).select(F.col("idx").alias("batch"), "kind", "code", "name", "start_idx", "end_idx")
    found = containment.contained(spans, parts.where(F.col("idx") % NO_PART != 0), ["batch"])
    return matching.spread(matching.dealt(found, "batch", "idx", "start_idx"), known)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "normalize_addr": addresses,
        "strip_prefix": _strip_prefix,
        "level_case": _level_case,
        "first_match": _first_match,
        "remove_accents": _remove_accents,
        "gazetteer_join": lambda spark, sf_dir: gz.build_gazetteer(*_full(spark, sf_dir)),
        **{f"distinct_{k}s": (lambda spark, sf_dir, k=k: gz.distinct_areas(gazetteer(spark, sf_dir), k)) for k in gz.KINDS},
        **{f"variants_{k}": _variants(k) for k in gz.KINDS},
        "variant_counts": lambda spark, sf_dir: gz.variant_counts(gazetteer(spark, sf_dir)),
        **{f"match_{k}": _match(k) for k in gz.KINDS},
        "match_by_trie": _match_by_trie,
        "match_folded": _match_folded,
        "match_parts": _match_parts,
        **{f"score_{s.name}": _score(s) for s in scoring.STRATEGIES},
        "score_all": _all_scores,
        "infer_best": lambda spark, sf_dir: resolve.resolve(raw_addresses(spark, sf_dir), gazetteer(spark, sf_dir)),
        "unresolved": lambda spark, sf_dir: resolve.unresolved(addresses(spark, sf_dir), resolve.resolve(raw_addresses(spark, sf_dir), gazetteer(spark, sf_dir))),
    }


# ---- SQL for DuckDB -------------------------------------------------------------------------------------------------


_PREFIXES = """
 ('phuong', 'p.'), ('phuong', 'p '), ('phuong', 'p'), ('phuong', 'phuong '), ('xa', 'xa '), ('xa', 'x.'), ('xa', 'x '),
 ('thi tran', 'thi tran '), ('thi tran', 'tt.'), ('thi tran', 'tt '), ('quan', 'quan '), ('quan', 'q.'), ('quan', 'q '), ('quan', 'q'),
 ('huyen', 'huyen '), ('huyen', 'h.'), ('huyen', 'h '), ('thi xa', 'thi xa '), ('thi xa', 'tx.'), ('thi xa', 'tx '),
 ('thanh pho', 'tp '), ('thanh pho', 'tp.'), ('thanh pho', 'thanh pho '), ('tinh', 'tinh '), ('tinh', 't.'), ('tinh', 't ')"""
_NORMAL = "regexp_replace(trim(lower(addr), ' ' || chr(9) || chr(10) || chr(13)), ' +', ' ', 'g')"
_WITH = f"WITH RECURSIVE gaz AS ({GAZETTEER}), addresses AS (SELECT idx, {_NORMAL} AS addr FROM ({ADDRESSES}) t)"
_SPELLED = f""",
areas AS (
 SELECT DISTINCT 'ward' AS kind, ward_code AS code, ward AS name, ward_level AS level FROM gaz UNION ALL
 SELECT DISTINCT 'district', district_code, district, district_level FROM gaz UNION ALL
 SELECT DISTINCT 'province', province_code, province, province_level FROM gaz),
worded AS (SELECT *, string_split(name, ' ') AS w FROM areas),
base AS (
 SELECT kind, code, name, level, name AS v FROM worded UNION
 SELECT kind, code, name, level, w[1] || w[2] FROM worded WHERE len(w) = 2 UNION
 SELECT kind, code, name, level, left(w[1], 1) || left(w[2], 1) FROM worded WHERE len(w) = 2 AND kind <> 'ward' UNION
 SELECT kind, code, name, level, left(w[1], 1) || w[2] FROM worded WHERE len(w) = 2 AND kind <> 'ward' UNION
 SELECT kind, code, name, level, left(w[1], 1) || left(w[2], 2) FROM worded WHERE len(w) = 2 AND kind <> 'ward' UNION
 SELECT kind, code, name, level, left(w[1], 1) || '.' || w[2] FROM worded WHERE len(w) = 2 AND kind <> 'ward' UNION
 SELECT kind, code, name, level, left(w[1], 1) || '.' || left(w[2], 2) FROM worded WHERE len(w) = 2 AND kind <> 'ward' UNION
 SELECT kind, code, name, level, left(w[1], 2) || '.' || w[2] FROM worded WHERE len(w) = 2 AND kind <> 'ward' AND length(w[1]) > 2 UNION
 SELECT kind, code, name, level, left(w[1], 2) || ' ' || w[2] FROM worded WHERE len(w) = 2 AND kind <> 'ward' AND length(w[1]) > 2 UNION
 SELECT kind, code, name, level, left(w[1], 1) || left(w[2], 1) || left(w[3], 1) FROM worded WHERE len(w) = 3 AND kind <> 'ward'),
spelled AS (
 SELECT kind, code, name, level, v AS variant FROM base UNION
 SELECT b.kind, b.code, b.name, b.level, p.prefix || b.v FROM base b JOIN (VALUES {_PREFIXES}) p(level, prefix) ON p.level = b.level)"""
_MATCHED = """,
cut AS (SELECT idx, addr, i FROM addresses, LATERAL (SELECT unnest(range(0, length(addr) + 1)) AS i) r
 WHERE (i > 0 AND regexp_matches(substr(addr, i, 1), '[0-9A-Za-z_]')) <> (i < length(addr) AND regexp_matches(substr(addr, i + 1, 1), '[0-9A-Za-z_]'))),
hits AS (SELECT DISTINCT s.idx, s.addr, v.kind, v.code, v.name, v.level, s.i AS s, e.i - 1 AS e
 FROM cut s JOIN cut e ON e.idx = s.idx AND e.addr = s.addr AND e.i > s.i JOIN spelled v ON v.variant = substr(s.addr, s.i + 1, e.i - s.i)),
kept AS (
 SELECT idx, addr, kind, code, name, level, min((s, -e)) AS m FROM hits GROUP BY ALL
 UNION ALL
 SELECT h.idx, h.addr, h.kind, h.code, h.name, h.level, min((h.s, -h.e)) AS m FROM kept k JOIN hits h
 ON h.idx = k.idx AND h.addr = k.addr AND h.kind = k.kind AND h.code = k.code AND h.name = k.name AND h.level = k.level AND h.s > -k.m[2]
 GROUP BY h.idx, h.addr, h.kind, h.code, h.name, h.level, k.m),
m AS (SELECT DISTINCT idx, addr, kind, code, name, CAST(m[1] AS BIGINT) AS s, CAST(-m[2] AS BIGINT) AS e FROM kept),
w AS (SELECT * FROM m WHERE kind = 'ward'), d AS (SELECT * FROM m WHERE kind = 'district'), p AS (SELECT * FROM m WHERE kind = 'province')"""
_OUT = "g.ward_code, g.ward, g.district_code, g.district, g.province_code, g.province"
_L = {k: f"({k}.e - {k}.s + 1)" for k in "wdp"}
_ON = {"w": "g.ward_code = w.code AND g.ward = w.name", "d": "g.district_code = d.code AND g.district = d.name", "p": "g.province_code = p.code AND g.province = p.name"}


def _score_sql(name: str, factor: str, gaps: bool) -> str:
    first = name[0]
    total = " + ".join(_L[k] for k in name)
    if gaps:
        total += "".join(f" - ({b}.s - {a}.e) * CAST(0.5 AS DOUBLE)" for a, b in zip(name, name[1:], strict=False))
    joins = "".join(f" JOIN {b} ON {b}.idx = {a}.idx AND {a}.e < {b}.s" for a, b in zip(name, name[1:], strict=False))
    on = " AND ".join(_ON[k] for k in name)
    return f"SELECT {first}.idx, {first}.addr, {_OUT}, CAST({total} AS DOUBLE) * CAST({factor} AS DOUBLE) AS score FROM {first}{joins} JOIN gaz g ON {on}"


_SCORES = {"wdp": ("3.0", True), "wd": ("1.5", True), "wp": ("1.5", False), "dp": ("2.0", True), "p": ("0.5", True), "d": ("0.2", True), "w": ("0.02", True)}


def oracle_sql() -> dict[str, str]:
    every = " UNION ALL ".join(f"SELECT *, {i} AS strategy FROM ({_score_sql(n, *v)}) t{i}" for i, (n, v) in enumerate(_SCORES.items()))
    best = f"{_WITH}{_SPELLED}{_MATCHED}, every AS ({every}), best AS (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY score DESC, strategy, ward_code, district_code, province_code, addr) AS k FROM every)"
    level = lambda c, words: "CASE " + " ".join(f"WHEN contains(lower({c}), '{w}') THEN '{w}'" for w in words) + " END"
    bare = lambda c, words: f"lower(regexp_replace({c}, '(?i)^(?:{'|'.join(w + ' ' for w in words)})', ''))"
    ward, district, province = ["phường", "xã", "thị trấn"], ["thị xã", "thành phố", "huyện", "quận"], ["thành phố", "tỉnh"]
    full = f"w AS ({FULL_NAMES}), d AS ({FULL_DISTRICTS}), p AS ({FULL_PROVINCES})"
    out = {
        "normalize_addr": f"{_WITH} SELECT idx, addr FROM addresses",
        "strip_prefix": f"SELECT ward_code, {bare('ward_name', ward)} AS ward FROM ({FULL_NAMES})",
        "level_case": f"""WITH {full} SELECT 'ward' AS kind, ward_code AS code, {level("ward_name", ward)} AS level FROM w
 UNION ALL SELECT 'district', district_code, {level("district_name", district)} FROM d UNION ALL SELECT 'province', province_code, {level("province_name", province)} FROM p""",
        "first_match": f"SELECT district_code, nullif(lower(regexp_extract(district_name, '(?i)^(?:{'|'.join(district)})', 0)), '') AS level FROM ({FULL_DISTRICTS})",
        "remove_accents": "SELECT doc_id, sha256(strip_accents(replace(replace(text, 'đ', 'd'), 'Đ', 'D'))) AS text_sha256 FROM documents",
        "gazetteer_join": f"""WITH {full} SELECT ward_code, {bare("ward_name", ward)} AS ward, {level("ward_name", ward)} AS ward_level,
 d.district_code, ltrim({bare("district_name", district)}) AS district, {level("district_name", district)} AS district_level,
 p.province_code, {bare("province_name", province)} AS province, {level("province_name", province)} AS province_level
FROM w JOIN d ON w.district_code = d.district_code JOIN p ON d.province_code = p.province_code""",
        "variant_counts": f"{_WITH}{_SPELLED} SELECT kind, CAST(count(*) AS BIGINT) AS n_variants FROM spelled GROUP BY kind",
        "score_all": f"{_WITH}{_SPELLED}{_MATCHED} {every}",
        "infer_best": f"{best} SELECT * EXCLUDE (k) FROM best WHERE k = 1",
        "unresolved": f"{best} SELECT idx, addr FROM addresses a WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.idx = a.idx)",
    }
    found = "SELECT idx, addr, kind, code, name, s AS start_idx, e AS end_idx"
    out["match_by_trie"] = f"{_WITH}{_SPELLED}{_MATCHED} {found} FROM m"
    folded = _MATCHED.replace("v.variant = substr(s.addr, s.i + 1, e.i - s.i)", "v.variant = lower(substr(s.addr, s.i + 1, e.i - s.i))").replace("FROM addresses,", "FROM mixed,")
    out["match_folded"] = f"{_WITH}{_SPELLED}, mixed AS ({MIXED}){folded} {found}, substr(addr, CAST(s AS INT) + 1, CAST(e - s AS INT) + 1) AS matched FROM m"
    # The parts' answers must be those of the addresses by themselves.
    out["match_parts"] = f"""{_WITH}{_SPELLED}{_MATCHED},
placed AS (SELECT idx, idx // {IN_A_TEXT} AS batch, CAST(coalesce(sum(length(addr) + 1) OVER (PARTITION BY idx // {IN_A_TEXT} ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS o FROM addresses)
SELECT batch, kind, code, name, CASE WHEN idx % {NO_PART} = 0 THEN s + o ELSE s END AS start_idx, CASE WHEN idx % {NO_PART} = 0 THEN e + o ELSE e END AS end_idx,
 CASE WHEN idx % {NO_PART} = 0 THEN NULL ELSE idx END AS idx FROM m JOIN placed USING (idx)"""
    for k in ("ward", "district", "province"):
        out[f"distinct_{k}s"] = f"WITH gaz AS ({GAZETTEER}) SELECT DISTINCT {k}_code AS code, {k} AS name, {k}_level AS level FROM gaz"
        out[f"variants_{k}"] = f"{_WITH}{_SPELLED} SELECT code, name, level, variant FROM spelled WHERE kind = '{k}'"
        out[f"match_{k}"] = f"{_WITH}{_SPELLED}{_MATCHED} SELECT idx, addr, name AS {k}, code AS {k}_code, s AS start_idx, e AS end_idx FROM m WHERE kind = '{k}'"
    for n, v in _SCORES.items():
        out[f"score_{n}"] = f"{_WITH}{_SPELLED}{_MATCHED} {_score_sql(n, *v)}"
    return out
