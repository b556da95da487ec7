"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm import common


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm.suffix_dedup import remove_repeats

    return remove_repeats(common.table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm.exact_dedup import exact_groups

    return exact_groups(common.table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm import pii

    return pii.digest(pii.find_personal_data(common.table(spark, sf_dir, "documents")))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm.sharding import shard_plan

    return shard_plan(common.table(spark, sf_dir, "documents"), n_shards=8)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm import langid

    docs = common.table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    return langid.identify(docs, model, keep=["doc_id"]).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm.html_extract import extract_text

    return extract_text(common.table(spark, sf_dir, "pages"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm.warc import archived

    index = archived(common.table(spark, sf_dir, "pages"), common.fresh_path(spark, "warc"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm.minhash import near_duplicates

    return near_duplicates(common.table(spark, sf_dir, "documents"), shingle=2, percent=80)


def tokenizer_file() -> tuple[bytes, str]:
    """The rank file and split pattern of op9 (read by the driver, sent to the workers)."""
    import public_tokenizers

    return Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes(), public_tokenizers.PATTERN


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm.bpe import encode_texts

    return encode_texts(common.table(spark, sf_dir, "documents"), *tokenizer_file())


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm.decontam import contaminated

    return contaminated(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm.superkmers import remove_repeated_passages

    kept = remove_repeated_passages(common.table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm import runs

    return runs.digest(runs.periodic_runs(runs.with_planted_runs(common.table(spark, sf_dir, "documents"))))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.llm import negatives

    return negatives.mine(negatives.quantised(common.table(spark, sf_dir, "embeddings")), F.col("id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}
    return dict(sorted(out.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


#: Text contract of op2: runs of space and \t..\r become one space.
_NORM = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')"


def oracle_sql() -> dict[str, str]:
    return {
        "op11_substring_dedup": f"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 49), ' ')) AS h FROM w, LATERAL (SELECT unnest(range(1, len(w) - 48)) AS i) r),
least AS (SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h),
gone AS (SELECT doc_id, list(i) AS hits FROM windows JOIN least USING (h) WHERE first_id < doc_id GROUP BY doc_id),
spread AS (SELECT doc_id, list_distinct(flatten(list_transform(hits, lambda i: range(i, i + 50)))) AS hits FROM gone)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(hits), 0) AS BIGINT) AS n_removed,
 sha256(array_to_string(CASE WHEN hits IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(hits, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN spread USING (doc_id)""",
        "op13_hard_negatives": """
WITH e AS (SELECT vec_id AS id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
  list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS q
 FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS a, r.id AS r, a.label = r.label AS same,
  CAST(list_sum(list_transform(list_zip(a.q, r.q), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM e a JOIN e r ON a.id % 100 = 0 AND a.id <> r.id),
p AS (SELECT a, r AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, r) <= 5),
n AS (SELECT s.a, positive_id, positive_score, s.r, s.score, row_number() OVER (PARTITION BY s.a, positive_id ORDER BY s.score DESC, s.r) AS k
 FROM s JOIN p ON p.a = s.a WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT a AS anchor_id, positive_id, CAST(k AS INTEGER) AS rank, r AS negative_id, positive_score, score AS negative_score FROM n WHERE k <= 10""",
        # Base32 of a SHA-1: each five hexadecimal digits are four base32 digits.
        "op7_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT h, min(page_id) AS first_id, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST((CAST('0x' || substr(h, CAST((i // 4) * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '') AS b FROM p GROUP BY h)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, d.b AS payload_digest,
  CASE WHEN p.page_id = d.first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id = d.first_id THEN NULL ELSE d.first_id END AS refers_to
FROM p JOIN d ON p.h = d.h""",
        "op2_exact_dedup": f"""
WITH d AS (SELECT doc_id, {_NORM} AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t""",
    }
