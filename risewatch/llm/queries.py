"""The operators as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risewatch.llm import bpe, divergence, exact, hnsw, langid, licences, minhash, mixing, pages, repeats, sharding, simhash, variants
from risewatch.llm.shared import table


def vocabulary() -> str:
    """Place of the public vocabulary; None of it is kept here."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.train(table(spark, sf_dir, "documents"))
    return langid.identify_pages(table(spark, sf_dir, "pages"), model)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), vocabulary())


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    return sharding.shuffle_shards(docs, 40).select(
        "doc_id", (F.octet_length(text) + sharding.ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.LicenceModel(spark, docs).scan(docs)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op10_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), "id % 50 = 0")


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_mixing": op2_mixing,
    "op3_bpe": op3_bpe,
    "op4_sharding": op4_sharding,
    "op5_license_scan": op5_license_scan,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_simhash": op8_simhash,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_hnsw": op10_hnsw,
    "op11_minhash": op11_minhash,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_source_divergence": op13_source_divergence,
}
#: The other operators have no SQL form (hashes, models, graphs, tokens): tests compare them with brute force.
ORACLE: dict[str, str] = {
    "op6_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS k
            FROM documents
        )
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY k) AS group_size,
               doc_id = first_value(doc_id) OVER best AS kept, sha256(k) AS text_sha256
        FROM n WINDOW best AS (PARTITION BY k ORDER BY points DESC, doc_id)""",
    "op13_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
            FROM documents
        ), t AS (
            SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
            FROM d
        ), k AS (
            SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10
        ), g AS (
            SELECT DISTINCT lang, source FROM d
        ), c AS (
            SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL
        ), f AS (
            SELECT lang, source, term, coalesce(n, 0)::HUGEINT AS n, lang_n::HUGEINT AS lang_n
            FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
        ), p AS (
            SELECT lang, source, term, n, 1 + 1000000000 * (n + 2) // (sum(n) OVER w + 2 * count(*) OVER w) AS p,
                   1 + 1000000000 * (lang_n + 2) // (sum(lang_n) OVER w + 2 * count(*) OVER w) AS q
            FROM f WINDOW w AS (PARTITION BY lang, source)
        ), a AS (
            SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
            FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
        ), pairs AS (
            SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(a.value, 0)::BIGINT AS value
            FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
            LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
        ), terms AS (
            SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        )
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10""",
}
