"""The operators applied to their whole tables, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import (
    bpe, chat, decontaminate, embedding_dedup, html_text, langid, manifest, packing, ranking, simhash, token_counts, token_files, url_filter)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Host and path rules, and patterns for urls that none of them judges.
URL_RULES = [
    url_filter.path_rule("allow", "org/"),
    url_filter.path_rule("block", "example.org/es/"),
    url_filter.path_rule("block", "example.org/en/1"),
    url_filter.path_rule("allow", "com/fr/"),
    url_filter.path_rule("block", "com/de/"),
    url_filter.pattern("block", r"(?s)^([^/]*\.)?spam-farm\.", "spam-farm"),
    url_filter.pattern("block", r"(?s)^([^/]*\.)?cheap-pills\.", "cheap-pills"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every role is recovered without having been seen: by a model of the other four fifths of the conversations.

    So held_out is true for all rows. Turns come ready-made; raw transcripts are for chat.parse_transcripts.
    """
    turns = _table(spark, sf_dir, "conversations")
    found = chat.recover_roles(turns.withColumn("role", F.lit(None).cast("string")), chat.learn_others(turns))
    return found.select("conv_id", "turn", F.lit(True).alias("held_out"), F.col("role_found").alias("role"),
                        chat.rendered(F.col("text"), F.col("role_found")).alias("rendered"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """section_tokens are those of the text's lines."""
    counts = token_counts.token_counts(_table(spark, sf_dir, "documents"), BYTE_RANKS, ("source", "lang", "text"))
    fields = [F.col("field_tokens")[n].alias(f"{name}_tokens") for n, name in enumerate(("source", "lang", "text"))]
    return counts.select("doc_id", "n_tokens", "n_crossing", "separator_tokens", *fields, F.col("section_tokens")[2].alias("section_tokens"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(_table(spark, sf_dir, "documents"), BYTE_BPE)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), short_inside=True)


def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = langid.learn(docs)
    found = langid.identify(docs, learned, langid.learned_margin(learned))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred",
                        F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"), WORD_BPE)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(ranking.build_index(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), WORD_BPE)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering adds 1 to n_chars where 7 divides the checksum of the decimal doc_id."""
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 0
    return manifest.document_manifest(_table(spark, sf_dir, "documents"), tampered)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filter, op2_embedding_dedup, op3_chat_format, op4_html_text, op5_token_counts, op6_bpe_round_trip, op7_decontaminate, op8_simhash_groups, op9_language_id,
        op10_token_files, op11_lexical_search, op12_best_fit_packing, op13_merkle_manifest)
}
SQL: dict[str, str] = {"op1_url_filter": r"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(name, host_rule, path_rule, decision) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'), ('example.org/en/1', 'example.org', '/en/1', 'block'),
  ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
judged AS (
  SELECT page_id, host, path,
    (SELECT arg_max(name, length(name)) FROM rules
     WHERE (host = host_rule OR ends_with(host, '.' || host_rule)) AND starts_with(path, path_rule)) AS rule
  FROM parts)
SELECT page_id, host, path, rule, coalesce((SELECT max(decision) FROM rules WHERE name = rule),
  CASE WHEN regexp_matches('.' || host || path, '^[^/]*\.(spam-farm|cheap-pills)\.') THEN 'block' ELSE 'allow' END) AS verdict
FROM judged""", "op11_lexical_search": r"""
WITH postings AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents) GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
norms AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM lengths, total),
worth AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, total GROUP BY term),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN worth USING (term) JOIN postings USING (term) JOIN norms USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS "rank", doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20"""}
