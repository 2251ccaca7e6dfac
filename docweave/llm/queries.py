"""One query per operator over the provided tables, and the same results as SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docweave.llm import common
from docweave.llm.exact_dedup import exact_dedup
from docweave.llm.html_extraction import extract_main_text
from docweave.llm.near_dedup import near_dedup
from docweave.llm.packing import pack_documents
from docweave.llm.periodic_runs import periodic_runs
from docweave.llm.pieces import encoding_report
from docweave.llm.quality_classifier import quality_scores, train as train_quality
from docweave.llm.quality_rules import apply_policy, ledger
from docweave.llm.secrets import find_secrets, learn_limits
from docweave.llm.substring_dedup import substring_dedup
from docweave.llm.token_alignment import token_alignment
from docweave.llm.token_counts import token_counts
from docweave.llm.toxicity import toxicity_scores, train as train_toxicity

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(common.documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(common.documents(spark, sf_dir)).drop("spans")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return quality_scores(docs, train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_report(common.documents(spark, sf_dir), public_tokenizers.path(PIECE_BPE))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(common.documents(spark, sf_dir)).drop("_file", "_row")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return find_secrets(docs, learn_limits(docs))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(common.documents(spark, sf_dir)), 2)
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rows.select(*first, "fail_bits", "n_lines", "n_capitals", "n_exclamations")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return toxicity_scores(docs, train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(common.documents(spark, sf_dir), width=2).select("doc_id", "n_shingles", "component_id", "kept")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(common.documents(spark, sf_dir), planted=True)


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(common.documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_token_counts": op4_token_counts,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_secret_scans": op7_secret_scans,
    "op8_quality_rules": op8_quality_rules,
    "op9_toxicity": op9_toxicity,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_html_extraction": op12_html_extraction,
    "op13_token_alignment": op13_token_alignment,
}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLE = {
    "op2_substring_dedup": rf"""
        WITH split AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        windows AS (
            SELECT doc_id, i, sha256(array_to_string(words[i:i + 19], ' ')) AS w
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM split)
        ), later AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1
        ), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM later),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS text, count(*) AS n
            FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM split)
            ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (doc_id)
    """,
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_quality_rules": rf"""
        WITH split AS (
            SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
            FROM documents
        ), windows AS (
            SELECT doc_id, i, words[i:i + 7] AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM split)
        ), twice AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
        ), covered AS (
            SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY doc_id
        ), measured AS (
            SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
                   (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                   len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                   coalesce(n, 0)::BIGINT AS n_repeat_words,
                   (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
                   (length(text) - length(replace(text, '!', '')))::BIGINT AS n_exclamations
            FROM split LEFT JOIN covered USING (doc_id)
        ), judged AS (
            SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
                + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_capitals > 40 * word_chars THEN 8 ELSE 0 END
                + CASE WHEN 100 * n_exclamations > 20 * n_words THEN 16 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 32 ELSE 0 END
                + CASE WHEN word_chars > 12 * n_words THEN 64 ELSE 0 END
                + CASE WHEN word_chars < 2 * n_words THEN 128 ELSE 0 END)::INTEGER AS fail_bits
            FROM measured
        )
        SELECT *, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept FROM judged
    """,
}
