"""Registered queries of this subpackage and, where SQL can express one, its SQL.

Each query applies one operator to its whole table and derives from the operator's
output the columns that are compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codonmill.llm import (
    conversation_trie,
    embedding_dedup,
    fill_in_middle,
    jaccard_join,
    license_scan,
    lm_scoring,
    mixing,
    packing,
    quality_rules,
    run_index_dedup,
    secret_scan,
    sql,
    substring_dedup,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(_documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.cut_repeats(_documents(spark, sf_dir))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(_documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(_documents(spark, sf_dir))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(_documents(spark, sf_dir), lines=False)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, taken = mixing.mix(_documents(spark, sf_dir))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_stop_words", "n_lines",
    )


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = run_index_dedup.remove_repeats(_documents(spark, sf_dir))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = fill_in_middle.restore(fill_in_middle.transform(_documents(spark, sf_dir)))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.ordered_turns(_table(spark, sf_dir, "conversations"))
    return conversation_trie.trie(*conversation_trie.rebuilt(turns)).drop("p1", "p2")


QUERIES: dict[str, Query] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_toxicity": op4_toxicity,
    "op5_secret_scan": op5_secret_scan,
    "op6_license_scan": op6_license_scan,
    "op7_mixing": op7_mixing,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_packing": op9_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_suffix_array_dedup": op11_suffix_array_dedup,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLES: dict[str, str] = {
    "op10_quality_rules": sql.quality_rules(),
    "op12_fill_in_middle": sql.fill_in_middle(),
    "op13_conversation_trie": sql.conversation_trie(),
}
