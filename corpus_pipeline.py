"""A training corpus from raw documents, in stages that are written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codonmill.llm import jaccard_join, mixing, packing, quality_rules, secret_scan
from codonmill.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def passing_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows with one id and one text are one document, of which one row stays. Where an id has
    several texts, each is a document of its own: its first by digest goes by the id, the
    others by a number drawn from id and digest, above all usual ids. Rows without an id stay.
    """
    folder = shared_folder(spark)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    digest = F.md5(F.coalesce(F.col("text"), F.lit("")))
    texts = docs.where("doc_id IS NOT NULL").groupBy("doc_id")
    repeated = texts.agg(F.count(F.lit(1)).alias("_rows"), F.min(digest).alias("_first")).where("_rows > 1")
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id", digest), 2).bitwiseOR(F.lit(1 << 62))
    own = F.when(F.col("_first") != digest, drawn).otherwise(F.col("doc_id"))
    named = docs.join(written(repeated, "repeated"), "doc_id", "left").withColumn("_own", own)

    groups = jaccard_join.similar_groups(named.select("_own", "text"), doc_id="_own")
    later = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_own"))
    first = named.join(written(later.distinct(), "later"), "_own", "left_anti")
    # Only rows of repeated ids are brought together.
    one_each = first.where("_rows > 1").dropDuplicates(["_own"])
    return first.where("_rows IS NULL").unionByName(one_each).select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids and places in sequences."""
    return packing.pack_documents(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", passing_quality),
    ("jaccard_join", one_of_each_group),
    ("secret_scan", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: Packing into sequences of tokens is no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each reading what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark)
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
