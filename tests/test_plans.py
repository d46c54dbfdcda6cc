"""What the plans may and may not contain."""

import ast
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from codonmill.operators.numbering import numbered_lookup
from codonmill.operators.ordering import ordered_by
from codonmill.operators.outer_join import full_outer
from codonmill.plans import ncbi
from harness import shapes
from harness.queries import QUERIES, _job

SF = "/root/testdata/sf0.001"
LIBRARY = pathlib.Path(__file__).parent.parent / "codonmill"
NARROW = [n for n in QUERIES if n.startswith("t") and n[:3] < "t12"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NARROW)
def test_jobs_do_not_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "Exchange" not in text and "Window" not in text


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "tjerv" and not n.startswith("t14") and n != "t15_new_files"])
def test_no_python_workers_and_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for banned in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text


def test_taxon_filter_and_columns_reach_the_scan(spark, tmp_path):
    raw = shapes.raw(spark, SF, "gene2go")
    raw.withColumn("wide", F.lit("x")).write.parquet(str(tmp_path / "t"))
    text = plan(ncbi.gene2go(spark.read.parquet(str(tmp_path / "t")).drop("wide")))
    assert "EqualTo(`#tax_id`,9606)" in text or "EqualTo(#tax_id,9606)" in text
    assert "PubMed" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_lookup_reads_two_columns(spark, tmp_path):
    shapes.raw(spark, SF, "gene_info").write.parquet(str(tmp_path / "t"))
    text = plan(ncbi.gene_info_symbol_lookup(spark.read.parquet(str(tmp_path / "t"))))
    assert re.search(r"ReadSchema: (\S+)", text).group(1) == "struct<#tax_id:int,GeneID:string,Synonyms:string>"


def test_merged_profile_shares_its_exchanges(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(QUERIES["t12_j01_gene_merged"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # Of the annotated side there is one exchange, read twice; the full join runs once.
    assert text.count("FullOuter") == 1 and "ReusedExchange" in text


def test_hot_key_of_an_outer_join_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        many = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") < 20_000, 7).otherwise(F.col("id") % 5_000).cast("string").alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("a"),
        )
        one = spark.range(4_000, 6_000).select(F.col("id").cast("string").alias("k"), F.lit("b").alias("b"))
        one = one.union(spark.createDataFrame([("7", "b")], "k string, b string"))
        got = full_outer(many, one, "k")
        assert got.agg(F.count(F.lit(1))).first()[0] == 61_000
        got.collect()
        assert "skew" in plan(got)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_numbering_shuffles_rows_once(spark):
    rows = spark.range(100).select(
        F.lit("g").alias("id"), F.col("id").alias("n"), F.floor(F.col("id") / 10).alias("c"), F.array(F.lit("v")).alias("v")
    )
    text = plan(numbered_lookup(rows, "id", F.col("v"), "s", "no", "x", order=["n"], chunk=["c"]))
    left = text[text.index("LeftOuter") :]
    left = left[: left.index("HashAggregate")]
    assert left.count("hashpartitioning(id") <= 2  # the rows' exchange, and that of the small totals


def test_order_spreads_copies(spark):
    copies = spark.range(0, 8000, 1, 8).select(F.lit("G1").alias("k"), F.lit("same").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would merge partitions this small
    try:
        placed = ordered_by(copies, "k").withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in placed.groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 8000 and max(sizes) < 4000


def sources():
    """All modules but those of the corpus pipeline, which has rules of its own."""
    paths = [path for path in LIBRARY.rglob("*.py") if path.parent.name != "llm"]
    return [(path, path.read_text()) for path in paths]


def test_library_takes_nothing_to_the_driver():
    banned = {"collect", "toPandas", "localCheckpoint", "toLocalIterator", "crossJoin", "broadcast", "udf", "pandas_udf"}
    for path, text in sources():
        used = {node.attr for node in ast.walk(ast.parse(text)) if isinstance(node, ast.Attribute)}
        assert not used & banned, f"{path}: {used & banned}"


def test_windows_are_partitioned():
    for path, text in sources():
        assert not re.search(r"Window\s*\.\s*(orderBy|rowsBetween)", text), path


def test_flagship(spark):
    job = _job(spark, SF, "kegg", "gene", "gene")
    assert job.count() == spark.read.parquet(f"{SF}/part.parquet").count()
