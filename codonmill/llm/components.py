"""Connected components by joins, for graphs of any size and with hubs of any degree.

Each round hangs neighbours on the smallest node next to them, first the larger
neighbours of every node, then the smaller ones (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014). The rounds needed grow with the logarithm of the graph.
Smallest neighbours are found by aggregation before the shuffle; the join that follows has
one row per node on one side, so a hub's partition can be split. Every round is written
to the shared folder and read again, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codonmill.session import shared_folder


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); the component is its smallest node.

    Repeated links and links from a node to itself do no harm; links with a null end are
    dropped. A node without links to others is not returned.
    """
    spark = links.sparkSession
    folder = shared_folder(spark)
    edges = (
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state, number = None, 0
    while True:
        path = f"{folder}/{number}"
        edges.write.parquet(path)
        edges = spark.read.parquet(path)
        now = edges.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.xxhash64("b", "a") % 1000003)
        ).first()
        if now == state or not now[0]:
            break
        state, number = now, number + 1
        edges = _smaller(_larger(edges))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _larger(edges: DataFrame) -> DataFrame:
    """For each node, its larger neighbours hang on the smallest of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    upward = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return (
        upward.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    )


def _smaller(edges: DataFrame) -> DataFrame:
    """For each node, it and its smaller neighbours hang on the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()
