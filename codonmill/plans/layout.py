"""Tables laid out by a key, so that queries over them join without moving their rows.

A table is written in buckets of its key, one file per bucket, as a table of the session's
catalog, which knows the buckets. Two tables of one number of buckets join bucket by bucket
without an exchange. Such a join cannot be split where one key holds very many rows, so
those rows are kept apart, unbucketed: a key is hot if it has more rows than `hot_rows` and
than a bucket has on average. There are fewer hot keys than buckets. They meet only the
other side's rows of these keys, whose measured size lets adaptive execution broadcast
them, or split the hot key where it does not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.functions import identifiers as ids

HOT_ROWS = 1_000_000
#: Column that holds a bare gene number with its prefix, as the gene table spells it.
GENE_KEY = "GENE_KEY"


@dataclass(frozen=True)
class LaidOut:
    """`even` is bucketed by `key`; `hot` has the rows of hot keys and those without a key."""

    key: str
    even: DataFrame
    hot: DataFrame

    def whole(self) -> DataFrame:
        return self.even.unionByName(self.hot)


def lay_out(df: DataFrame, table: str, key: str, buckets: int, folder: str, hot_rows: int = HOT_ROWS) -> LaidOut:
    """Write a table in buckets of `key` under `folder`, replacing what the catalog has of it.

    `df` is read three times and should be a written table. Its rows without a key, which
    join with nothing, go with the hot ones, since they would all share a bucket.
    """
    limit = max(hot_rows, df.count() // buckets)
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > limit)
    marked = df.join(hot.where(F.col(key).isNotNull()), key, "left").select(*df.columns, "_rows")
    apart = F.col("_rows").isNotNull() | F.col(key).isNull()
    even = marked.where(~apart).drop("_rows").repartition(buckets, key)
    even.write.mode("overwrite").option("path", f"{folder}/{table}").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    spread = marked.where(apart).drop("_rows")
    spread.write.mode("overwrite").option("path", f"{folder}/{table}_hot").saveAsTable(f"{table}_hot")
    return laid_out(df.sparkSession, table, key)


def laid_out(spark: SparkSession, table: str, key: str = "GENE_ID") -> LaidOut:
    """A table that `lay_out` has written, of the catalog."""
    return LaidOut(key, spark.table(table), spark.table(f"{table}_hot"))


def by_gene(df: DataFrame, table: str) -> tuple[DataFrame, str] | None:
    """The table with the column to lay it out by, and its name; None if it names no gene."""
    if "GENE_ID" not in df.columns:
        return None
    if table == "ncbi_human_snp_summary_gene_lookup":
        # This lookup alone has bare numbers; its own column stays as it is.
        return df.withColumn(GENE_KEY, ids.prefixed(fv.GENE_PREFIX, F.col("GENE_ID"))), GENE_KEY
    return df, "GENE_ID"


def linked(query: Callable[[DataFrame, DataFrame], DataFrame], one: LaidOut, other: LaidOut) -> DataFrame:
    """A query that inner joins two laid-out tables by their keys, part by part.

    Each pair of rows meets in one part: bucket with bucket, the first table's ordinary
    keys with the other's hot ones, and the first table's hot keys with all the other has.
    """

    def of_keys(side: DataFrame, key: str, hot: LaidOut) -> DataFrame:
        keys = hot.hot.select(F.col(hot.key).alias(key)).distinct()
        # The exchange lets adaptive execution see how few rows these are.
        return side.join(keys, key, "left_semi").repartition(key)

    return (
        query(one.even, other.even)
        .unionByName(query(of_keys(one.even, one.key, other), other.hot))
        .unionByName(query(one.hot, of_keys(other.whole(), other.key, one)))
    )
