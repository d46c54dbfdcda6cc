"""Running numbers within a key, in the order of the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered_lookup(
    df: DataFrame,
    key: str,
    values: Column,
    name: str,
    number: str,
    source: str,
    order: Sequence[str] = (),
    chunk: Sequence[str] = (),
) -> DataFrame:
    """Explode `values` beside `key` and number the rows of each key from 1.

    Without `order` every key must occur once (its primary-key check says so) and
    the position in the array is the number: no shuffle. With `order` keys may
    repeat, and numbers run on over the rows of a key in that order.
    """
    listed = df.withColumn("_values", values)
    if not order:
        base = F.lit(0)
    else:
        listed = running_total(listed, key, F.array_size("_values"), "_base", order, chunk)
        base = F.col("_base")
    return listed.select(key, F.posexplode("_values").alias("_pos", name), base.alias("_base")).select(
        key,
        name,
        (F.col("_base") + F.col("_pos") + 1).cast("int").alias(number),
        F.lit(source).alias("LOOKUP_SOURCE"),
    )


def running_total(
    df: DataFrame,
    key: str,
    amount: Column,
    out: str,
    order: Sequence[str],
    chunk: Sequence[str],
) -> DataFrame:
    """Sum of `amount` over the earlier rows of the same key.

    `chunk` columns cut the input into pieces of bounded size that follow each
    other in `order` (file blocks, ranges of the order column). A window over a
    whole key would put a hot key into one task; here a key's rows meet only
    within a chunk, and a second window adds up one total per chunk. The rows are
    shuffled once. Rows without a key get no sum.
    """
    rows = df.withColumn("_amount", F.coalesce(amount, F.lit(0)).cast("long"))
    before = (Window.unboundedPreceding, -1)

    per_key = Window.partitionBy(key).orderBy(*chunk).rowsBetween(*before)
    starts = (
        rows.where(F.col(key).isNotNull())
        .groupBy(key, *chunk)
        .agg(F.sum("_amount").alias("_total"))
        .select(key, *chunk, F.coalesce(F.sum("_total").over(per_key), F.lit(0)).alias("_start"))
    )

    per_chunk = Window.partitionBy(key, *chunk).orderBy(*order).rowsBetween(*before)
    within = F.coalesce(F.sum("_amount").over(per_chunk), F.lit(0))
    return (
        rows.withColumn("_within", within)
        .join(starts, [key, *chunk], "left")
        .select(*df.columns, (F.col("_start") + F.col("_within")).alias(out))
    )
