"""Lookup tables: one row per value of a multi-valued field."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame,
    key: Column,
    values: Column,
    name: str,
    source: str,
    drop: Sequence[str] = (),
    keep_null: bool = False,
) -> DataFrame:
    """Explode `values` beside `key`; a narrow job, no shuffle.

    `drop` lists values that mean "nothing here". NULL elements go as well unless
    `keep_null`.
    """
    rows = df.select(key, F.explode(values).alias(name), F.lit(source).alias("LOOKUP_SOURCE"))
    value = F.col(name)
    if drop:
        rows = rows.where(value.isNull() | ~value.isin(*drop))
    return rows if keep_null else rows.where(value.isNotNull())
