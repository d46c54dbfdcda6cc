"""Global order for output files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_by(df: DataFrame, key: str) -> DataFrame:
    """Sort by `key` in binary text order, missing keys last.

    The sort goes on by row content and input partition, so that neither many
    rows of one key nor many copies of one row end up in a single range.
    """
    return df.orderBy(
        F.col(key).asc_nulls_last(),
        F.xxhash64(*df.columns),
        F.spark_partition_id(),
    )
