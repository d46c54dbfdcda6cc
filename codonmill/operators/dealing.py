"""Rows dealt to partitions of even size."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dealt(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Deal rows to `parts` partitions, or to as many as adaptive execution finds fit.

    They go by a hash of their content. To deal them in turn, Spark sorts all rows of a
    task in its memory first, and a gzip file is one task.
    """
    keys = _keys(df)
    if parts is not None:
        return df.repartition(parts, *keys)
    return df.hint("rebalance", *keys)


def _keys(df: DataFrame) -> list[Column]:
    """The columns that can be hashed and have a name of their own."""
    times = Counter(name.upper() for name in df.columns)
    return [
        F.col("`{}`".format(name.replace("`", "``")))
        for name, kind in df.dtypes
        if times[name.upper()] == 1 and not re.search("map<|variant", kind)
    ]
