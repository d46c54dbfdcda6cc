"""Column housekeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])


def drop_marked(df: DataFrame, names: list[str], mark: str) -> DataFrame:
    """Drop the named columns, where present, and all whose name contains `mark`."""
    return df.drop(*names, *[name for name in df.columns if mark in name.upper()])
