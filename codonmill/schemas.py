"""Typed shapes of the processed tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codonmill import fixed_values as fv


@dataclass(frozen=True)
class ColumnRule:
    name: str
    type: str
    width: int | None
    required: bool


def rules(table: str) -> list[ColumnRule]:
    return [ColumnRule(*entry) for entry in fv.TABLES[table]]


def full_name(source: str, table: str) -> str:
    return f"{source}_human_{table}"


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project to the table's columns, in order and with its types.

    Text that is no number becomes NULL; `operators.quality.column_checks` on the
    unconformed frame reports it.
    """
    have = {name.upper(): (name, kind) for name, kind in df.dtypes}
    picked = []
    for rule in rules(table):
        name, kind = have[rule.name]
        col = F.col(f"`{name}`")
        if kind != rule.type:
            col = col.try_cast(rule.type) if kind == "string" else col.cast(rule.type)
        picked.append(col.alias(rule.name))
    return df.select(*picked)


def spark_schema(table: str) -> str:
    """DDL text of the table, for readers."""
    return ", ".join(f"{r.name} {r.type}" for r in rules(table))


def for_sink(df: DataFrame, table: str) -> DataFrame:
    """Narrow doubles to the single-precision type the target tables declare."""
    doubles = {r.name: F.col(r.name).cast("float") for r in rules(table) if r.type == "double"}
    return df.withColumns(doubles) if doubles else df
