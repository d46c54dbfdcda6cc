"""Refresh of updated records only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_digest(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row.

    Spark's hash passes over NULLs, so (x, NULL) and (NULL, x) would be equal;
    the null marks beside the values keep them apart.
    """
    marks = [F.col(c).isNull() for c in columns]
    return [
        F.xxhash64(*columns, *marks).alias("_h1"),
        F.xxhash64(F.lit(1), *reversed(columns), *marks).alias("_h2"),
    ]


def changed_rows(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows that the stored table does not have as they are.

    Of the stored table only the hashes are shuffled, each once however many
    copies a row has.
    """
    columns = sorted(incoming.columns)
    known = stored.select(*row_digest(columns)).distinct()
    marked = incoming.select("*", *row_digest(columns))
    return marked.join(known, ["_h1", "_h2"], "left_anti").select(*incoming.columns)


def upsert(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The stored table with the changed rows in place of those of the same key.

    `key` is a primary key. Stored rows whose key is absent from `incoming` stay. Where
    `incoming` repeats a key, none of its rows is lost: if one has changed, all come in.
    """
    changed = changed_rows(stored, incoming).select(F.col(key).alias("_key")).distinct()
    whole = incoming.join(changed, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    return replace_keys(stored, whole, key)


def replace_keys(
    stored: DataFrame, incoming: DataFrame, key: str, came: DataFrame | None = None
) -> DataFrame:
    """For lookup tables, where a key has many rows: all rows of each incoming key
    take the place of the stored rows of that key.

    `came` may hold the keys that came in, in one column, where some of them have no
    incoming rows any more.
    """
    keys = incoming.select(key) if came is None else came
    replaced = keys.toDF("_key").distinct()
    kept = stored.join(replaced, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    return kept.unionByName(incoming)
