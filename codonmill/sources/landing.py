"""Which landed files belong to which table.

A table lands as `{source}_human_{table}.{ext}`, as several such files with a
`_{part}` after the table name, or as a folder of that name holding any files, however
deep.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSIONS = "csv|tsv|txt|gz|json|xml|parquet"


def landed_files(
    spark: SparkSession, folder: str, source: str, table: str, tables: Iterable[str]
) -> list[str]:
    """Paths of one table's files: a listing, as every scan makes, not a read."""
    return claimed_files(spark, folder, source, tables).get(table, [])


def claimed_files(
    spark: SparkSession, folder: str, source: str, tables: Iterable[str]
) -> dict[str | None, list[str]]:
    """One listing of the folder: paths by table, under None those of no table."""
    names = _longest_first(tables)
    pattern = re.compile(_path_pattern(source))
    claimed: dict[str | None, list[str]] = {}
    for path in spark.read.option("recursiveFileLookup", "true").text(folder).inputFiles():
        path = unquote(path)
        found = pattern.match(path)
        claimed.setdefault(_owner(found.group(1), names) if found else None, []).append(path)
    return {table: sorted(paths) for table, paths in claimed.items()}


def table_of(file_path: Column, source: str, tables: Iterable[str]) -> Column:
    """Registered table a landed path belongs to, NULL if none.

    The longest name that fits wins: `gene_disease` files are not `gene` files.
    """
    stem = F.regexp_extract(file_path, _path_pattern(source), 1)
    return F.coalesce(
        *[
            F.when((stem == name) | stem.startswith(name + "_"), F.lit(name))
            for name in _longest_first(tables)
        ]
    )


def listing(spark: SparkSession, folder: str, source: str, tables: Iterable[str]) -> DataFrame:
    """(table, path, length, modified) of the files in a landing folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(
        table_of(F.col("path"), source, tables).alias("table"),
        "path",
        "length",
        F.col("modificationTime").alias("modified"),
    )


def file_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """(table, path, change): files of `now` that `before` lacks are added, and the other way gone.

    A file that has another length or time is both.
    """
    same = ["table", "path", "length", "modified"]
    added = now.join(before, same, "left_anti").withColumn("change", F.lit("added"))
    gone = before.join(now, same, "left_anti").withColumn("change", F.lit("gone"))
    return added.unionByName(gone).select("table", "path", "change")


def lines_per_table(
    spark: SparkSession, folder: str, source: str, tables: Iterable[str]
) -> DataFrame:
    """What has landed: lines by table, NULL for files of no table.

    Lines are counted per file before names are looked at, so the matching of
    names costs once per file, not per line.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(folder)
    per_file = lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_file.groupBy(table_of(F.col("path"), source, tables).alias("SRC_TABLE")).agg(
        F.sum("n").alias("N_LINES")
    )


def landing_glob(folder: str, source: str, table: str) -> str:
    """Glob for the table's files and folders, and those of tables whose name goes on."""
    return f"{folder.rstrip('/')}/{source}_human_{table}{{,.*,_*}}"


def longer_names(table: str, tables: Iterable[str]) -> list[str]:
    return [name for name in tables if name.startswith(table + "_")]


def _path_pattern(source: str) -> str:
    return rf"^.*/{source}_human_(\w+?)(?:\.(?:{EXTENSIONS}))*(?:/.+)?$"


def _longest_first(tables: Iterable[str]) -> list[str]:
    return sorted(tables, key=len, reverse=True)


def _owner(stem: str, names: list[str]) -> str | None:
    return next((n for n in names if stem == n or stem.startswith(n + "_")), None)
