"""The stage area: `{base}/{raw|processed}/{source}/{source}_human_{table}`.

Parquet by default; CSV stays possible. `base` is any Hadoop file-system URI.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from codonmill import fixed_values as fv
from codonmill.schemas import full_name, spark_schema

# One line may hold any text: quotes are doubled, line breaks stay inside quotes.
# Missing values are written as nothing and empty text as "". A reader whose null
# word cannot occur tells the two apart.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}
CSV_READ_OPTIONS = {**CSV_OPTIONS, "multiLine": "true", "nullValue": "\u0000"}


def stage_path(base: str, table: str, kind: str, source: str) -> str:
    return f"{base.rstrip('/')}/{kind}/{source}/{full_name(source, table)}"


def save_stage(
    df: DataFrame, base: str, table: str, source: str, kind: str = "processed", fmt: str = "parquet"
) -> str:
    """Write one table, replacing what is there, and return its path."""
    path = stage_path(base, table, kind, source)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        codec = "gzip" if table in fv.GZIP_TABLES else "none"
        writer.options(**CSV_OPTIONS, compression=codec).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def load_stage(
    spark: SparkSession,
    base: str,
    table: str,
    source: str,
    kind: str = "processed",
    fmt: str = "parquet",
    schema: str | None = None,
) -> DataFrame:
    path = stage_path(base, table, kind, source)
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    name = full_name(source, table)
    if schema is None and kind == "processed" and name in fv.TABLES:
        schema = spark_schema(name)
    reader = spark.read.options(**CSV_READ_OPTIONS)
    return (reader.schema(schema) if schema else reader).csv(path)
