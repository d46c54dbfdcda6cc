"""Writers for the target tables. Errors are the caller's to see."""

from __future__ import annotations

from pyspark.sql import DataFrame

from codonmill.schemas import for_sink


def write_table(
    df: DataFrame,
    table: str,
    target: str | None = None,
    overwrite: bool = False,
    fmt: str = "parquet",
    bucket_by: tuple[int, str] | None = None,
) -> str:
    """Append to or replace a table: a folder under `target`, else a catalog table.

    `bucket_by` = (count, column) lays a catalog table out for repeated joins on
    that column.
    """
    writer = for_sink(df, table).write.format(fmt).mode("overwrite" if overwrite else "append")
    if target is not None:
        path = f"{target.rstrip('/')}/{table}"
        writer.save(path)
        return path
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(table)
    return table


def write_jdbc(
    df: DataFrame,
    table: str,
    url: str,
    properties: dict[str, str],
    overwrite: bool = False,
    batch_rows: int = 10_000,
    connections: int = 16,
) -> str:
    """Append to or replace a table of an external database, in batches of rows.

    Replacing empties the table instead of dropping it, which keeps its keys. At
    most `connections` tasks write at a time.
    """
    writer = for_sink(df, table).write.format("jdbc").options(**properties)
    writer.options(
        url=url, dbtable=table, batchsize=batch_rows, numPartitions=connections, truncate="true"
    ).mode("overwrite" if overwrite else "append").save()
    return table
