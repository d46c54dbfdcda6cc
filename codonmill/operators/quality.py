"""Checks a loading database would make, as jobs that return the violations.

All return rows of (TABLE_NAME, RULE, COLUMN_NAME, KEY_VALUE, N_ROWS); an empty
result means the table is clean.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.schemas import conform, rules

REPORT = "TABLE_NAME string, RULE string, COLUMN_NAME string, KEY_VALUE string, N_ROWS long"
BROKEN, ACCEPTED = "BROKEN", "ACCEPTED"


def report(df: DataFrame, table: str, rule: str, column: str, key: Column, n: Column) -> DataFrame:
    return df.select(
        F.lit(table).alias("TABLE_NAME"),
        F.lit(rule).alias("RULE"),
        F.lit(column).alias("COLUMN_NAME"),
        key.cast("string").alias("KEY_VALUE"),
        n.cast("long").alias("N_ROWS"),
    )


def unique_check(df: DataFrame, table: str) -> DataFrame:
    """Key values of the table's primary key that occur more than once."""
    key = fv.PRIMARY_KEYS[table]
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return report(counted, table, "unique", key, F.col(key), F.col("_n"))


def reference_check(child: DataFrame, parent: DataFrame, table: str) -> DataFrame:
    """Values of the table's foreign key that its parent lacks.

    The child is reduced to one counted row per value before anything is joined.
    """
    column, parent_table = fv.FOREIGN_KEYS[table]
    counted = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(F.col(column)).distinct()
    orphans = counted.join(parents, column, "left_anti")
    return report(orphans, table, "reference", column, F.col(column), F.col("_n"))


def _column_rules(df: DataFrame, table: str) -> list[tuple[str, str, Column]]:
    """(rule, column, whether a row breaks it) for the table's columns."""
    kinds = {name.upper(): kind for name, kind in df.dtypes}
    found = []
    for rule in rules(table):
        col = F.col(rule.name)
        if rule.required:
            found.append(("not_null", rule.name, col.isNull()))
        if rule.width:
            found.append(("width", rule.name, F.length(col) > rule.width))
        if rule.type != "string" and kinds[rule.name] == "string":
            found.append(("type", rule.name, col.isNotNull() & col.try_cast(rule.type).isNull()))
    return found


def split_rows(df: DataFrame, table: str, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write rows that keep the column rules and rows that break some, in one pass over `df`.

    `df` is the table before its types are applied. Returns the accepted rows with their
    final types, the rejected ones as they came with an array BROKEN of `rule column`, and
    the violations, which are counted while the rows are written. All three equal what
    `column_checks` finds; the rejected rows also tell which rows these are.
    """
    checks = _column_rules(df, table)
    names = [f"{rule} {column}" for rule, column, _ in checks]
    broken = F.array_compact(
        F.array(*[F.when(bad, name) for name, (_, _, bad) in zip(names, checks, strict=True)])
    ).cast("array<string>")
    marked = df.withColumn(BROKEN, broken)
    counts = Observation()
    if names:
        marked = marked.observe(
            counts, *[F.count_if(F.array_contains(BROKEN, name)).alias(name) for name in names]
        )
    path = f"{folder.rstrip('/')}/{table}"
    marked.withColumn(ACCEPTED, F.size(BROKEN) == 0).write.partitionBy(ACCEPTED).parquet(path)
    stored = df.sparkSession.read.schema(marked.withColumn(ACCEPTED, F.lit(True)).schema).parquet(path)
    accepted = conform(stored.where(ACCEPTED).drop(BROKEN, ACCEPTED), table)
    rejected = stored.where(f"NOT {ACCEPTED}").drop(ACCEPTED)
    found = [
        (table, rule, column, None, counts.get[name])
        for name, (rule, column, _) in zip(names, checks, strict=True)
        if counts.get[name]
    ]
    return accepted, rejected, df.sparkSession.createDataFrame(found, REPORT)


def column_checks(df: DataFrame, table: str) -> DataFrame:
    """Missing, too wide and wrongly typed values per column, in one pass over the table."""
    counts = _column_rules(df, table)
    if not counts:
        return _no_violations(df)

    totals = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(counts)])
    found = F.array(
        *[
            F.struct(
                F.lit(rule).alias("RULE"),
                F.lit(column).alias("COLUMN_NAME"),
                F.col(f"_{i}").alias("N_ROWS"),
            )
            for i, (rule, column, _) in enumerate(counts)
        ]
    )
    return (
        totals.select(F.explode(found).alias("_f"))
        .where("_f.N_ROWS > 0")
        .select(
            F.lit(table).alias("TABLE_NAME"),
            "_f.RULE",
            "_f.COLUMN_NAME",
            F.lit(None).cast("string").alias("KEY_VALUE"),
            "_f.N_ROWS",
        )
    )


def surplus_check(raw: DataFrame, table: str, column: str) -> DataFrame:
    """Raw rows with more fields than the table has names for."""
    counted = raw.agg(F.count(column).alias("_n")).where("_n > 0")
    return report(counted, table, "surplus", column, F.lit(None), F.col("_n"))


def unknown_check(fields: DataFrame, table: str) -> DataFrame:
    """Records by the name of a field (NAME) that the table has no column for."""
    counted = fields.groupBy("NAME").agg(F.count(F.lit(1)).alias("_n"))
    return counted.select(
        F.lit(table).alias("TABLE_NAME"),
        F.lit("unknown").alias("RULE"),
        F.col("NAME").alias("COLUMN_NAME"),
        F.lit(None).cast("string").alias("KEY_VALUE"),
        F.col("_n").alias("N_ROWS"),
    )


def _no_violations(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], REPORT)


def all_checks(
    tables: dict[str, DataFrame], loose: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Every check that applies to the given full-named tables.

    `loose` may hold the same tables before their types were applied; columns are
    then checked there, where a wrongly typed value can still be seen.
    """
    reports = [column_checks((loose or {}).get(name, df), name) for name, df in tables.items()]
    reports += [unique_check(df, name) for name, df in tables.items() if name in fv.PRIMARY_KEYS]
    for child, (_, parent) in fv.FOREIGN_KEYS.items():
        if child in tables and parent in tables:
            reports.append(reference_check(tables[child], tables[parent], child))
    return reduce(DataFrame.unionByName, reports)
