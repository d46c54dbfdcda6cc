"""Tables in ranges of their key, updated range by range.

Beside each range lies the digest of every key in it: the number of its rows and hashes
over them. An update compares the digests of the keys that came in with those stored in
the ranges they fall into, and rewrites only the ranges with a changed key. Other ranges
are neither read nor written; the next commit names their folders again.

Ranges are cut by numbers of distinct keys. A key with very many rows makes its range
large, but a range is written in as many files as its size asks for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.operators.quality import REPORT, report, unique_check
from codonmill.plans.incremental import row_digest
from codonmill.schemas import for_sink
from codonmill.session import shared_folder
from codonmill.sources.versions import Change, Entry

#: Bounds that stand as literals in a plan.
MOST_RANGES = 512


def key_digests(df: DataFrame, key: str, came: DataFrame | None = None) -> DataFrame:
    """(_key, _n, _x, _s): per key, its number of rows and two sums of hashes over them.

    Keys of `came`, a frame of one column, are there too; those without rows have an _n of 0.
    """
    first, second = row_digest(sorted(df.columns))
    hashed = df.select(F.col(key).cast("string").alias("_key"), F.lit(1).alias("_one"), first, second)
    if came is not None:
        nothing = [F.lit(0).alias("_one"), *[F.lit(0).cast("long").alias(c) for c in ("_h1", "_h2")]]
        hashed = hashed.unionByName(came.toDF("_key").select(F.col("_key").cast("string"), *nothing))
    return hashed.groupBy("_key").agg(
        F.sum("_one").alias("_n"),
        F.bit_xor("_h1").alias("_x"),
        F.sum(F.shiftright("_h2", 32)).alias("_s"),
    )


def range_of(key: Column, lows: list[str | None]) -> Column:
    """Number of the range of a key; keys that are missing belong to the first."""
    bounds = [F.lit(low) for low in lows[1:]]
    if not bounds:
        return F.lit(0)
    text = key.cast("string")
    return F.coalesce(F.size(F.filter(F.array(*bounds), lambda low: low <= text)), F.lit(0))


def save_ranged(change: Change, df: DataFrame, table: str, key: str, ranges: int = 64) -> list[Entry]:
    """Write the whole table in ranges of `key`, in place of what it was."""
    if not 0 < ranges <= MOST_RANGES:
        raise ValueError(f"from 1 to {MOST_RANGES} ranges")
    rows = for_sink(df, table)
    known = change.spark.read.parquet(_written(key_digests(rows, key)))
    sliced = known.where("_key IS NOT NULL").select("_key").repartitionByRange(ranges, "_key")
    firsts = sliced.groupBy(F.spark_partition_id().alias("_p")).agg(F.min("_key").alias("low"))
    lows = [None, *sorted(row.low for row in firsts.take(MOST_RANGES))[1:]]
    parts = _write_parts(change, table, rows, known, key, lows, list(range(len(lows))))
    change.put(table, parts, alone=True)
    return parts


def update_ranged(
    change: Change, incoming: DataFrame, table: str, key: str, came: DataFrame | None = None
) -> list[int]:
    """Let the incoming rows of each key stand in place of the stored ones; ranges rewritten.

    `came` may hold the keys that came in, in one column, where some have no rows any more.
    """
    spark = change.spark
    parts = {e.part: e for e in change.parts(table)}
    if not parts or any(e.digests is None and e.data is not None for e in parts.values()):
        raise ValueError(f"{table} is not stored in ranges; use save_ranged first")
    lows = [parts[i].low for i in sorted(parts)]
    rows = for_sink(incoming, table)
    delta = key_digests(rows, key, came)
    delta = spark.read.parquet(_written(delta.withColumn("_part", range_of(F.col("_key"), lows))))
    asked = [row[0] for row in delta.select("_part").distinct().take(MOST_RANGES)]
    known = _read(spark, [parts[i].digests for i in asked], delta.drop("_part"))
    # One join tells which keys have changed and what the digests are afterwards.
    both = spark.read.parquet(_written(_compared(known, delta, lows)))
    changed = both.where("_changed")
    touched = sorted(row[0] for row in changed.select("_part").distinct().take(MOST_RANGES))
    if not touched:
        return []
    keys = changed.select("_key")
    stored = _read(spark, [parts[i].data for i in touched], rows)
    mine = F.col(key).cast("string").eqNullSafe(F.col("_key"))
    merged = stored.join(keys, mine, "left_anti").unionByName(rows.join(keys, mine, "left_semi"))
    digests = both.where(F.col("_part").isin(touched) & (F.col("_n") > 0)).drop("_part", "_changed")
    change.put(table, _write_parts(change, table, merged, digests, key, lows, touched))
    return touched


def _compared(known: DataFrame, delta: DataFrame, lows: list[str | None]) -> DataFrame:
    """Digests of stored and incoming keys as they are after an update, whether they change, and their range.

    A key without rows is changed where it has some stored; its _n is then 0.
    """
    old, new = known.alias("k"), delta.alias("d")
    columns = ("_n", "_x", "_s")
    same = reduce(lambda a, b: a & b, [F.col(f"d.{c}").eqNullSafe(F.col(f"k.{c}")) for c in columns])
    came, stored = F.col("d._n").isNotNull(), F.col("k._n").isNotNull()
    joined = old.join(new, F.col("k._key").eqNullSafe(F.col("d._key")), "full").select(
        F.coalesce("d._key", "k._key").alias("_key"),
        (came & ~same & ((F.col("d._n") > 0) | stored)).alias("_changed"),
        stored.alias("_stored"),
        *[F.struct(f"{side}._n", f"{side}._x", f"{side}._s").alias(f"_{side}") for side in "kd"],
    )
    picked = [F.when(F.col("_changed"), F.col(f"_d.{c}")).otherwise(F.col(f"_k.{c}")).alias(c) for c in columns]
    part = range_of(F.col("_key"), lows).alias("_part")
    return joined.where("_changed OR _stored").select("_key", *picked, "_changed", part)


def increment_violations(change: Change, incoming: DataFrame, table: str, parents: DataFrame | None = None) -> DataFrame:
    """What `quality.unique_check` and `reference_check` would find after an update, about its keys.

    Rows that come in for a key replace those stored, so a primary key is broken by the
    incoming rows alone; a foreign key may also be met by the stored parent. Of a parent in
    ranges only the key digests of ranges that the incoming keys fall into are read, never its rows.
    `parents` may hold the keys of the parent that come with the same update, in one column.
    """
    reports = []
    if table in fv.PRIMARY_KEYS:
        reports.append(unique_check(incoming, table))
    if table in fv.FOREIGN_KEYS:
        column, parent = fv.FOREIGN_KEYS[table]
        keys = incoming.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        entries = sorted(change.parts(parent), key=lambda e: e.part)
        lows = [e.low for e in entries]
        keys = change.spark.read.parquet(_written(keys.withColumn("_part", range_of(F.col(column), lows))))
        asked = [row[0] for row in keys.select("_part").distinct().take(MOST_RANGES)]
        empty = keys.select(F.col(column).cast("string").alias("_key"))
        stored = _read(change.spark, [e.digests for e in entries if e.part in asked], empty)
        known = stored if parents is None else stored.unionByName(parents.toDF("_key"))
        missing = keys.join(known, F.col(column) == F.col("_key"), "left_anti")
        reports.append(report(missing, table, "reference", column, F.col(column), F.col("_n")))
    return reduce(DataFrame.unionByName, reports) if reports else incoming.sparkSession.createDataFrame([], REPORT)


def _write_parts(
    change: Change, table: str, rows: DataFrame, digests: DataFrame, key: str, lows: list, numbers: list[int]
) -> list[Entry]:
    """Data and digests of the given ranges, a folder each; ranges without rows have none."""
    data, beside = change.folder(table), change.folder(f"{table}_digests")
    for df, own, path in ((rows, F.col(key), data), (digests, F.col("_key"), beside)):
        placed = df.withColumn("_part", range_of(own, lows))
        placed.hint("rebalance", "_part").write.partitionBy("_part").parquet(path)
    written = change.spark.read.parquet(beside) if digests.head(1) else None
    filled = {r[0] for r in written.select("_part").distinct().take(MOST_RANGES)} if written else set()
    return [
        Entry(
            "table",
            table,
            i,
            lows[i],
            f"{data}/_part={i}" if i in filled else None,
            f"{beside}/_part={i}" if i in filled else None,
        )
        for i in numbers
    ]


def _read(spark, folders: list[str | None], like: DataFrame) -> DataFrame:
    paths = [f for f in folders if f]
    return spark.read.parquet(*paths).select(*like.columns) if paths else like.limit(0)


def _written(df: DataFrame) -> str:
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return path
