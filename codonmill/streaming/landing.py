"""Newly landed list files, each loaded once.

Structured Streaming remembers in its checkpoint which files were read; a run
with `availableNow` takes what landed since the last one, and ends. `load_new_files` adds the
rows of new files; `merge_new_files` lets them take the place of older rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codonmill import fixed_values as fv
from codonmill.plans.ranged import save_ranged, update_ranged
from codonmill.plans.registry import REGISTRY, spec
from codonmill.schemas import for_sink
from codonmill.session import shared_folder
from codonmill.sources.delimited import fields
from codonmill.sources.landing import landing_glob, longer_names, table_of
from codonmill.sources.versions import TableSet

SOURCE = "kegg"
LANDED = "LANDED"


def stream_list(spark: SparkSession, folder: str, table: str, landed: bool = False) -> DataFrame:
    """Raw rows of one list table, from files of that table only.

    With `landed`, a column LANDED tells when and where a row's file landed.
    """
    spec(SOURCE, table)
    lines = spark.readStream.option("recursiveFileLookup", "true").text(
        landing_glob(folder, SOURCE, table)
    )
    if longer_names(table, REGISTRY[SOURCE]):
        owner = table_of(F.col("_metadata.file_path"), SOURCE, REGISTRY[SOURCE])
        lines = lines.where(owner == table)
    lines = lines.where(F.col("value") != "")
    if landed:
        when = F.struct("_metadata.file_modification_time", "_metadata.file_path")
        lines = lines.withColumn(LANDED, when)
    return fields(lines, fv.KEGG_RAW_COLUMNS[table], keep=[LANDED] if landed else [])


def load_new_files(
    spark: SparkSession, folder: str, table: str, target: str, checkpoint: str
) -> StreamingQuery:
    """Start a run over the files that landed since the last run.

    Each batch has a folder of its own in the target tables, so a batch that is
    repeated after a failure replaces itself.
    """

    def write_batch(raw: DataFrame, batch: int) -> None:
        for name, df in spec(SOURCE, table).run(raw).items():
            path = f"{target.rstrip('/')}/{name}/batch={batch}"
            for_sink(df, name).write.mode("overwrite").parquet(path)

    return (
        stream_list(spark, folder, table)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{table}")
        .trigger(availableNow=True)
        .start()
    )


def last_landed(raw: DataFrame, key: str) -> DataFrame:
    """Of each id, the rows of the file that landed last.

    Most ids stand in one file, which numbers alone tell; only the others are compared by
    the time and path of their files.
    """
    own, path = F.col(key), F.col(f"{LANDED}.file_path")
    marks = [F.col(f"{LANDED}.file_modification_time"), F.xxhash64(path), F.xxhash64(F.lit(1), path)]
    ends = [f(m).alias(f"_{f.__name__}{i}") for i, m in enumerate(marks) for f in (F.min, F.max)]
    unlike = " OR ".join(f"_min{i} <> _max{i}" for i in range(len(marks)))
    written = shared_folder(raw.sparkSession)
    raw.groupBy(own.alias("_key")).agg(*ends).where(unlike).select("_key").write.parquet(written)
    several = raw.sparkSession.read.parquet(written)
    if several.isEmpty():
        return raw
    again = raw.join(several, own.eqNullSafe(F.col("_key")), "left_semi")
    newest = again.groupBy(own.alias("_key")).agg(F.max(LANDED).alias("_newest"))
    marked = raw.join(newest, own.eqNullSafe(F.col("_key")), "left")
    return marked.where(F.col("_newest").isNull() | (F.col(LANDED) == F.col("_newest")))


def merge_new_files(
    spark: SparkSession, folder: str, table: str, target: str, checkpoint: str, ranges: int = 64
) -> StreamingQuery:
    """Start a run in which the rows of each id that landed replace what is stored of that id.

    `target` is a versioned set of tables. Where files of one batch hold the same id, the rows
    of the file that landed last count. The tables of an id are replaced together: a name list
    that has become empty loses its stored rows. A batch is one commit, which also remembers
    the batch, so a batch that is repeated after a failure changes nothing. Only ranges of ids
    with a change are written.
    """
    one, key = spec(SOURCE, table), fv.KEGG_RAW_COLUMNS[table][0]
    if table == "gene_disease":
        raise ValueError("either field of gene_disease may hold the gene, so no field is its id")
    stream = f"{SOURCE}/{table}@{checkpoint.rstrip('/')}"

    def merge(raw: DataFrame, batch: int) -> None:
        change = TableSet(spark, target).change()
        done = change.remembered("stream", stream)
        if done and done.batch >= batch:
            return
        path = shared_folder(spark)
        last_landed(raw, key).select(*fv.KEGG_RAW_COLUMNS[table]).write.parquet(path)
        made = one.run(spark.read.parquet(path))
        main = next((df for name, df in made.items() if name in fv.PRIMARY_KEYS), None)
        with change:
            for name, df in made.items():
                own = df.columns[0]
                if change.parts(name):
                    # A main or link table has a row of each id that came.
                    came = None if main is None or df is main else main.select(own)
                    update_ranged(change, df, name, own, came)
                else:
                    save_ranged(change, df, name, own, ranges)
            change.remember("stream", stream, batch=batch)

    return (
        stream_list(spark, folder, table, landed=True)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{table}")
        .trigger(availableNow=True)
        .start()
    )
