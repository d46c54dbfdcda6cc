"""Refresh of whole tables: landed files in, target tables out."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.operators.dealing import dealt
from codonmill.operators.ordering import ordered_by
from codonmill.operators.quality import all_checks, surplus_check, unknown_check
from codonmill.plans.incremental import replace_keys, upsert
from codonmill.plans.layout import LaidOut, by_gene, lay_out
from codonmill.plans.registry import REGISTRY, TableSpec, spec
from codonmill.schemas import for_sink, full_name
from codonmill.session import build_session, shared_folder, size_shuffles
from codonmill.sources.delimited import SURPLUS, placed
from codonmill.sources.docsum import RESCUED, rescued_fields, union_pages
from codonmill.sources.landing import claimed_files, file_changes, listing
from codonmill.sources.sinks import write_table
from codonmill.sources.stage import load_stage, save_stage
from codonmill.sources.versions import Change, TableSet


class Pipeline:
    """Extract, transform and load the tables of one source.

    `raw` and `processed` hold the frames of the tables handled so far; they are
    plans, and nothing of their content is kept in memory.

    With `versioned`, the target is a set of versions (`sources.versions`): a refresh shows
    all its tables at once when it has ended well, and nothing when it fails. With a `stage`
    folder, what another session has staged there is taken where this one has not read or
    made a table itself.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        landing: str,
        target: str | None = None,
        stage: str | None = None,
        versioned: bool = False,
    ):
        if source not in REGISTRY:
            raise ValueError(f"unknown source {source!r}; known are {sorted(REGISTRY)}")
        self.spark, self.source = spark, source
        self.landing, self.target = landing, target
        self._stage = stage
        if versioned and target is None:
            raise ValueError("versions need a target folder")
        self.tables = TableSet(spark, target) if versioned else None
        self._landed: dict[str | None, list[str]] | None = None
        self.raw: dict[str, DataFrame] = {}
        self.processed: dict[str, DataFrame] = {}

    def extract(self, table: str, paths: list[str] | None = None) -> DataFrame:
        """Raw rows of all files landed for the table, or of those given."""
        chosen = spec(self.source, table)
        paths = self.landed().get(table, []) if paths is None else paths
        if not paths:
            raise FileNotFoundError(f"nothing landed for {self.source} {table} in {self.landing}")
        parquet = [path for path in paths if path.endswith(".parquet")]
        other = [path for path in paths if not path.endswith(".parquet")]
        pages = [chosen.read(self.spark, other)] if other else []
        if parquet:
            pages.append(placed(self.spark.read.parquet(*parquet)))
        self.raw[table] = union_pages(pages)
        return self.raw[table]

    def landed(self) -> dict[str | None, list[str]]:
        """Landed paths by table, under None those that no table claims; listed once."""
        if self._landed is None:
            self._landed = claimed_files(self.spark, self.landing, self.source, REGISTRY[self.source])
        return self._landed

    def transform(self, table: str, raw: DataFrame | None = None) -> dict[str, DataFrame]:
        """Processed tables of raw rows: those given or read, else those staged, else those landed."""
        chosen = spec(self.source, table)
        if raw is None and table not in self.raw:
            raw = self.raw[table] = self._from_stage(table, "raw")
            raw = self.extract(table) if raw is None else raw
        made = chosen.run(self.raw[table] if raw is None else raw)
        self.processed.update(made)
        return made

    def save(self, name: str) -> str:
        """Put a raw or processed table of this session into the stage folder."""
        if self._stage is None:
            raise ValueError("no stage folder was given")
        if name in self.raw:
            return save_stage(self.raw[name], self._stage, name, self.source, kind="raw")
        short = name.removeprefix(full_name(self.source, ""))
        return save_stage(self.processed[name], self._stage, short, self.source)

    def _from_stage(self, table: str, kind: str) -> DataFrame | None:
        if self._stage is None:
            return None
        try:
            return load_stage(self.spark, self._stage, table, self.source, kind=kind)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _made(self, name: str) -> DataFrame:
        """A processed table: of this session, else staged, else made from its raw table."""
        if name not in self.processed:
            owner = next(
                (one for one in REGISTRY[self.source].values() if name in self._outputs(one)), None
            )
            if owner is None:
                raise KeyError(f"no {self.source} table makes {name!r}")
            staged = self._from_stage(name.removeprefix(full_name(self.source, "")), "processed")
            if staged is None:
                self.transform(owner.name)
            else:
                self.processed[name] = staged
        return self.processed[name]

    def _outputs(self, one: TableSpec) -> list[str]:
        return [full_name(self.source, short) for short in one.jobs]

    def load(self, name: str, overwrite: bool = False, change: Change | None = None) -> str:
        """Write one processed table, to the target folder or to the catalog.

        `processed` then holds the written table, not the plan that made it. In a versioned
        target the table shows with `change`, or at once where none is given.
        """
        df = self._made(name)
        for chosen in REGISTRY[self.source].values():
            if chosen.order_by and chosen.order_by[0] == name:
                df = ordered_by(df, chosen.order_by[1])
        if self.tables is not None:
            if change is None:
                with self.tables.change() as own:
                    return self.load(name, overwrite, own)
            where = change.write(df, name, overwrite)
            self.processed[name] = self.spark.read.parquet(where)
            return where
        where = write_table(df, name, self.target, overwrite)
        read = self.spark.table if self.target is None else self.spark.read.parquet
        self.processed[name] = read(where)
        return where

    def refresh(
        self,
        tables: Iterable[str] = (),
        load: bool | None = None,
        overwrite: bool = True,
        at_once: int = 4,
        changed_only: bool = False,
    ) -> dict[str, str]:
        """Refresh the given tables, or all of the source; paths by full table name.

        Loads by default where a target is set. `at_once` raw tables are worked on
        side by side, so that small ones do not leave the cluster idle. With `changed_only`,
        which needs versions, only tables whose files have changed since they were last
        refreshed are written: rows of new files are added where no other file has changed
        and the table's jobs allow it, else the table is made anew.
        """
        load = self.target is not None if load is None else load
        self._landed = None
        chosen = [spec(self.source, name) for name in (list(tables) or REGISTRY[self.source])]
        if self.tables is None or not load:
            if changed_only:
                raise ValueError("only a versioned target remembers which files it was made of")
            return self._refresh_all(chosen, at_once, lambda one: self._refresh_one(one, load, overwrite))
        with self.tables.change() as change:
            now = listing(self.spark, self.landing, self.source, REGISTRY[self.source])
            files: dict[str, list[str] | None] = {one.name: None for one in chosen}
            if changed_only:
                files = self._changed_files(change, now, chosen)
            busy = [one for one in chosen if one.name in files and self.landed().get(one.name)]
            written = self._refresh_all(
                busy,
                at_once,
                lambda one: self._refresh_one(one, True, overwrite and files[one.name] is None, change, files[one.name]),
            )
            for one in chosen:
                if one.name in files and one not in busy:
                    if not changed_only:
                        self.extract(one.name)
                    for name in self._outputs(one):
                        change.put(name, [], alone=True)
            if files:
                path = change.folder("landing")
                now.write.parquet(path)
                for name in files:
                    change.remember("landing", f"{self.source}/{name}", data=path)
        return written

    def _refresh_all(
        self, chosen: list[TableSpec], at_once: int, one_table: Callable[[TableSpec], dict[str, str]]
    ) -> dict[str, str]:
        written: dict[str, str] = {}
        with ThreadPoolExecutor(at_once) as pool:
            # A failed table's error comes out here, after the others have ended.
            for paths in pool.map(one_table, chosen):
                written.update(paths)
        return written

    def _changed_files(
        self, change: Change, now: DataFrame, chosen: list[TableSpec]
    ) -> dict[str, list[str] | None]:
        """Of the tables whose files have changed, the new files, or None where all are to be read."""
        known = {one.name: change.remembered("landing", f"{self.source}/{one.name}") for one in chosen}
        before = [
            self.spark.read.parquet(entry.data).where(F.col("table") == name) for name, entry in known.items() if entry
        ]
        files: dict[str, list[str] | None] = {name: None for name, entry in known.items() if not entry}
        if not before:
            return files
        seen = now.where(F.col("table").isin([name for name, entry in known.items() if entry]))
        found = file_changes(seen, reduce(DataFrame.unionByName, before))
        for row in found.groupBy("table").agg(
            F.count_if(F.col("change") == "gone").alias("gone"),
            F.collect_list(F.when(F.col("change") == "added", F.col("path"))).alias("added"),
        ).take(len(known)):
            one = spec(self.source, row["table"])
            apart = not row["gone"] and not one.whole and not one.order_by
            files[one.name] = [unquote(path) for path in row["added"]] if apart else None
        return files

    def _refresh_one(
        self,
        one: TableSpec,
        load: bool,
        overwrite: bool,
        change: Change | None = None,
        paths: list[str] | None = None,
    ) -> dict[str, str]:
        raw = self.extract(one.name, paths)
        staged = load and one.stage
        if one.keep:
            raw = one.keep(raw)
            if not staged:
                # Adaptive execution sizes the partitions by what the filter has left.
                raw = dealt(raw)
        if staged:
            # Scans of the staged files pack small ones, so its rows are not shuffled for that.
            raw = self._staged(one, raw)
        self.raw[one.name] = raw
        made = self.transform(one.name, raw)
        return {name: self.load(name, overwrite, change) for name in made} if load else {}

    def lay_out(self, buckets: int, folder: str) -> dict[str, LaidOut]:
        """Lay the processed tables that name genes out by gene, as catalog tables `…_by_gene`.

        Tables of both sources join without an exchange if laid out in one number of buckets.
        """
        made = {}
        for name, df in self.processed.items():
            chosen = by_gene(df, name)
            if chosen is not None:
                made[name] = lay_out(chosen[0], f"{name}_by_gene", chosen[1], buckets, folder)
        return made

    def violations(self) -> DataFrame:
        """Broken keys, references, widths, types and missing values of what is processed."""
        loose: dict[str, DataFrame] = {}
        surplus = []
        for table, raw in self.raw.items():
            loose.update(spec(self.source, table).loose(raw))
            if SURPLUS in raw.columns:
                surplus.append(surplus_check(raw, full_name(self.source, table), SURPLUS))
            if RESCUED in raw.columns:
                surplus.append(unknown_check(rescued_fields(raw), full_name(self.source, table)))
        return union_pages([all_checks(self.processed, loose), *surplus])

    def update(self, name: str, previous: str) -> str:
        """Write the target table as its last version with new and changed records put in.

        `previous` is the folder of that version; the target must be another, since
        the one is read while the other is written. In a table with a primary key
        only changed rows take the place of stored ones. In others, lookups and
        links, all rows of each id that came in replace the stored rows of that id. For a
        lookup these are the ids of the table it belongs to, so that an id whose list has
        become empty loses its stored rows.
        """
        if self.target is None or previous.rstrip("/") == self.target.rstrip("/"):
            raise ValueError("an update needs a target folder that is not the previous one")
        stored = self.spark.read.parquet(f"{previous.rstrip('/')}/{name}")
        incoming = for_sink(self.processed[name], name)
        if name in fv.PRIMARY_KEYS:
            merged = upsert(stored, incoming, fv.PRIMARY_KEYS[name])
        else:
            key = incoming.columns[0]
            main = self._main_table(name)
            came = self.processed[main] if main in self.processed else incoming
            merged = replace_keys(stored, incoming, key, came.select(key))
        return write_table(merged, name, self.target, True)

    def _main_table(self, name: str) -> str | None:
        """Of the tables that one raw table makes, the one with its primary key."""
        for one in REGISTRY[self.source].values():
            if name in self._outputs(one):
                return next((table for table in self._outputs(one) if table in fv.PRIMARY_KEYS), None)
        return None

    def _staged(self, one: TableSpec, raw: DataFrame) -> DataFrame:
        self._stage = self._stage or shared_folder(self.spark)
        save_stage(raw, self._stage, one.name, self.source, kind="raw")
        return load_stage(self.spark, self._stage, one.name, self.source, kind="raw")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Refresh the tables of one source.")
    parser.add_argument("source", choices=sorted(REGISTRY))
    parser.add_argument("tables", nargs="*", help="tables to refresh; all if none is given")
    parser.add_argument("--landing", required=True, help="folder of the landed files")
    parser.add_argument("--target", help="folder for the tables; the catalog if left out")
    parser.add_argument("--append", action="store_true", help="add to the tables, do not replace")
    parser.add_argument("--versioned", action="store_true", help="show all tables at once when all are written")
    parser.add_argument("--changed", action="store_true", help="only tables whose files have changed; needs --versioned")
    parser.add_argument("--buckets", type=int, help="also lay tables out by gene in so many buckets; needs --target")
    parser.add_argument("--check", action="store_true", help="print violations after the refresh")
    args = parser.parse_args(argv)
    if args.buckets and not args.target:
        parser.error("--buckets needs --target")

    spark = build_session(f"refresh {args.source}")
    size_shuffles(spark, args.landing)
    pipeline = Pipeline(spark, args.source, args.landing, args.target, versioned=args.versioned)
    written = pipeline.refresh(args.tables, load=True, overwrite=not args.append, changed_only=args.changed)
    for name, where in written.items():
        print(f"{name}\t{where}")
    if args.buckets:
        pipeline.lay_out(args.buckets, f"{args.target.rstrip('/')}/by_gene")
    for path in pipeline.landed().get(None, []):
        print(f"no table\t{path}")
    if args.check:
        pipeline.violations().show(100, truncate=False)


if __name__ == "__main__":
    main()
