"""Target tables as a set that changes all at once.

Data is written into new folders beside those in use. A commit is one small JSON file that
names the folders of every table; it appears by a single rename, and readers take the commit
with the highest number. A job that fails before its commit has changed nothing that a
reader sees, and a commit shows the new state of all its tables together.

The driver holds one entry per table and range of a table. Old folders stay readable by
commit number until they are removed; `unreferenced` lists what no recent commit names.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codonmill.schemas import for_sink

#: Entries of a commit, which the driver holds.
MOST_ENTRIES = 1_000_000
ENTRY = "kind string, name string, part int, low string, data string, digests string, batch long"


@dataclass(frozen=True)
class Entry:
    """One folder of a table (`kind` table), or what a commit remembers beside tables.

    A table in ranges of its key has an entry per range: `low` is its lowest key, None for
    the first, and `digests` the folder of its keys' digests.
    """

    kind: str
    name: str
    part: int | None = None
    low: str | None = None
    data: str | None = None
    digests: str | None = None
    batch: int | None = None


class Conflict(RuntimeError):
    """Another commit came first."""


class TableSet:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(f"{ENTRY}, commit long").json(f"{self.base}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def latest(self) -> int:
        """Number of the last commit, 0 if there is none."""
        commits = self._commits()
        return 0 if commits is None else commits.agg(F.max("commit")).first()[0] or 0

    def entries(self, number: int | None = None) -> list[Entry]:
        commits, number = self._commits(), number or self.latest()
        if commits is None:
            return []
        rows = commits.where(F.col("commit") == number).drop("commit").take(MOST_ENTRIES + 1)
        if len(rows) > MOST_ENTRIES:
            raise ValueError(f"a commit of {self.base} has more than {MOST_ENTRIES} entries")
        return [Entry(**row.asDict()) for row in rows]

    def tables(self, number: int | None = None) -> list[str]:
        return sorted({e.name for e in self.entries(number) if e.kind == "table"})

    def parts(self, table: str, number: int | None = None) -> list[Entry]:
        """The table's entries by part."""
        mine = [e for e in self.entries(number) if e.kind == "table" and e.name == table]
        return sorted(mine, key=lambda e: e.part or 0)

    def read(self, table: str, number: int | None = None) -> DataFrame:
        """The table as of a commit, the last one by default."""
        parts = self.parts(table, number)
        if not parts:
            raise KeyError(f"no table {table!r} in {self.base}")
        return self.spark.read.parquet(*[e.data for e in parts if e.data])

    def change(self) -> Change:
        return Change(self)

    def unreferenced(self, keep: int = 2) -> DataFrame:
        """(path, length) of data files that none of the last `keep` commits names."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{self.base}/data")
        listed = files.select("path", "length", F.regexp_extract("path", r"/data/([0-9a-f]{32})/", 1).alias("run"))
        commits = self._commits()
        recent = commits.where(F.col("commit") > self.latest() - keep)
        named = recent.select(F.explode(F.array("data", "digests")).alias("folder"))
        runs = named.select(F.regexp_extract("folder", r"/data/([0-9a-f]{32})/", 1).alias("run")).distinct()
        return listed.join(runs, "run", "left_anti").select("path", "length")


class Change:
    """What one commit will show. Left by an error, it shows nothing.

    with tables.change() as change:
        change.write(df, "kegg_human_gene")
    """

    def __init__(self, tables: TableSet):
        self.tables, self.spark = tables, tables.spark
        self.number = tables.latest()
        self._entries = {_key(e): e for e in tables.entries(self.number)} if self.number else {}

    def __enter__(self) -> Change:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()

    def folder(self, name: str) -> str:
        """A new folder for data."""
        return f"{self.tables.base}/data/{uuid.uuid4().hex}/{name}"

    def write(self, df: DataFrame, table: str, overwrite: bool = True) -> str:
        """Write the rows, to stand in place of the table's or beside them."""
        path = self.folder(table)
        for_sink(df, table).write.parquet(path)
        number = 0 if overwrite else 1 + max((e.part or 0 for e in self.parts(table)), default=-1)
        self.put(table, [Entry("table", table, number, data=path)], overwrite)
        return path

    def put(self, table: str, parts: list[Entry], alone: bool = False) -> None:
        """Let entries be the table's, alone or in place of those with their part numbers."""
        kept = [] if alone else [e for e in self.parts(table) if e.part not in {p.part for p in parts}]
        self._entries = {k: e for k, e in self._entries.items() if k[:2] != ("table", table)}
        self._entries |= {_key(e): e for e in [*kept, *parts]}

    def parts(self, table: str) -> list[Entry]:
        return [e for e in self._entries.values() if e.kind == "table" and e.name == table]

    def remembered(self, kind: str, name: str) -> Entry | None:
        return self._entries.get((kind, name, None))

    def remember(self, kind: str, name: str, **what) -> None:
        """Keep something beside the tables, such as the last batch of a stream."""
        entry = replace(self.remembered(kind, name) or Entry(kind, name), **what)
        self._entries[_key(entry)] = entry

    def commit(self) -> int:
        """Show the change, or raise `Conflict` if the set has changed since it began."""
        rows = [tuple(asdict(e).values()) for e in self._entries.values()]
        listed = self.spark.createDataFrame(rows, ENTRY).coalesce(1)
        number = self.number + 1
        while True:
            try:
                # A single file: it is there wholly or not at all.
                listed.write.mode("error").json(f"{self.tables.base}/commits/commit={number}")
                self.number = number
                return number
            except AnalysisException as error:
                if error.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
                if self.tables.latest() >= number:
                    raise Conflict(f"commit {number} of {self.tables.base} was made by another job") from error
                # A commit that broke off left its folder.
                number += 1


def _key(entry: Entry) -> tuple:
    return entry.kind, entry.name, entry.part
