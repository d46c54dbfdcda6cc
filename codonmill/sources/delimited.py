"""Tab-separated extracts.

Fields are taken as written: no quoting, no missing-value words, empty text stays
empty text, and a field that a short line lacks is NULL. Lines without any text
are skipped. Columns are projected straight from the text scan, so unused fields
are never materialised.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.operators.dealing import dealt

TAB = "\t"
POSITION = ["SRC_FILE", "SRC_BLOCK", "SRC_ROW"]
SURPLUS = "SRC_SURPLUS"
#: Jobs that read headers side by side.
HEADERS_AT_ONCE = 8


def read_tab_list(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    position: bool = False,
    surplus: bool = False,
) -> DataFrame:
    """Headerless list; names are given by position.

    With `position`, columns tell where each line stood: file, block of the file
    and an increasing number within the block. With `surplus`, a column holds the fields
    beyond the named ones, NULL where there are none.
    """
    return fields(_lines(spark, path), columns, position, surplus)


def fields(
    lines: DataFrame,
    columns: Sequence[str],
    position: bool = False,
    surplus: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Project named fields from a frame of text lines, batch or streaming; `keep` its other columns."""
    parts = F.split("value", TAB, -1)
    picked = [F.get(parts, F.lit(i)).alias(name.upper()) for i, name in enumerate(columns)]
    if surplus:
        beyond = F.slice(parts, len(columns) + 1, F.greatest(F.size(parts) - len(columns), F.lit(1)))
        picked.append(F.when(F.size(parts) > len(columns), beyond).alias(SURPLUS))
    return lines.select(*picked, *keep, *(_position() if position else []))


def read_tab_header(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    spread: bool = True,
) -> DataFrame:
    """List whose first line names the columns; every file has such a line of its own.

    Files may name their columns in different orders or lack some: rows are read by the
    header of their file, and columns that it lacks are NULL. The header of each file is read
    by a job of its own, which goes no further than that line. A gzip file is one task however large it is. With `spread`, fewer files than
    the session has slots are dealt out again after parsing and before any work
    that multiplies rows.
    """
    files = [unquote(file) for file in _lines(spark, path).inputFiles()]
    layouts: dict[str, list[str]] = {}
    for file, header in zip(files, _first_lines(spark, files), strict=True):
        if header is not None:
            layouts.setdefault(header, []).append(file)
    if not layouts:
        raise ValueError(f"no header line in {path}")
    wanted = {c.upper() for c in columns} if columns else None
    parts = F.split("value", TAB, -1)
    names = list(dict.fromkeys(name for header in sorted(layouts) for name in header.split(TAB)))
    names = [name for name in names if wanted is None or name.upper() in wanted]
    pages = []
    for header in sorted(layouts):
        own = {name: i for i, name in enumerate(header.split(TAB))}
        fields = [
            (F.get(parts, F.lit(own[name])) if name in own else F.lit(None).cast("string")).alias(name) for name in names
        ]
        pages.append(_lines(spark, layouts[header]).where(F.col("value") != header).select(*fields))
    df = reduce(DataFrame.unionAll, pages)
    slots = spark.sparkContext.defaultParallelism
    if spread and len(files) < slots:
        df = dealt(df, slots)
    return df


def read_tab_generic(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Headerless list without known names: `_c0`, `_c1`, … as many as the widest line has."""
    lines = _lines(spark, path)
    parts = F.split("value", TAB, -1)
    width = lines.agg(F.max(F.size(parts))).first()[0] or 1
    return lines.select(*[F.get(parts, F.lit(i)).alias(f"_c{i}") for i in range(width)])


def read_reactome(spark: SparkSession, folder: str, extract: str) -> DataFrame:
    """One of the pathway-mapping extracts, which come without column names."""
    if extract not in fv.REACTOME_FILES:
        raise ValueError(f"unknown extract {extract!r}; known are {list(fv.REACTOME_FILES)}")
    return read_tab_generic(spark, f"{folder.rstrip('/')}/{fv.REACTOME_FILES[extract]}")


def _first_lines(spark: SparkSession, files: Sequence[str]) -> list[str | None]:
    """First line of each file. An aggregate over a gzip file would read, and may hold, all of it."""

    def first(path: str) -> str | None:
        row = _lines(spark, path).where(F.col("_metadata.file_block_start") == 0).first()
        return row and row["value"]

    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        return list(pool.map(first, files))


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths).where(F.col("value") != "")


def placed(rows: DataFrame) -> DataFrame:
    """Rows of landed files with columns that tell where each stood."""
    return rows.select("*", *_position())


def _position() -> list[Column]:
    file, block, row = POSITION
    return [
        F.col("_metadata.file_path").alias(file),
        F.col("_metadata.file_block_start").alias(block),
        F.monotonically_increasing_id().alias(row),
    ]
