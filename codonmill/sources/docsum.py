"""Document-summary records, as XML or as JSON lines.

A directory of pages is one table: one scan reads all of them, and fields that a
page lacks are NULL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codonmill import fixed_values as fv
from codonmill.operators.columns import upper_columns

RECORD = "DocumentSummary"

XML_DDL = {"gene_summary": fv.GENE_SUMMARY_XML_DDL, "snp_summary": fv.SNP_SUMMARY_XML_DDL}
RAW_DDL = {"gene_summary": fv.GENE_SUMMARY_RAW_DDL, "snp_summary": fv.SNP_SUMMARY_RAW_DDL}


def read_docsum_xml(
    spark: SparkSession, path: str | Sequence[str], table: str, rescue: bool = False
) -> DataFrame:
    """Records with their `uid` attribute as a column and wrapper elements unpacked.

    The schema is explicit: identifiers stay text. With `rescue`, a column holds the elements
    of a record that the schema does not name, see `RESCUED`.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.format("xml").option("rowTag", RECORD)
    schema = T.StructType.fromDDL(XML_DDL[table])
    known = {f.name.lower() for f in schema.fields}
    others: list[str] = []
    if rescue:
        # One pass over the files finds the names.
        every = reader.option("inferSchema", "false").load(paths).columns
        others = [name for name in every if name.lower() not in known]
    whole = T.StructType([*schema.fields, *[T.StructField(name, T.StringType()) for name in others]])
    records = reader.schema(whole).load(paths)
    columns = [_unpack(f.name).alias("UID" if f.name == "_uid" else f.name.upper()) for f in schema.fields]
    if rescue:
        entries = [F.struct(F.lit(name).alias("key"), F.col(f"`{name}`").alias("value")) for name in others]
        listed = F.filter(F.array(*entries), lambda e: e["value"].isNotNull()) if others else None
        columns.append((F.lit(None).cast("variant") if listed is None else _rescued(listed)).alias(RESCUED))
    return records.select(*columns)


def read_docsum_json(
    spark: SparkSession,
    path: str | Sequence[str],
    table: str,
    schema: str | None = None,
    rescue: bool = False,
) -> DataFrame:
    """Records as JSON lines.

    Each field of each record may be spelled in upper case, in lower case or as the XML
    elements are, nested fields too. A `schema` of the caller's own is taken as it is. With `rescue`, a column holds
    the fields of a record that have none of the names, see `RESCUED`.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if schema is not None:
        return upper_columns(spark.read.schema(schema).json(paths))
    titles = {name.lower(): name for name in re.findall(r"(\w+):?\s", f"{XML_DDL[table]} ".replace(":", ": "))}
    lines = spark.read.text(paths).where("trim(value) <> ''")
    kind = T.StructType.fromDDL(RAW_DDL[table])
    # A parser for each spelling, as one schema cannot hold names that differ in case alone.
    ways = [str.upper, str.lower, lambda name: titles.get(name.lower(), name)]
    parsed = lines.select(
        "value",
        *[
            F.from_json("value", T.StructType([T.StructField(way(f.name), _flat(f.dataType)) for f in kind.fields])).alias(f"_{i}")
            for i, way in enumerate(ways)
        ],
    )
    records = [F.col(f"_{i}") for i in range(len(ways))]
    columns = [_field(records, f).alias(f.name) for f in kind.fields]
    if rescue:
        every = F.map_entries(F.from_json("value", "map<string,string>"))
        known = [f.name.upper() for f in kind.fields]
        columns.append(_rescued(F.filter(every, lambda e: ~F.upper(e["key"]).isin(known))).alias(RESCUED))
    return parsed.select(*columns)


#: A VARIANT: the fields of a record that no column has, as a list of NAME and VALUE (text), NULL
#: if there are none.
RESCUED = "RESCUED"


def _rescued(entries: Column) -> Column:
    """A list of (key, value) as a variant, sorted so that it does not tell the order of the source."""
    named = F.transform(entries, lambda e: F.struct(e["key"].alias("NAME"), e["value"].alias("VALUE")))
    return F.when(F.size(entries) > 0, F.parse_json(F.to_json(F.array_sort(named))))


def rescued_fields(records: DataFrame, *keys: str) -> DataFrame:
    """(keys…, NAME, VALUE): one row per rescued field."""
    listed = F.variant_get(RESCUED, "$", "array<struct<NAME:string,VALUE:string>>")
    return records.where(F.col(RESCUED).isNotNull()).select(*keys, F.inline(listed))


def _field(records: list[Column], field: T.StructField) -> Column:
    """One field with its type, of the record parsed by whichever spelling has it."""
    value, kind = F.coalesce(*[one.getField(field.name) for one in records]), field.dataType
    if isinstance(kind, T.StructType):
        return _renamed(F.from_json(value, "map<string,string>"), kind)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        listed = F.from_json(value, "array<map<string,string>>")
        return F.transform(listed, lambda one: _renamed(one, kind.elementType))
    return value if isinstance(kind, (T.StringType, T.ArrayType)) else value.try_cast(kind)


def _flat(kind: T.DataType) -> T.DataType:
    """What a field is parsed as: text, or a list of texts; records within it stay text."""
    listed = isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, T.StructType)
    return T.ArrayType(T.StringType()) if listed else T.StringType()


def _renamed(entries: Column, kind: T.StructType) -> Column:
    """A struct from a map whose keys have any of the spellings."""
    named = F.transform(F.map_entries(entries), lambda e: F.struct(F.upper(e["key"]).alias("k"), e["value"]))
    of = lambda name: F.get(F.filter(named, lambda e: e["k"] == name.upper()), F.lit(0))["value"]
    picked = F.struct(*[of(f.name).try_cast(f.dataType).alias(f.name) for f in kind.fields])
    return F.when(entries.isNotNull(), picked)


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """All rows of all pages, columns matched by name, absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def _unpack(name: str) -> Column:
    if name == "Mim":
        return F.col("Mim.int")
    if name == "GenomicInfo":
        return F.col("GenomicInfo.GenomicInfoType")
    if name == "GENES":
        # The job reads genes as the text of a list of records.
        return F.to_json("GENES.GENE_E")
    return F.col(name)
