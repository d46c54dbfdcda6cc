"""Queries that go the whole way: landed files, readers, refresh, written tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.functions import names, positions
from codonmill.plans.incremental import upsert
from codonmill.plans.refresh import Pipeline
from codonmill.schemas import full_name, rules
from codonmill.session import shared_folder
from codonmill.sources.delimited import SURPLUS, read_tab_generic, read_tab_header, read_tab_list
from codonmill.sources.docsum import read_docsum_json, rescued_fields
from harness import shapes

#: Processed tables by the name of their job's query: source, raw table, output.
JOB_OUTPUTS = {
    "t02_gene": ("kegg", "gene", "gene"),
    "t02_gene_symbol_lookup": ("kegg", "gene", "gene_symbol_lookup"),
    "t03_disease": ("kegg", "disease", "disease"),
    "t03_disease_name_lookup": ("kegg", "disease", "disease_name_lookup"),
    "t04_variant": ("kegg", "variant", "variant"),
    "t05_module": ("kegg", "module", "module"),
    "t05_module_name_lookup": ("kegg", "module", "module_name_lookup"),
    "t06_pathway_gene": ("kegg", "pathway_gene", "pathway_gene_lookup"),
    "t06_pathway_module": ("kegg", "pathway_module", "pathway_module_lookup"),
    "t06_pathway_disease": ("kegg", "pathway_disease", "pathway_disease_lookup"),
    "t06_gene_disease": ("kegg", "gene_disease", "gene_disease_lookup"),
    "t06_ncbi_gene": ("kegg", "ncbi_gene", "ncbi_gene_lookup"),
    "t07_gene_info": ("ncbi", "gene_info", "gene_info"),
    "t07_gene_info_symbol_lookup": ("ncbi", "gene_info", "gene_info_symbol_lookup"),
    "t07_gene_info_dbxref_lookup": ("ncbi", "gene_info", "gene_info_dbxref_lookup"),
    "t07_gene_info_otherdesig_lookup": ("ncbi", "gene_info", "gene_info_otherdesig_lookup"),
    "t07_gene_info_feature_lookup": ("ncbi", "gene_info", "gene_info_feature_lookup"),
    "t08_gene_orthologs": ("ncbi", "gene_orthologs", "gene_orthologs"),
    "t09_gene2go": ("ncbi", "gene2go", "gene2go"),
    "t10_gene_summary": ("ncbi", "gene_summary", "gene_summary"),
    "t10_gene_summary_symbol_lookup": ("ncbi", "gene_summary", "gene_summary_symbol_lookup"),
    "t10_gene_summary_omim_lookup": ("ncbi", "gene_summary", "gene_summary_omim_lookup"),
    "t11_snp_summary": ("ncbi", "snp_summary", "snp_summary"),
    "t11_snp_summary_gene_lookup": ("ncbi", "snp_summary", "snp_summary_gene_lookup"),
    "t11_snp_summary_fxn_lookup": ("ncbi", "snp_summary", "snp_summary_fxn_lookup"),
    "t11_snp_summary_ss_lookup": ("ncbi", "snp_summary", "snp_summary_ss_lookup"),
}


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


#: Records of a landed page. XML and gzip files cannot be split, so a page bounds what one task reads.
PAGE_RECORDS = 50_000


def land_xml(df: DataFrame, path: str) -> None:
    """Write records as XML pages."""
    tags = {"rowTag": "DocumentSummary", "rootTag": "DocumentSummarySet"}
    df.write.format("xml").options(maxRecordsPerFile=PAGE_RECORDS, **tags).save(path)


def land_json(df: DataFrame, path: str) -> None:
    """Write records as gzip pages of JSON lines."""
    df.write.options(maxRecordsPerFile=PAGE_RECORDS, compression="gzip").json(path)


def land_lines(df: DataFrame, path: str, header: bool = False, compression: str = "none") -> None:
    """Write rows as tab-separated lines; they hold no tabs and no missing values."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    if header:
        # No character starts a comment, so that the leading # of a name stays bare.
        text.write.options(
            header="true", sep="\t", comment="\u0002", emptyValue="", compression=compression
        ).csv(path)
    else:
        line = F.concat_ws("\t", *[F.col(f"`{c}`") for c in text.columns])
        text.select(line.alias("value")).write.option("compression", compression).text(path)


def land(spark: SparkSession, sf_dir: str, source: str, table: str, folder: str) -> None:
    """One raw table as its source gives it: lines, gzip with header, or JSON records."""
    path = f"{folder}/{source}_human_{table}"
    has_header = source == "ncbi" and table not in ("gene_summary", "snp_summary")
    raw = shapes.raw(spark, sf_dir, table, spread=has_header)
    if source == "kegg":
        land_lines(raw, path)
    elif table == "gene_summary":
        info = "array<struct<CHRSTART:int,CHRSTOP:int,EXONCOUNT:int>>"
        land_json(raw.withColumn("GENOMICINFO", F.col("GENOMICINFO").cast(info)), path)
    elif table == "snp_summary":
        land_json(raw, path)
    else:
        land_lines(raw, path, header=True, compression="gzip")


def refreshed(spark: SparkSession, sf_dir: str, source: str, table: str, output: str) -> DataFrame:
    """The rows of one written table."""
    landing, target = shared_folder(spark), shared_folder(spark)
    land(spark, sf_dir, source, table, landing)
    name = full_name(source, output)
    written = Pipeline(spark, source, landing, target).refresh([table])
    kinds = [F.col(rule.name).cast(rule.type).alias(rule.name) for rule in rules(name)]
    return spark.read.parquet(written[name]).select(*kinds)


def s01_ragged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short, long, empty and quoted lines."""
    path = shared_folder(spark)
    kind = F.col("o_orderkey") % 5
    line = (
        F.when(kind == 0, F.lit(""))
        .when(kind == 1, F.col("o_orderkey").cast("string"))
        .when(kind == 2, F.concat_ws("\t", "o_orderkey", "o_orderstatus", "o_orderpriority", F.lit("")))
        .when(kind == 3, F.concat(F.lit('"'), F.col("o_orderkey"), F.lit('\t"'), F.col("o_orderstatus")))
        .otherwise(F.concat_ws("\t", "o_orderkey", "o_orderstatus"))
    )
    orders(spark, sf_dir).select(line.alias("value")).write.text(path)
    rows = read_tab_list(spark, path, ["ONE", "TWO"], surplus=True)
    return rows.select("ONE", "TWO", F.array_join(SURPLUS, "|").alias("MORE"))


S1_RAGGED = """
SELECT CASE WHEN k = 3 THEN '"' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS ONE,
  CASE WHEN k = 1 THEN NULL WHEN k = 3 THEN '"' || o_orderstatus ELSE o_orderstatus END AS TWO,
  CASE WHEN k = 2 THEN o_orderpriority || '|' END AS MORE
FROM (SELECT *, o_orderkey % 5 AS k FROM orders) WHERE k > 0"""


def s02_unlike_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one table with columns in another order, or fewer of them."""
    path = shared_folder(spark)
    rows = orders(spark, sf_dir)
    layouts = [["o_orderkey", "o_orderstatus", "o_orderpriority"], ["o_orderpriority", "o_orderkey", "o_orderstatus"], ["o_orderkey"]]
    for number, columns in enumerate(layouts):
        part = rows.where(F.col("o_orderkey") % 3 == number).select(*columns).hint("rebalance", "o_orderkey")
        land_lines(part, f"{path}/{number}", header=True, compression="gzip")
    return read_tab_header(spark, [f"{path}/{number}" for number in range(3)]).select(*layouts[0])


S2_UNLIKE = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 3 < 2 THEN o_orderpriority END AS o_orderpriority FROM orders"""


def _record(spelling) -> Column:
    """A gene record of an order, with fields spelled as the function says."""
    info = F.struct(F.col("o_custkey").alias(spelling("ChrStart")), F.col("o_orderkey").alias(spelling("ChrStop")))
    return F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("uid" if spelling("a") == "a" else "UID"),
            F.col("o_orderpriority").alias(spelling("Name")),
            F.array(F.col("o_custkey").cast("string")).alias(spelling("Mim")),
            F.array(info).alias(spelling("GenomicInfo")),
            F.struct(F.lit(fv.HUMAN_TAX_ID).alias("TaxID")).alias(spelling("Organism")),
        )
    )


SPELLINGS = [str.upper, str.lower, lambda name: name]


def _summary_columns(records: DataFrame) -> DataFrame:
    return records.select(
        "UID",
        "NAME",
        F.get("MIM", F.lit(0)).alias("MIM_ID"),
        positions.genomic_info(F.col("GENOMICINFO"), "CHRSTART").alias("CHRSTART"),
        positions.genomic_info(F.col("GENOMICINFO"), "CHRSTOP").alias("CHRSTOP"),
        positions.organism_tax_id(F.col("ORGANISM")).alias("TAX_ID"),
    )


S4_MIXED = """
SELECT CAST(o_orderkey AS VARCHAR) AS UID, o_orderpriority AS NAME, CAST(o_custkey AS VARCHAR) AS MIM_ID,
  CAST(o_custkey AS INTEGER) AS CHRSTART, CAST(o_orderkey AS INTEGER) AS CHRSTOP, CAST(9606 AS INTEGER) AS TAX_ID
FROM orders"""


def s04_mixed_case_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in upper, lower and mixed case, within the same pages."""
    path = shared_folder(spark)
    records = [F.when(F.col("o_orderkey") % 3 == i, _record(s)) for i, s in enumerate(SPELLINGS)]
    orders(spark, sf_dir).select(F.coalesce(*records).alias("value")).write.text(path)
    return _summary_columns(read_docsum_json(spark, path, "gene_summary"))


def s03_mixed_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML, JSON and gzip JSON pages of one table in one landing folder with a blank in its name."""
    landing = f"{shared_folder(spark)}/landed files"
    rows, base = orders(spark, sf_dir), f"{landing}/ncbi_human_gene_summary"
    part = lambda i: rows.where(F.col("o_orderkey") % 3 == i)
    info = F.struct(F.col("o_custkey").cast("int").alias("ChrStart"), F.col("o_orderkey").cast("int").alias("ChrStop"))
    page = part(0).select(
        F.col("o_orderkey").cast("string").alias("_uid"),
        F.col("o_orderpriority").alias("Name"),
        F.struct(F.array(F.col("o_custkey").cast("string")).alias("int")).alias("Mim"),
        F.struct(F.array(info).alias("GenomicInfoType")).alias("GenomicInfo"),
        F.struct(F.lit(fv.HUMAN_TAX_ID).alias("TaxID")).alias("Organism"),
    )
    land_xml(page, f"{base}_one.xml")
    part(1).select(_record(str.lower).alias("value")).write.text(f"{base}_two.json")
    part(2).select(_record(str.upper).alias("value")).write.option("compression", "gzip").text(f"{base}/deep/er")
    return _summary_columns(Pipeline(spark, "ncbi", landing).extract("gene_summary"))


def s03_rescued_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML and JSON records with fields that the table has no column for."""
    landing = shared_folder(spark)
    rows, base = orders(spark, sf_dir), f"{landing}/ncbi_human_gene_summary"
    known = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    more = F.col("o_orderstatus"), F.struct(F.col("o_custkey").alias("Deep"))
    part = lambda i: rows.where(F.col("o_orderkey") % 2 == i)
    page = part(0).select(
        known[0].alias("_uid"), known[1].alias("Name"), more[0].alias("Extra"), more[1].alias("Nested")
    )
    land_xml(page, f"{base}_one.xml")
    part(1).select(
        known[0].alias("uid"), known[1].alias("name"), more[0].alias("Extra"), more[1].alias("Nested")
    ).write.json(f"{base}_two.json")
    found = rescued_fields(Pipeline(spark, "ncbi", landing).extract("gene_summary"), "UID")
    # Records within records stay as they were written.
    return found.withColumn("VALUE", F.regexp_extract("VALUE", "([A-Z0-9]+)", 1)).where("NAME <> 'Nested'").unionByName(
        found.where("NAME = 'Nested'").withColumn("VALUE", F.regexp_extract("VALUE", "([0-9]+)", 1))
    )


S3_RESCUED = """
SELECT CAST(o_orderkey AS VARCHAR) AS UID, unnest(['Extra', 'Nested']) AS NAME,
  unnest([o_orderstatus, CAST(o_custkey AS VARCHAR)]) AS VALUE FROM orders"""


def s09_nested_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a table in folders below its own."""
    landing = shared_folder(spark)
    raw = shapes.raw(spark, sf_dir, "pathway_gene")
    land_lines(raw, f"{landing}/kegg_human_pathway_gene/2024/06")
    land_lines(raw, f"{landing}/kegg_human_pathway_gene_more.txt/x")
    return Pipeline(spark, "kegg", landing).extract("pathway_gene").select(*raw.columns)


def s10_ragged_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The widest line stands anywhere."""
    path = shared_folder(spark)
    wide = F.when(F.col("o_orderkey") == F.lit(7), F.concat_ws("\t", "o_orderstatus", "o_orderpriority"))
    line = F.concat_ws("\t", "o_orderkey", F.coalesce(wide, F.col("o_orderstatus")))
    orders(spark, sf_dir).select(line.alias("value")).write.text(path)
    return read_tab_generic(spark, path)


S10_RAGGED = """
SELECT CAST(o_orderkey AS VARCHAR) AS _c0, o_orderstatus AS _c1, CASE WHEN o_orderkey = 7 THEN o_orderpriority END AS _c2
FROM orders"""


def t11_gene_lists_with_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gene lists with bare words of Python beside names that hold the same words."""
    text = F.concat(
        F.lit("[{'NAME': None, 'GENE_ID': '"),
        F.col("o_orderkey"),
        F.lit("'}, {'NAME': 'a, None, \"b', 'GENE_ID': None, 'OK': True}, {'NAME': \"None's\", 'GENE_ID': '"),
        F.col("o_custkey"),
        F.lit("'}]"),
    )
    rows = orders(spark, sf_dir).select("o_orderkey", names.literal_gene_ids(text).alias("ids"))
    return rows.select("o_orderkey", F.posexplode("ids").alias("POS", "GENE_ID"))


T11_WORDS = """
SELECT o_orderkey, CAST(0 AS INTEGER) AS POS, CAST(o_orderkey AS VARCHAR) AS GENE_ID FROM orders
UNION ALL SELECT o_orderkey, 1, NULL FROM orders
UNION ALL SELECT o_orderkey, 2, CAST(o_custkey AS VARCHAR) FROM orders"""


def t15_update_lookup_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second landing empties the names of some diseases; the others are absent from it."""
    first, second, old, new = (shared_folder(spark) for _ in range(4))
    key = F.concat(F.lit("H"), F.col("o_orderkey"))
    base = orders(spark, sf_dir)
    land_lines(base.select(key, F.concat("o_orderpriority", F.lit("; "), "o_orderstatus")), f"{first}/kegg_human_disease")
    changed = base.where(F.col("o_orderkey") % 2 == 0)
    emptied = F.when(F.col("o_orderkey") % 4 == 0, F.lit("")).otherwise(F.col("o_orderpriority"))
    changed.select(
        F.when(F.col("o_orderkey") % 4 == 0, key).otherwise(F.concat_ws("\t", key, emptied)).alias("value")
    ).write.text(f"{second}/kegg_human_disease")
    Pipeline(spark, "kegg", first, old).refresh(["disease"])
    pipeline = Pipeline(spark, "kegg", second, new)
    pipeline.refresh(["disease"], load=False)
    written = pipeline.update("kegg_human_disease_name_lookup", old)
    return spark.read.parquet(written).select("DISEASE_ID", "DISEASE_NAME")


T15_EMPTIED = """
SELECT 'DS' || o_orderkey AS DISEASE_ID, unnest([o_orderpriority, o_orderstatus]) AS DISEASE_NAME
FROM orders WHERE o_orderkey % 2 = 1
UNION ALL SELECT 'DS' || o_orderkey, o_orderpriority FROM orders WHERE o_orderkey % 4 = 2"""


def t15_upsert_repeated_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming rows repeat keys; of some keys one row is stored as it is."""
    stored = orders(spark, sf_dir).select(F.col("o_orderkey").alias("ID"), F.col("o_orderpriority").alias("NAME"))
    other = stored.where("ID % 3 = 0").select("ID", F.lit("other").alias("NAME"))
    return upsert(stored, stored.where("ID % 3 < 2").unionByName(other), "ID")


T15_REPEATED = """
SELECT o_orderkey AS ID, o_orderpriority AS NAME FROM orders
UNION ALL SELECT o_orderkey, 'other' FROM orders WHERE o_orderkey % 3 = 0"""


def refreshed_tables() -> dict[str, partial]:
    """A query per written table, named after the job's own query."""
    return {
        f"t14_refreshed_{name.split('_', 1)[1]}": partial(refreshed, source=source, table=table, output=output)
        for name, (source, table, output) in JOB_OUTPUTS.items()
    }


QUERIES = {
    "s01_ragged_lines": s01_ragged_lines,
    "s02_unlike_headers": s02_unlike_headers,
    "s03_mixed_formats": s03_mixed_formats,
    "s03_rescued_fields": s03_rescued_fields,
    "s04_mixed_case_pages": s04_mixed_case_pages,
    "s09_nested_folders": s09_nested_folders,
    "s10_ragged_width": s10_ragged_width,
    "t11_gene_lists_with_words": t11_gene_lists_with_words,
    "t15_update_lookup_emptied": t15_update_lookup_emptied,
    "t15_upsert_repeated_key": t15_upsert_repeated_key,
}


def oracles(job_oracles: dict[str, str]) -> dict[str, str]:
    """SQL of these queries; a refreshed table has the SQL of the job that makes it."""
    pathway_gene = shapes.duckdb_text(shapes.PATHWAY_GENE)
    return {
        "s01_ragged_lines": S1_RAGGED,
        "s02_unlike_headers": S2_UNLIKE,
        "s03_mixed_formats": S4_MIXED,
        "s03_rescued_fields": S3_RESCUED,
        "s04_mixed_case_pages": S4_MIXED,
        "s09_nested_folders": f"SELECT * FROM ({pathway_gene}) UNION ALL SELECT * FROM ({pathway_gene})",
        "s10_ragged_width": S10_RAGGED,
        "t11_gene_lists_with_words": T11_WORDS,
        "t15_update_lookup_emptied": T15_EMPTIED,
        "t15_upsert_repeated_key": T15_REPEATED,
        **{f"t14_refreshed_{name.split('_', 1)[1]}": sql for name, sql in job_oracles.items()},
    }
