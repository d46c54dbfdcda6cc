"""One query per operator, over the tables of a scale-factor folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.functions import positions
from codonmill.operators import quality
from codonmill.operators.numbering import numbered_lookup
from codonmill.operators.ordering import ordered_by
from codonmill.operators.outer_join import full_outer
from codonmill.plans import kegg, links, ncbi
from codonmill.plans.incremental import replace_keys, upsert
from codonmill.plans.layout import by_gene, lay_out, linked
from codonmill.plans.refresh import Pipeline
from codonmill.plans.registry import REGISTRY, spec
from codonmill.schemas import full_name
from codonmill.session import shared_folder
from codonmill.sources.delimited import read_tab_generic, read_tab_header, read_tab_list
from codonmill.sources.docsum import read_docsum_json, read_docsum_xml, union_pages
from codonmill.sources.landing import lines_per_table
from codonmill.sources.sinks import write_table
from codonmill.sources.stage import load_stage, save_stage
from codonmill.streaming.landing import load_new_files
from harness import landed, shapes, versioned
from harness.landed import JOB_OUTPUTS, land, land_lines, land_xml

Query = Callable[[SparkSession, str], DataFrame]


def _job(spark: SparkSession, sf_dir: str, source: str, table: str, output: str) -> DataFrame:
    return spec(source, table).table(shapes.raw(spark, sf_dir, table), output)


def _link(link: Callable[..., DataFrame], *inputs: tuple[str, str, str]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return link(*[_job(spark, sf_dir, *each) for each in inputs])

    return query


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _laid_link(
    link: Callable[[DataFrame, DataFrame, DataFrame | None], DataFrame],
    one: tuple[str, str, str],
    other: tuple[str, str, str],
    third: tuple[str, str, str] | None = None,
) -> Query:
    """A link query over tables laid out by gene; a key that has more rows than a bucket on average is hot."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder, run = shared_folder(spark), uuid.uuid4().hex
        sides = []
        for source, table, output in (one, other):
            name = full_name(source, output)
            path = write_table(_job(spark, sf_dir, source, table, output), name, f"{folder}/written")
            df, key = by_gene(spark.read.parquet(path), name)
            sides.append(lay_out(df, f"{name}_{run}", key, 8, f"{folder}/by_gene", hot_rows=2))
        last = _job(spark, sf_dir, *third) if third else None
        return linked(lambda a, b: link(a, b, last), *sides)

    return query


# --- jobs --------------------------------------------------------------------


def t01_pathway(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = shapes.frame(spark, sf_dir, shapes.WIDE_PATHWAY)
    return spec("kegg", "pathway").table(raw, "pathway")


def t13_human_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ncbi.human_rows(
        shapes.raw(spark, sf_dir, "gene_orthologs"), {"OTHER_GENEID": "OTHER_GENE_ID"}
    )


def _row_counts(spark: SparkSession, written: dict[str, str]) -> DataFrame:
    counts = [
        spark.read.parquet(path).agg(
            F.lit(name).alias("TABLE_NAME"), F.count(F.lit(1)).alias("N_ROWS")
        )
        for name, path in written.items()
    ]
    return reduce(DataFrame.unionByName, counts).select("TABLE_NAME", "N_ROWS")


def _refresh_all(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Land every raw table of a source, refresh them all, count what was written."""
    landing, target = shared_folder(spark), shared_folder(spark)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda table: land(spark, sf_dir, source, table, landing), REGISTRY[source]))
    return _row_counts(spark, Pipeline(spark, source, landing, target).refresh())


def t15_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = shapes.frame(
        spark,
        sf_dir,
        "SELECT 'DS' || CAST(o_orderkey AS STRING) AS DISEASE_ID, o_orderpriority AS NAME FROM {orders}",
    )
    incoming = shapes.frame(
        spark,
        sf_dir,
        """SELECT 'DS' || CAST(o_orderkey AS STRING) AS DISEASE_ID,
             CASE o_orderstatus WHEN 'P' THEN 'new ' || o_orderpriority ELSE o_orderpriority END AS NAME
           FROM {orders}
           UNION ALL SELECT 'C' || CAST(c_custkey AS STRING), c_name FROM {customer}""",
    )
    return upsert(stored, incoming, "DISEASE_ID")


def t15_replace_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of an order make way for the new lines of that order."""
    stored = shapes.frame(
        spark, sf_dir, "SELECT l_orderkey AS ID, l_linenumber AS VALUE FROM {lineitem}"
    )
    incoming = shapes.frame(
        spark, sf_dir, "SELECT o_custkey AS ID, CAST(o_orderkey AS INT) AS VALUE FROM {orders}"
    )
    return replace_keys(stored, incoming, "ID")


def t15_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, target, checkpoint = (shared_folder(spark) for _ in range(3))
    land_lines(
        shapes.raw(spark, sf_dir, "pathway_gene"), f"{landing}/kegg_human_pathway_gene"
    )
    load_new_files(spark, landing, "pathway_gene", target, checkpoint).awaitTermination()
    return spark.read.parquet(f"{target}/kegg_human_pathway_gene_lookup").drop("batch")


# --- queries across tables -----------------------------------------------------

PATHWAY = ("kegg", "pathway", "pathway")
GENE = ("kegg", "gene", "gene")
DISEASE = ("kegg", "disease", "disease")
INFO = ("ncbi", "gene_info", "gene_info")
NCBI_GENE = ("kegg", "ncbi_gene", "ncbi_gene_lookup")
SYMBOL_LOOKUPS = [
    ("kegg", "gene", "gene_symbol_lookup"),
    ("ncbi", "gene_info", "gene_info_symbol_lookup"),
    ("ncbi", "gene_summary", "gene_summary_symbol_lookup"),
]


def j08_variant_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = _link(links.gene_aliases, *SYMBOL_LOOKUPS)(spark, sf_dir)
    return links.variant_genes(_job(spark, sf_dir, "kegg", "variant", "variant"), aliases)


# --- single operators ------------------------------------------------------------


def e01_pathway_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = shapes.frame(spark, sf_dir, shapes.WIDE_PATHWAY)
    return kegg.pathway(raw, with_class=True)


def e25_organism_tax_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("UID"),
        F.struct(F.col("o_custkey").cast("int").alias("TaxID")).alias("ORGANISM"),
    )
    return records.select("UID", positions.organism_tax_id(F.col("ORGANISM")).alias("TAX_ID"))


ORDERS_PER_CHUNK = 50_000


def r09_running_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes that occur in many rows: numbers run on from order to order."""
    rows = shapes.frame(
        spark,
        sf_dir,
        """SELECT 'G' || CAST(o_custkey AS STRING) AS GENE_ID, o_orderkey,
             'SYM' || CAST(o_orderkey AS STRING) || ', ' || o_orderpriority
               || CASE WHEN o_orderstatus = 'P' THEN ', pending' ELSE '' END AS SYMBOLS
           FROM {orders}""",
    ).withColumn("chunk", F.floor(F.col("o_orderkey") / ORDERS_PER_CHUNK))
    return numbered_lookup(
        rows,
        "GENE_ID",
        F.split("SYMBOLS", ", "),
        "GENE_SYMBOL",
        "GENE_ALIAS_NO",
        "gene",
        order=["o_orderkey"],
        chunk=["chunk"],
    )


def _pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        shapes.frame(
            spark, sf_dir, "SELECT CAST(o_orderkey AS STRING) AS UID, o_orderstatus AS STATUS FROM {orders}"
        ),
        shapes.frame(
            spark, sf_dir, "SELECT CAST(event_id AS STRING) AS UID, event_type AS CHROMOSOME FROM {events}"
        ),
    )


def r10_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_pages(_pages(spark, sf_dir))


def r11_ordered_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_by(_job(spark, sf_dir, "ncbi", "gene_summary", "gene_summary"), "GENE_ID")


def r12_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys repeat on the left, and either side has keys of its own."""
    lines = shapes.frame(
        spark, sf_dir, "SELECT l_partkey * 3 AS KEY, l_linenumber AS LINES FROM {lineitem}"
    )
    orders = shapes.frame(
        spark, sf_dir, "SELECT o_orderkey * 2 AS KEY, o_orderpriority AS NAME FROM {orders}"
    )
    return full_outer(lines, orders, "KEY")


def r19_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _job(spark, sf_dir, "kegg", "disease", "disease_name_lookup")
    return names.groupBy("DISEASE_ID").agg(
        F.count(F.lit(1)).cast("int").alias("DISEASE_NAME_COUNT")
    )


# --- checks ------------------------------------------------------------------------


def v02_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = shapes.frame(
        spark, sf_dir, "SELECT 'DS' || CAST(o_custkey AS STRING) AS DISEASE_ID FROM {orders}"
    )
    return quality.unique_check(ids, "kegg_human_disease")


def v03_v05_v06_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    loose = shapes.frame(
        spark,
        sf_dir,
        """SELECT CASE WHEN event_type <> 'error' THEN 'V' || CAST(user_id AS STRING) END AS VARIANT_ID,
             'name of ' || props || ' ' || event_type AS VARIANT_NAME,
             CASE event_type WHEN 'view' THEN 'x' || CAST(event_id AS STRING)
               ELSE CAST(event_id AS STRING) END AS VARIANT_VERSION,
             'SYM' || repeat(event_type, 4) AS GENE_SYMBOL
           FROM {events}""",
    )
    return quality.column_checks(loose, "kegg_human_variant")


def v04_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    child = shapes.frame(
        spark, sf_dir, "SELECT 'DS' || CAST(l_orderkey AS STRING) AS DISEASE_ID FROM {lineitem}"
    )
    parent = shapes.frame(
        spark, sf_dir, "SELECT 'DS' || CAST(c_custkey AS STRING) AS DISEASE_ID FROM {customer}"
    )
    return quality.reference_check(child, parent, "kegg_human_disease_name_lookup")


# --- sources and sinks: write to the shared folder, read back ------------------------


# Gzip and XML files are one task each, so extracts land as several.


def s01_tab_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    land_lines(shapes.raw(spark, sf_dir, "gene"), path)
    return read_tab_list(spark, path, fv.KEGG_RAW_COLUMNS["gene"])


def s02_tab_header_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    land_lines(shapes.raw(spark, sf_dir, "gene2go", spread=True), path, header=True, compression="gzip")
    return read_tab_header(spark, path)


def s03_docsum_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    info = F.struct(
        F.col("o_custkey").cast("int").alias("ChrStart"), F.col("o_orderkey").cast("int").alias("ChrStop")
    )
    records = _table(spark, sf_dir, "orders").hint("rebalance", "o_orderkey").select(
        F.col("o_orderkey").cast("string").alias("_uid"),
        F.concat(F.lit("N"), F.col("o_custkey").cast("string")).alias("Name"),
        F.col("o_orderpriority").alias("Description"),
        F.concat(F.lit("G"), F.col("o_orderstatus")).alias("NomenclatureSymbol"),
        F.struct(F.array(F.col("o_custkey").cast("string")).alias("int")).alias("Mim"),
        F.struct(F.array(info).alias("GenomicInfoType")).alias("GenomicInfo"),
        F.struct(F.lit(fv.HUMAN_TAX_ID).alias("TaxID")).alias("Organism"),
    )
    land_xml(records, path)
    return read_docsum_xml(spark, path, "gene_summary").select(
        "UID",
        "NAME",
        "DESCRIPTION",
        "NOMENCLATURESYMBOL",
        positions.genomic_info(F.col("GENOMICINFO"), "CHRSTART").alias("CHRSTART"),
        positions.genomic_info(F.col("GENOMICINFO"), "CHRSTOP").alias("CHRSTOP"),
        positions.organism_tax_id(F.col("ORGANISM")).alias("TAX_ID"),
        F.get("MIM", F.lit(0)).alias("MIM_ID"),
    )


def s04_paged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with unlike fields, read as one table."""
    path = shared_folder(spark)
    for number, page in enumerate(_pages(spark, sf_dir)):
        page.write.json(f"{path}/page={number}")
    return read_docsum_json(spark, path, "gene_summary").select("UID", "STATUS", "CHROMOSOME")


def _staged_summary(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    base = shared_folder(spark)
    summary = _job(spark, sf_dir, "ncbi", "gene_summary", "gene_summary")
    save_stage(summary, base, "gene_summary", "ncbi", fmt=fmt)
    return load_stage(spark, base, "gene_summary", "ncbi", fmt=fmt)


def s07_sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = shared_folder(spark)
    disease = _job(spark, sf_dir, "kegg", "disease", "disease")
    for _ in range(2):
        path = write_table(disease, "kegg_human_disease", target)
    return spark.read.parquet(path)


def s07_sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = shared_folder(spark)
    links_table = _job(spark, sf_dir, "kegg", "pathway_gene", "pathway_gene_lookup")
    for _ in range(2):
        path = write_table(links_table, "kegg_human_pathway_gene_lookup", target, overwrite=True)
    return spark.read.parquet(path)


def s09_landed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per table in a folder where one table's name begins another's."""
    landing = shared_folder(spark)
    for table, part in [
        ("gene", ""), ("gene_disease", ""), ("pathway", "_first"), ("pathway", "_second"),
    ]:
        land_lines(shapes.raw(spark, sf_dir, table), f"{landing}/kegg_human_{table}{part}")
    return lines_per_table(spark, landing, "kegg", REGISTRY["kegg"])


def s10_generic_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    rows = shapes.frame(
        spark,
        sf_dir,
        """SELECT l_orderkey, 'R-HSA-' || CAST(l_partkey AS STRING) AS reaction, l_suppkey, l_returnflag
           FROM {lineitem}""",
    )
    land_lines(rows, path)
    return read_tab_generic(spark, path)


# --- registry ---------------------------------------------------------------------------


def _jobs() -> dict[str, Query]:
    return {
        name: partial(_job, source=source, table=table, output=output)
        for name, (source, table, output) in JOB_OUTPUTS.items()
    }


QUERIES: dict[str, Query] = {
    "t01_pathway": t01_pathway,
    **_jobs(),
    **landed.refreshed_tables(),
    **landed.QUERIES,
    **versioned.QUERIES,
    "t12_j01_gene_merged": _link(
        links.gene_merged, INFO, ("ncbi", "gene_summary", "gene_summary"), GENE, NCBI_GENE
    ),
    "t13_human_rows": t13_human_rows,
    "t14_refresh_kegg": partial(_refresh_all, source="kegg"),
    "t14_refresh_ncbi": partial(_refresh_all, source="ncbi"),
    "t15_upsert": t15_upsert,
    "t15_replace_keys": t15_replace_keys,
    "t15_new_files": t15_new_files,
    "j02_pathway_genes": _link(
        links.pathway_genes, PATHWAY, ("kegg", "pathway_gene", "pathway_gene_lookup"), GENE
    ),
    "j03_pathway_modules": _link(
        links.pathway_modules,
        PATHWAY,
        ("kegg", "pathway_module", "pathway_module_lookup"),
        ("kegg", "module", "module"),
    ),
    "j03_pathway_diseases": _link(
        links.pathway_diseases, PATHWAY, ("kegg", "pathway_disease", "pathway_disease_lookup"), DISEASE
    ),
    "j04_gene_diseases": _link(
        links.gene_diseases, GENE, ("kegg", "gene_disease", "gene_disease_lookup"), DISEASE
    ),
    "j05_matched_genes": _link(links.matched_genes, GENE, NCBI_GENE, INFO),
    "j06_gene_snps": _link(
        links.gene_snps,
        INFO,
        ("ncbi", "snp_summary", "snp_summary_gene_lookup"),
        ("ncbi", "snp_summary", "snp_summary"),
    ),
    "j07_gene_go_terms": _link(links.gene_go_terms, INFO, ("ncbi", "gene2go", "gene2go")),
    "j07_gene_orthologs": _link(
        links.gene_orthologs, INFO, ("ncbi", "gene_orthologs", "gene_orthologs")
    ),
    "j04_laid_out": _laid_link(
        lambda gene, lookup, disease: links.gene_diseases(gene, lookup, disease),
        GENE,
        ("kegg", "gene_disease", "gene_disease_lookup"),
        DISEASE,
    ),
    "j06_laid_out": _laid_link(
        lambda info, lookup, snps: links.gene_snps(info, lookup, snps),
        INFO,
        ("ncbi", "snp_summary", "snp_summary_gene_lookup"),
        ("ncbi", "snp_summary", "snp_summary"),
    ),
    "j07_laid_out": _laid_link(
        lambda info, terms, _: links.gene_go_terms(info, terms), INFO, ("ncbi", "gene2go", "gene2go")
    ),
    "j08_gene_aliases": _link(links.gene_aliases, *SYMBOL_LOOKUPS),
    "j08_variant_genes": j08_variant_genes,
    "e01_pathway_class": e01_pathway_class,
    "e25_organism_tax_id": e25_organism_tax_id,
    "r09_running_number": r09_running_number,
    "r10_union_by_name": r10_union_by_name,
    "r11_ordered_summary": r11_ordered_summary,
    "r12_full_outer": r12_full_outer,
    "r19_group_count": r19_group_count,
    "v02_unique": v02_unique,
    "v03_v05_v06_columns": v03_v05_v06_columns,
    "v04_reference": v04_reference,
    "s01_tab_list": s01_tab_list,
    "s02_tab_header_gzip": s02_tab_header_gzip,
    "s03_docsum_xml": s03_docsum_xml,
    "s04_paged_union": s04_paged_union,
    "s05_s06_stage_parquet": partial(_staged_summary, fmt="parquet"),
    "s05_s06_stage_csv": partial(_staged_summary, fmt="csv"),
    "s07_sink_append": s07_sink_append,
    "s07_sink_overwrite": s07_sink_overwrite,
    "s09_landed_tables": s09_landed_tables,
    "s10_generic_tab": s10_generic_tab,
}
