"""Raw genomics tables, made from the given tables by SQL that both engines read.

Every shape uses all rows of its tables. `{name}` stands for a given table; a
doubled brace is a brace. Attributes of the rows decide which form of a field a
row gets, so that all forms occur.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

PATHWAY = """
SELECT 'hsa' || CAST(s_suppkey AS STRING) AS PATHWAY_ID,
       s_name || ' - nation ' || CAST(s_nationkey AS STRING) || ' - Homo sapiens (human)' AS PATHWAY_NAME
FROM {supplier}"""

WIDE_PATHWAY = """
SELECT 'hsa' || CAST(p_partkey AS STRING) AS PATHWAY_ID,
       p_name || CASE WHEN p_type = 'PROMO' THEN '' ELSE ' - ' || p_brand || ' - Homo sapiens (human)' END
         AS PATHWAY_NAME
FROM {part}"""

GENE = """
SELECT 'hsa:' || CAST(p_partkey AS STRING) AS GENE_ID,
       CASE WHEN p_type = 'ECONOMY' THEN 'miRNA' ELSE 'CDS' END AS GENE_TYPE,
       CASE WHEN p_size < 4 THEN '1:' || CAST(p_partkey AS STRING) || '..' || CAST(p_partkey + 2535 AS STRING)
            WHEN p_size < 8 THEN '1:complement(' || CAST(p_partkey AS STRING) || '..' || CAST(p_partkey + 90 AS STRING) || ')'
            WHEN p_size < 11 THEN '6:join(1..2,3..' || CAST(p_partkey AS STRING) || ')'
            WHEN p_size < 14 THEN '6:complement(join(1..2,3..' || CAST(p_partkey AS STRING) || '))'
            WHEN p_size < 17 THEN 'X:' || CAST(p_partkey AS STRING)
            WHEN p_size < 20 THEN '1p36.1'
            WHEN p_size < 23 THEN '12q24'
            WHEN p_size < 26 THEN 'MT:1..' || CAST(p_partkey AS STRING)
            WHEN p_size < 29 THEN 'X; Y'
            WHEN p_size < 32 THEN 'Un'
            WHEN p_size < 35 THEN 'Un:1..' || CAST(p_partkey AS STRING)
            WHEN p_size < 38 THEN '13cen'
            WHEN p_size < 41 THEN ''
            ELSE '2:<1..>' || CAST(p_partkey AS STRING) END AS CHROMOSOMAL_POSITION,
       CASE WHEN p_brand = 'Brand#7' THEN p_name
            ELSE 'SYM' || CAST(p_partkey AS STRING) || ', ' || p_brand || '; ' || p_name
                 || CASE WHEN p_type = 'PROMO' THEN '; more' ELSE '' END END AS GENE_SYMBOL_AND_NAME
FROM {part}"""

DISEASE = """
SELECT 'H' || CAST(o_orderkey AS STRING) AS DISEASE_ID,
       'Syndrome ' || CAST(o_custkey AS STRING) || '; ' || o_orderpriority
         || CASE WHEN o_orderstatus = 'P' THEN '; pending form' ELSE '' END AS DISEASE_NAME
FROM {orders}"""

VARIANT = """
SELECT CASE WHEN event_type = 'error' THEN CAST(event_id AS STRING)
            ELSE 'var' || CAST(event_id AS STRING) || 'v' || CAST(user_id AS STRING) END AS VARIANT_ID,
       'SYM' || CAST(user_id AS STRING) || ' ' || event_type || ' form' AS VARIANT_NAME
FROM {events}"""

MODULE = """
SELECT 'M' || CAST(p_partkey AS STRING) AS MODULE_ID,
       CASE WHEN p_size < 5 THEN p_name
            WHEN p_size < 20 THEN p_name || ', ' || p_type || ' (' || p_brand || '), tail'
            ELSE p_name || ' (' || p_type || '), ' || p_brand END AS MODULE_NAME
FROM {part}"""

_LINE_PATHWAY = """CASE WHEN l_returnflag = 'A' THEN 'path:map' ELSE 'path:hsa' END
         || CAST(l_suppkey AS STRING)"""

PATHWAY_GENE = f"""
SELECT {_LINE_PATHWAY} AS PATHWAY_ID,
       'hsa:' || CAST(l_partkey AS STRING) AS GENE_ID
FROM {{lineitem}}"""

PATHWAY_MODULE = f"""
SELECT {_LINE_PATHWAY} AS PATHWAY_ID,
       'md:M' || CAST(l_partkey AS STRING) AS MODULE_ID
FROM {{lineitem}}"""

PATHWAY_DISEASE = f"""
SELECT {_LINE_PATHWAY} AS PATHWAY_ID,
       'ds:H' || CAST(l_orderkey AS STRING) AS DISEASE_ID
FROM {{lineitem}}"""

# Either column may hold the gene.
GENE_DISEASE = """
SELECT CASE WHEN l_linestatus = 'O' THEN 'hsa:' || CAST(l_partkey AS STRING)
            ELSE 'ds:H' || CAST(l_orderkey AS STRING) END AS GENE_ID,
       CASE WHEN l_linestatus = 'O' THEN 'ds:H' || CAST(l_orderkey AS STRING)
            ELSE 'hsa:' || CAST(l_partkey AS STRING) END AS DISEASE_ID
FROM {lineitem}"""

NCBI_GENE = """
SELECT 'ncbi-geneid:' || CAST(c_custkey * 2 AS STRING) AS NCBI_GENE_ID,
       'hsa:' || CAST(c_custkey AS STRING) AS GENE_ID
FROM {customer}"""

GENE_INFO = """
SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 10090 ELSE 9606 END AS `#tax_id`,
       CAST(o_orderkey AS STRING) AS GeneID,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN '-'
            ELSE 'LOC' || CAST(o_orderkey AS STRING) END AS Symbol,
       '-' AS LocusTag,
       CASE o_orderpriority WHEN '1-URGENT' THEN '-' WHEN '2-HIGH' THEN 'A|NaN|B' || CAST(o_custkey AS STRING)
            WHEN '3-MEDIUM' THEN 'SYM' || CAST(o_custkey AS STRING) ELSE 'a||' || o_orderstatus END AS Synonyms,
       CASE o_orderstatus WHEN 'O' THEN 'HGNC:HGNC:' || CAST(o_orderkey AS STRING) || '|MIM:' || CAST(o_custkey AS STRING)
            WHEN 'F' THEN 'Ensembl:ENSG' || CAST(o_custkey AS STRING) ELSE '-' END AS dbXrefs,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'X|Y' WHEN '2-HIGH' THEN 'XY' WHEN '3-MEDIUM' THEN '1|2'
            ELSE CASE o_orderstatus WHEN 'O' THEN 'Un' WHEN 'F' THEN '-' ELSE '7' END END AS chromosome,
       CASE o_orderstatus WHEN 'O' THEN '19q13.43' WHEN 'F' THEN '-' ELSE '3p21|Xq28' END AS map_location,
       'gene of customer ' || CAST(o_custkey AS STRING) AS description,
       CASE o_orderstatus WHEN 'O' THEN 'protein-coding' WHEN 'F' THEN 'unknown' ELSE 'ncRNA' END AS type_of_gene,
       CASE o_orderstatus WHEN 'O' THEN 'SYM' || CAST(o_orderkey AS STRING) ELSE '-' END
         AS Symbol_from_nomenclature_authority,
       CASE o_orderstatus WHEN 'O' THEN 'full name ' || CAST(o_orderkey AS STRING) ELSE '-' END
         AS Full_name_from_nomenclature_authority,
       CASE o_orderstatus WHEN 'O' THEN 'O' WHEN 'F' THEN 'I' ELSE '-' END AS Nomenclature_status,
       CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '-' ELSE 'protein ' || o_orderpriority || '|other' END
         AS Other_designations,
       '20240101' AS Modification_date,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'regulatory:enhancer:x|misc' WHEN '2-HIGH' THEN 'a:b|c:' || o_orderstatus
            ELSE '-' END AS Feature_type
FROM {orders}"""

_LINE_TAXON = "CASE WHEN l_returnflag = 'A' THEN 10090 ELSE 9606 END AS `#tax_id`"

GENE_ORTHOLOGS = f"""
SELECT {_LINE_TAXON},
       CAST(l_orderkey AS STRING) AS GeneID,
       'Ortholog' AS relationship,
       CAST(l_suppkey AS STRING) AS Other_tax_id,
       CAST(l_partkey AS STRING) AS Other_GeneID
FROM {{lineitem}}"""

GENE2GO = f"""
SELECT {_LINE_TAXON},
       CAST(l_orderkey AS STRING) AS GeneID,
       'GO:' || CAST(l_partkey AS STRING) AS GO_ID,
       CASE l_linestatus WHEN 'O' THEN 'IEA' ELSE 'IDA' END AS Evidence,
       'located_in' AS Qualifier,
       'term ' || CAST(l_partkey AS STRING) AS GO_term,
       CAST(l_suppkey AS STRING) AS PubMed,
       CASE l_returnflag WHEN 'R' THEN 'Function' ELSE 'Process' END AS Category
FROM {{lineitem}}"""

# The whole text of every document is a summary. List syntax differs by engine.
_GENE_SUMMARY = """
SELECT CAST(doc_id AS STRING) AS UID,
       source || 'n' || CAST(doc_id AS STRING) AS NAME,
       'about ' || source AS DESCRIPTION,
       '0' AS STATUS, '0' AS CURRENTID,
       CASE WHEN n_chars < 300 THEN 'X, Y' WHEN n_chars < 600 THEN '1, 2, 3' WHEN n_chars < 900 THEN ''
            WHEN n_chars < 1200 THEN NULL WHEN n_chars < 1500 THEN 'Un' ELSE '7' END AS CHROMOSOME,
       'genomic' AS GENETICSOURCE,
       CASE lang WHEN 'en' THEN '19q13' ELSE '' END AS MAPLOCATION,
       CASE lang WHEN 'en' THEN 'AL' || CAST(doc_id AS STRING) || ', ' || source WHEN 'fr' THEN '' WHEN 'de' THEN NULL
            ELSE source END AS OTHERALIASES,
       'x' AS OTHERDESIGNATIONS,
       CASE lang WHEN 'en' THEN source || 'n' || CAST(doc_id AS STRING)
            WHEN 'fr' THEN 'MT-' || source || 'n' || CAST(doc_id AS STRING)
            WHEN 'de' THEN '' ELSE 'S' || CAST(doc_id AS STRING) END AS NOMENCLATURESYMBOL,
       CASE lang WHEN 'de' THEN '' ELSE 'name ' || source END AS NOMENCLATURENAME,
       'Official' AS NOMENCLATURESTATUS,
       CASE lang WHEN 'en' THEN {mim} WHEN 'fr' THEN {no_mim} END AS MIM,
       CASE lang WHEN 'de' THEN {no_info} WHEN 'es' THEN NULL ELSE {info} END AS GENOMICINFO,
       CAST(n_chars AS INT) AS GENEWEIGHT,
       text AS SUMMARY,
       '07' AS CHRSORT
FROM {{documents}}"""

_START = "CAST(CASE WHEN n_chars > 2000 THEN 999999999 ELSE n_chars END AS INT)"
_STOP = "CAST(CASE WHEN n_chars > 4000 THEN 999999999 ELSE n_chars + 7 END AS INT)"

GENE_SUMMARY_SPARK = _GENE_SUMMARY.format(
    mim="array(CAST(doc_id AS STRING), CAST(n_chars AS STRING))",
    no_mim="CAST(array() AS array<string>)",
    info=f"array(named_struct('ChrStart', {_START}, 'ChrStop', {_STOP}, 'ExonCount', CAST(doc_id AS INT)))",
    no_info="CAST(array() AS array<struct<ChrStart:int,ChrStop:int,ExonCount:int>>)",
)
GENE_SUMMARY_DUCKDB = _GENE_SUMMARY.format(
    mim="[CAST(doc_id AS STRING), CAST(n_chars AS STRING)]",
    no_mim="CAST([] AS STRING[])",
    info=f"[{{{{'ChrStart': {_START}, 'ChrStop': {_STOP}, 'ExonCount': CAST(doc_id AS INT)}}}}]",
    no_info='CAST([] AS STRUCT("ChrStart" INT, "ChrStop" INT, "ExonCount" INT)[])',
)

SNP_SUMMARY = """
SELECT CAST(event_id AS STRING) AS UID,
       CAST(event_id AS STRING) AS SNP_ID,
       CASE event_type WHEN 'error' THEN '[]'
            WHEN 'view' THEN '[{{''NAME'': ''A'', ''GENE_ID'': ''' || CAST(user_id AS STRING) || '''}}]'
            ELSE '[{{''NAME'': ''A'', ''GENE_ID'': ''' || CAST(user_id AS STRING)
                 || '''}}, {{''NAME'': ''B'', ''GENE_ID'': ''' || CAST(event_id AS STRING) || '''}}]' END AS GENES,
       CASE event_type WHEN 'view' THEN 'intron_variant,,missense_variant' WHEN 'click' THEN NULL
            ELSE event_type || ',' || CAST(user_id AS STRING) END AS FXN_CLASS,
       CASE event_type WHEN 'view' THEN '' ELSE CAST(user_id AS STRING) || ',' || CAST(event_id AS STRING) END AS SS,
       'HGVS=NC_' || CAST(user_id AS STRING) || ':g.' || CAST(event_id AS STRING) || '=|LEN=1|LEN='
         || CAST(user_id AS STRING) || CASE event_type WHEN 'view' THEN '|SEQ=[A/G]' ELSE '' END AS DOCSUM,
       CASE event_type WHEN 'view' THEN '' ELSE 'benign,' || event_type END AS CLINICAL_SIGNIFICANCE,
       CAST(user_id AS STRING) AS CHR,
       CAST(user_id AS STRING) || ':' || CAST(event_id AS STRING) AS CHRPOS,
       'NC:' || CAST(event_id AS STRING) || ':A:G' AS SPDI,
       'by-frequency' AS VALIDATED,
       CAST(user_id AS STRING) AS UPD_BUILD,
       'R' AS ALLELE,
       event_type AS SNP_CLASS,
       'x' AS TEXT,
       'x' AS CHRPOS_SORT
FROM {events}"""

SHAPES = {
    "pathway": PATHWAY,
    "gene": GENE,
    "disease": DISEASE,
    "variant": VARIANT,
    "module": MODULE,
    "pathway_gene": PATHWAY_GENE,
    "pathway_module": PATHWAY_MODULE,
    "pathway_disease": PATHWAY_DISEASE,
    "gene_disease": GENE_DISEASE,
    "ncbi_gene": NCBI_GENE,
    "gene_info": GENE_INFO,
    "gene_orthologs": GENE_ORTHOLOGS,
    "gene2go": GENE2GO,
    "gene_summary": GENE_SUMMARY_SPARK,
    "snp_summary": SNP_SUMMARY,
}


def tables_in(text: str) -> list[str]:
    return sorted({field for _, field, _, _ in string.Formatter().parse(text) if field})


def frame(spark: SparkSession, sf_dir: str, text: str, spread: bool = False) -> DataFrame:
    """Run a shape, or any SQL over the given tables, in Spark.

    With `spread`, the rows of the given tables are dealt out by their keys while they are narrow, not those of the shape.
    """
    inputs = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in tables_in(text)}
    if spread:
        inputs = {name: df.hint("rebalance", *df.columns[:2]) for name, df in inputs.items()}
    return spark.sql(text, **inputs)


def raw(spark: SparkSession, sf_dir: str, table: str, spread: bool = False) -> DataFrame:
    return frame(spark, sf_dir, SHAPES[table], spread)


def duckdb_text(text: str) -> str:
    """The same SQL for DuckDB, which quotes names with double quotes."""
    return text.format(**{name: name for name in tables_in(text)}).replace("`", '"').strip()
