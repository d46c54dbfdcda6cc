"""The registered queries once more, as SQL for DuckDB over the given tables."""

from __future__ import annotations

from harness import landed, shapes, versioned
from harness.shapes import duckdb_text as sql


def _over(shape: str, body: str) -> str:
    return f"WITH raw AS ({sql(shape)})\n{body.strip()}"


# --- list and link tables ------------------------------------------------------

_SPAN = """CASE WHEN contains(CHROMOSOMAL_POSITION, 'complement')
  THEN replace(split_part(CHROMOSOMAL_POSITION, '(', 2), ')', '')
  ELSE split_part(CHROMOSOMAL_POSITION, ':', 2) END"""

_CHROMOSOME = """CASE
  WHEN contains(CHROMOSOMAL_POSITION, 'MT') THEN 'MT'
  WHEN contains(CHROMOSOMAL_POSITION, 'q') THEN split_part(CHROMOSOMAL_POSITION, 'q', 1)
  WHEN contains(CHROMOSOMAL_POSITION, 'p') AND NOT contains(CHROMOSOMAL_POSITION, 'complement')
    THEN split_part(CHROMOSOMAL_POSITION, 'p', 1)
  WHEN CHROMOSOMAL_POSITION = 'X; Y' THEN 'X;Y'
  WHEN CHROMOSOMAL_POSITION IN ('nan', 'Un', '') THEN 'Unknown'
  WHEN CHROMOSOMAL_POSITION = '13cen' THEN '13'
  ELSE split_part(CHROMOSOMAL_POSITION, ':', 1) END"""

PATHWAY_BODY = """
SELECT replace(PATHWAY_ID, 'hsa', 'P') AS PATHWAY_ID, split_part(PATHWAY_NAME, ' - ', 1) AS PATHWAY_NAME
FROM raw"""

T1 = _over(shapes.WIDE_PATHWAY, PATHWAY_BODY)
SMALL_PATHWAY = _over(shapes.PATHWAY, PATHWAY_BODY)

E1 = _over(
    shapes.WIDE_PATHWAY,
    """
SELECT PATHWAY_ID, PATHWAY_NAME,
  CASE substr(DIGITS, 1, 2) WHEN '11' THEN 'global_map' WHEN '12' THEN 'overview_map'
    WHEN '10' THEN 'chemical_struc_map'
    ELSE CASE substr(DIGITS, 1, 1) WHEN '7' THEN 'drug_struc_map' ELSE 'regular_map' END END AS PATHWAY_CLASS
FROM (SELECT replace(PATHWAY_ID, 'hsa', 'P') AS PATHWAY_ID, replace(PATHWAY_ID, 'hsa', '') AS DIGITS,
        split_part(PATHWAY_NAME, ' - ', 1) AS PATHWAY_NAME FROM raw)""",
)

T2_GENE = _over(
    shapes.GENE,
    f"""
SELECT replace(GENE_ID, 'hsa:', 'G') AS GENE_ID, GENE_TYPE,
  CASE WHEN contains(GENE_SYMBOL_AND_NAME, ';') THEN split_part(GENE_SYMBOL_AND_NAME, ';', 2)
    ELSE GENE_SYMBOL_AND_NAME END AS GENE_NAME,
  coalesce(try_cast(split_part({_SPAN}, '..', 1) AS INTEGER), 0) AS CHRSTOP,
  coalesce(try_cast(split_part({_SPAN}, '..', 2) AS INTEGER), 0) AS CHRSTART,
  CAST(contains(CHROMOSOMAL_POSITION, 'complement') AS INTEGER) AS CHR_COMPLEMENT,
  {_CHROMOSOME} AS CHROMOSOME
FROM raw""",
)

_SYMBOLS = """CASE WHEN contains(GENE_SYMBOL_AND_NAME, ';')
  THEN string_split(split_part(GENE_SYMBOL_AND_NAME, ';', 1), ', ') ELSE ['None'] END"""

T2_SYMBOL = _over(
    shapes.GENE,
    f"""
SELECT GENE_ID, unnest(S) AS GENE_SYMBOL, CAST(generate_subscripts(S, 1) AS INTEGER) AS GENE_ALIAS_NO,
  'gene' AS LOOKUP_SOURCE
FROM (SELECT replace(GENE_ID, 'hsa:', 'G') AS GENE_ID, {_SYMBOLS} AS S FROM raw)""",
)

T3_DISEASE = _over(
    shapes.DISEASE,
    """
SELECT replace(DISEASE_ID, 'H', 'DS') AS DISEASE_ID,
  CAST(len(string_split(DISEASE_NAME, '; ')) AS INTEGER) AS DISEASE_NAME_COUNT
FROM raw""",
)
T3_NAME = _over(
    shapes.DISEASE,
    """
SELECT replace(DISEASE_ID, 'H', 'DS') AS DISEASE_ID, unnest(string_split(DISEASE_NAME, '; ')) AS DISEASE_NAME,
  'disease' AS LOOKUP_SOURCE
FROM raw""",
)

T4 = _over(
    shapes.VARIANT,
    """
SELECT CASE WHEN contains(VARIANT_ID, 'v') THEN 'V' || regexp_extract(VARIANT_ID, '^(.*)v(.*)$', 1) END AS VARIANT_ID,
  VARIANT_NAME,
  CASE WHEN contains(VARIANT_ID, 'v') THEN try_cast(regexp_extract(VARIANT_ID, '^(.*)v(.*)$', 2) AS INTEGER) END
    AS VARIANT_VERSION,
  split_part(VARIANT_NAME, ' ', 1) AS GENE_SYMBOL
FROM raw""",
)

_MODULE_NAMES = """string_split(replace(replace(
  regexp_replace(MODULE_NAME, ',[^,]*$', ''), ' (', ','), ')', ''), ',')"""
T5_MODULE = _over(
    shapes.MODULE,
    f"SELECT MODULE_ID, CAST(len({_MODULE_NAMES}) AS INTEGER) AS MODULE_NAME_COUNT FROM raw",
)
T5_NAME = _over(
    shapes.MODULE,
    f"SELECT MODULE_ID, unnest({_MODULE_NAMES}) AS MODULE_NAME, 'module' AS LOOKUP_SOURCE FROM raw",
)

_PATHWAY_LINK = "replace(replace(PATHWAY_ID, 'path:hsa', 'P'), 'path:map', 'P') AS PATHWAY_ID"
T6_PATHWAY_GENE = _over(
    shapes.PATHWAY_GENE, f"SELECT {_PATHWAY_LINK}, replace(GENE_ID, 'hsa:', 'G') AS GENE_ID FROM raw"
)
T6_PATHWAY_MODULE = _over(
    shapes.PATHWAY_MODULE, f"SELECT {_PATHWAY_LINK}, replace(MODULE_ID, 'md:', '') AS MODULE_ID FROM raw"
)
T6_PATHWAY_DISEASE = _over(
    shapes.PATHWAY_DISEASE,
    f"SELECT {_PATHWAY_LINK}, replace(DISEASE_ID, 'ds:H', 'DS') AS DISEASE_ID FROM raw",
)
T6_GENE_DISEASE = sql(
    """
SELECT 'G' || CAST(l_partkey AS STRING) AS GENE_ID, 'DS' || CAST(l_orderkey AS STRING) AS DISEASE_ID
FROM {lineitem}"""
)
T6_NCBI_GENE = _over(
    shapes.NCBI_GENE,
    """
SELECT replace(NCBI_GENE_ID, 'ncbi-geneid:', 'G') AS NCBI_GENE_ID, replace(GENE_ID, 'hsa:', 'G') AS GENE_ID
FROM raw""",
)

# --- annotation files ------------------------------------------------------------


def _bar(column: str) -> str:
    return f"""CASE {column} WHEN '-' THEN 'Unknown' WHEN 'Un' THEN 'Unknown' WHEN 'X|Y' THEN 'X;Y'
    WHEN 'XY' THEN 'X;Y' ELSE replace({column}, '|', ';') END"""


T7_INFO = _over(
    shapes.GENE_INFO,
    f"""
SELECT 'G' || GeneID AS GENE_ID, {_bar('chromosome')} AS CHROMOSOME, {_bar('map_location')} AS MAP_LOCATION,
  description AS DESCRIPTION,
  CASE type_of_gene WHEN 'protein-coding' THEN 'CDS' WHEN 'unknown' THEN 'Unknown' ELSE type_of_gene END AS GENE_TYPE,
  nullif(CASE WHEN Symbol_from_nomenclature_authority = '-' THEN Symbol
    ELSE Symbol_from_nomenclature_authority END, '-') AS GENE_SYMBOL,
  nullif(Full_name_from_nomenclature_authority, '-') AS GENE_NAME,
  CAST(Nomenclature_status = 'O' AS INTEGER) AS NOMENCLATURE_STATUS
FROM raw WHERE "#tax_id" = 9606""",
)


def _bar_items(column: str) -> str:
    return f"""(SELECT * FROM (
  SELECT 'G' || GeneID AS GENE_ID, unnest(string_split({column}, '|')) AS ITEM
  FROM raw WHERE "#tax_id" = 9606 AND {column} <> '-') WHERE ITEM <> 'NaN')"""


T7_SYMBOL = _over(
    shapes.GENE_INFO,
    f"SELECT GENE_ID, ITEM AS GENE_SYMBOL, 'gene_info' AS LOOKUP_SOURCE FROM {_bar_items('Synonyms')}",
)
T7_DBXREF = _over(
    shapes.GENE_INFO,
    f"""
SELECT GENE_ID, split_part(ITEM, ':', -1) AS REF_ID, split_part(ITEM, ':', 1) AS REF, 'gene_info' AS LOOKUP_SOURCE
FROM {_bar_items('dbXrefs')}""",
)
T7_OTHERDESIG = _over(
    shapes.GENE_INFO,
    f"""
SELECT GENE_ID, ITEM AS OTHER_DESIGNATIONS, 'gene_info' AS LOOKUP_SOURCE
FROM {_bar_items('Other_designations')}""",
)
T7_FEATURE = _over(
    shapes.GENE_INFO,
    f"""
SELECT GENE_ID, split_part(ITEM, ':', 1) AS FEATURE_CAT, string_split(ITEM, ':')[2] AS FEATURE,
  'gene_info' AS LOOKUP_SOURCE
FROM {_bar_items('Feature_type')}""",
)
T8 = _over(
    shapes.GENE_ORTHOLOGS,
    """
SELECT 'G' || GeneID AS GENE_ID, CAST(Other_tax_id AS INTEGER) AS OTHER_TAX_ID, Other_GeneID AS OTHER_GENE_ID
FROM raw WHERE "#tax_id" = 9606""",
)
T9 = _over(
    shapes.GENE2GO,
    """
SELECT 'G' || GeneID AS GENE_ID, replace(GO_ID, ':', '') AS GO_ID, Evidence AS EVIDENCE, Qualifier AS QUALIFIER,
  GO_term AS GO_TERM, Category AS CATEGORY
FROM raw WHERE "#tax_id" = 9606""",
)

# --- document-summary records ------------------------------------------------------

T10_SUMMARY = _over(
    shapes.GENE_SUMMARY_DUCKDB,
    """
SELECT 'G' || UID AS GENE_ID, nullif(NOMENCLATURESYMBOL, '') AS GENE_SYMBOL, DESCRIPTION,
  CASE WHEN CHROMOSOME IS NULL OR CHROMOSOME IN ('', 'Un') THEN 'Unknown'
    ELSE replace(CHROMOSOME, ', ', ';') END AS CHROMOSOME,
  nullif(MAPLOCATION, '') AS MAP_LOCATION, nullif(NOMENCLATURENAME, '') AS GENE_NAME, GENEWEIGHT AS GENE_WEIGHT,
  nullif(SUMMARY, '') AS SUMMARY,
  CAST(CASE GENOMICINFO[1]."ChrStart" WHEN 999999999 THEN 0 ELSE coalesce(GENOMICINFO[1]."ChrStart", 0) END
    AS INTEGER) AS CHRSTART,
  CAST(coalesce(GENOMICINFO[1]."ChrStop", 0) AS INTEGER) AS CHRSTOP,
  CAST(GENOMICINFO[1]."ExonCount" AS DOUBLE) AS EXONCOUNT
FROM raw""",
)
T10_SYMBOL = _over(
    shapes.GENE_SUMMARY_DUCKDB,
    """
SELECT GENE_ID, GENE_SYMBOL, 'gene_summary' AS LOOKUP_SOURCE FROM (
  SELECT 'G' || UID AS GENE_ID, unnest(string_split(OTHERALIASES, ', ')) AS GENE_SYMBOL
  FROM raw WHERE OTHERALIASES <> ''
  UNION ALL
  SELECT 'G' || UID, NAME FROM raw
  WHERE NOMENCLATURESYMBOL IS NOT NULL AND NAME IS DISTINCT FROM replace(NOMENCLATURESYMBOL, 'MT-', ''))""",
)
T10_OMIM = _over(
    shapes.GENE_SUMMARY_DUCKDB,
    """
SELECT 'G' || UID AS GENE_ID, try_cast(unnest(MIM) AS INTEGER) AS OMIM_ID, 'gene_summary' AS LOOKUP_SOURCE
FROM raw""",
)


def _keyed(key: str) -> str:
    return f"split_part(list_filter(string_split(DOCSUM, '|'), lambda e: split_part(e, '=', 1) = '{key}')[-1], '=', 2)"


T11_SUMMARY = _over(
    shapes.SNP_SUMMARY,
    f"""
SELECT 'rs' || SNP_ID AS SNP_ID, CHRPOS AS MAP_LOCATION, {_keyed('SEQ')} AS SEQ,
  nullif(CLINICAL_SIGNIFICANCE, '') AS CLINICAL_SIGNIFICANCE, CHR AS CHROMOSOME, SPDI, VALIDATED,
  try_cast(UPD_BUILD AS INTEGER) AS UPD_BUILD, ALLELE, SNP_CLASS, try_cast({_keyed('LEN')} AS INTEGER) AS LEN,
  {_keyed('HGVS')} AS HGVS
FROM raw""",
)
T11_GENE = _over(
    shapes.SNP_SUMMARY,
    """
SELECT 'rs' || SNP_ID AS SNP_ID, unnest(regexp_extract_all(GENES, '''GENE_ID'': ''([^'']*)''', 1)) AS GENE_ID,
  'snp_summary' AS LOOKUP_SOURCE
FROM raw""",
)


def _commas(column: str) -> str:
    return f"""
SELECT SNP_ID, {column}, 'snp_summary' AS LOOKUP_SOURCE FROM (
  SELECT 'rs' || SNP_ID AS SNP_ID, unnest(string_split({column}, ',')) AS {column} FROM raw) WHERE {column} <> ''"""


T11_FXN = _over(shapes.SNP_SUMMARY, _commas("FXN_CLASS"))
T11_SS = _over(shapes.SNP_SUMMARY, _commas("SS"))

# --- queries across tables ---------------------------------------------------------


def _with(body: str, **tables: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in tables.items()) + f"\n{body.strip()}"


J1 = _with(
    """
SELECT GENE_ID, coalesce(GENE_TYPE, GENE_TYPE_KEGG) AS GENE_TYPE, NOMENCLATURE_STATUS, GENE_SYMBOL, DESCRIPTION,
  CHROMOSOME, MAP_LOCATION, GENE_NAME, GENE_WEIGHT, SUMMARY, CHRSTART, CHRSTOP, EXONCOUNT, CHR_COMPLEMENT,
  CASE WHEN GENE_TYPE_KEGG <> coalesce(GENE_TYPE, GENE_TYPE_KEGG) THEN GENE_TYPE_KEGG END AS GENE_TYPE_ALT
FROM (SELECT GENE_ID, GENE_TYPE, NOMENCLATURE_STATUS FROM info) FULL OUTER JOIN summary USING (GENE_ID)
FULL OUTER JOIN (
  SELECT coalesce(NCBI_GENE_ID, GENE_ID) AS GENE_ID, CHR_COMPLEMENT, GENE_TYPE AS GENE_TYPE_KEGG
  FROM gene LEFT JOIN pairs USING (GENE_ID)) USING (GENE_ID)""",
    info=T7_INFO,
    summary=T10_SUMMARY,
    gene=T2_GENE,
    pairs=T6_NCBI_GENE,
)
J2 = _with(
    """
SELECT PATHWAY_ID, PATHWAY_NAME, GENE_ID, GENE_NAME, CHROMOSOME
FROM edge JOIN pathway USING (PATHWAY_ID) JOIN gene USING (GENE_ID)""",
    edge=T6_PATHWAY_GENE,
    pathway=SMALL_PATHWAY,
    gene=T2_GENE,
)
J3_MODULES = _with(
    """
SELECT PATHWAY_ID, PATHWAY_NAME, MODULE_ID, MODULE_NAME_COUNT
FROM edge JOIN pathway USING (PATHWAY_ID) JOIN module USING (MODULE_ID)""",
    edge=T6_PATHWAY_MODULE,
    pathway=SMALL_PATHWAY,
    module=T5_MODULE,
)
J3_DISEASES = _with(
    """
SELECT PATHWAY_ID, PATHWAY_NAME, DISEASE_ID, DISEASE_NAME_COUNT
FROM edge JOIN pathway USING (PATHWAY_ID) JOIN disease USING (DISEASE_ID)""",
    edge=T6_PATHWAY_DISEASE,
    pathway=SMALL_PATHWAY,
    disease=T3_DISEASE,
)
J4 = _with(
    """
SELECT GENE_ID, GENE_NAME, DISEASE_ID, DISEASE_NAME_COUNT
FROM edge JOIN gene USING (GENE_ID) JOIN disease USING (DISEASE_ID)""",
    edge=T6_GENE_DISEASE,
    gene=T2_GENE,
    disease=T3_DISEASE,
)
J5 = _with(
    """
SELECT gene.GENE_ID, pairs.NCBI_GENE_ID, info.GENE_SYMBOL, gene.GENE_TYPE, info.GENE_TYPE AS NCBI_GENE_TYPE
FROM pairs JOIN gene ON pairs.GENE_ID = gene.GENE_ID JOIN info ON pairs.NCBI_GENE_ID = info.GENE_ID""",
    pairs=T6_NCBI_GENE,
    gene=T2_GENE,
    info=T7_INFO,
)
J6 = _with(
    """
SELECT info.GENE_ID, info.GENE_SYMBOL, snp.SNP_ID, snp.SNP_CLASS
FROM edge JOIN info ON info.GENE_ID = 'G' || edge.GENE_ID JOIN snp ON snp.SNP_ID = edge.SNP_ID""",
    edge=T11_GENE,
    info=T7_INFO,
    snp=T11_SUMMARY,
)
J7_GO = _with(
    "SELECT GENE_ID, GENE_SYMBOL, GO_ID, GO_TERM, CATEGORY FROM term JOIN info USING (GENE_ID)",
    term=T9,
    info=T7_INFO,
)
J7_ORTHOLOGS = _with(
    "SELECT GENE_ID, GENE_SYMBOL, OTHER_TAX_ID, OTHER_GENE_ID FROM other JOIN info USING (GENE_ID)",
    other=T8,
    info=T7_INFO,
)
_ALIASES = f"""
SELECT GENE_ID, GENE_SYMBOL, LOOKUP_SOURCE FROM ({T2_SYMBOL})
UNION ALL SELECT GENE_ID, GENE_SYMBOL, LOOKUP_SOURCE FROM ({T7_SYMBOL})
UNION ALL SELECT GENE_ID, GENE_SYMBOL, LOOKUP_SOURCE FROM ({T10_SYMBOL})"""
J8_ALIASES = _ALIASES.strip()
J8_VARIANTS = _with(
    """
SELECT VARIANT_ID, VARIANT_VERSION, GENE_SYMBOL, GENE_ID, LOOKUP_SOURCE
FROM variant JOIN alias USING (GENE_SYMBOL)
WHERE GENE_SYMBOL NOT IN ('', 'None')""",
    variant=T4,
    alias=_ALIASES,
)

# --- single operators ----------------------------------------------------------------

R9 = """
SELECT GENE_ID, GENE_SYMBOL, 'gene' AS LOOKUP_SOURCE,
  CAST(row_number() OVER (PARTITION BY GENE_ID ORDER BY o_orderkey, POS) AS INTEGER) AS GENE_ALIAS_NO
FROM (SELECT o_orderkey, 'G' || CAST(o_custkey AS STRING) AS GENE_ID, unnest(S) AS GENE_SYMBOL,
        generate_subscripts(S, 1) AS POS
      FROM (SELECT *, string_split('SYM' || CAST(o_orderkey AS STRING) || ', ' || o_orderpriority
              || CASE WHEN o_orderstatus = 'P' THEN ', pending' ELSE '' END, ', ') AS S FROM orders))"""

R10 = """
SELECT CAST(o_orderkey AS STRING) AS UID, o_orderstatus AS STATUS, NULL::VARCHAR AS CHROMOSOME FROM orders
UNION ALL
SELECT CAST(event_id AS STRING), NULL, event_type FROM events"""

R12 = """
SELECT coalesce(a.KEY, b.KEY) AS KEY, a.LINES, b.NAME
FROM (SELECT l_partkey * 3 AS KEY, l_linenumber AS LINES FROM lineitem) a
FULL OUTER JOIN (SELECT o_orderkey * 2 AS KEY, o_orderpriority AS NAME FROM orders) b
ON a.KEY = b.KEY"""

R19 = f"""
SELECT DISEASE_ID, CAST(count(*) AS INTEGER) AS DISEASE_NAME_COUNT FROM ({T3_NAME}) GROUP BY DISEASE_ID"""

E25 = """
SELECT CAST(o_orderkey AS STRING) AS UID, CAST(o_custkey AS INTEGER) AS TAX_ID FROM orders"""

# --- checks -----------------------------------------------------------------------------


def _violation(table: str, rule: str, column: str, key: str, n: str) -> str:
    return (
        f"'{table}' AS TABLE_NAME, '{rule}' AS RULE, '{column}' AS COLUMN_NAME, "
        f"{key} AS KEY_VALUE, CAST({n} AS BIGINT) AS N_ROWS"
    )


V2 = f"""
SELECT {_violation('kegg_human_disease', 'unique', 'DISEASE_ID', 'DISEASE_ID', 'count(*)')}
FROM (SELECT 'DS' || CAST(o_custkey AS STRING) AS DISEASE_ID FROM orders) GROUP BY DISEASE_ID HAVING count(*) > 1"""

V4 = f"""
SELECT {_violation('kegg_human_disease_name_lookup', 'reference', 'DISEASE_ID', 'DISEASE_ID', 'count(*)')}
FROM (SELECT 'DS' || CAST(l_orderkey AS STRING) AS DISEASE_ID FROM lineitem) c
WHERE NOT EXISTS (SELECT 1 FROM (SELECT 'DS' || CAST(c_custkey AS STRING) AS DISEASE_ID FROM customer) p
  WHERE p.DISEASE_ID = c.DISEASE_ID)
GROUP BY DISEASE_ID"""


def _count_rows(table: str, source: str, counts: list[tuple[str, str, str]]) -> str:
    parts = [
        f"SELECT {_violation(table, rule, column, 'NULL::VARCHAR', f'count(*) FILTER (WHERE {bad})')} FROM t"
        for rule, column, bad in counts
    ]
    return f"WITH t AS ({source})\nSELECT * FROM (" + "\nUNION ALL ".join(parts) + ") WHERE N_ROWS > 0"


_LOOSE_VARIANT = """
SELECT CASE WHEN event_type <> 'error' THEN 'V' || CAST(user_id AS STRING) END AS VARIANT_ID,
  'name of ' || props || ' ' || event_type AS VARIANT_NAME,
  CASE event_type WHEN 'view' THEN 'x' || CAST(event_id AS STRING) ELSE CAST(event_id AS STRING) END AS VARIANT_VERSION,
  'SYM' || repeat(event_type, 4) AS GENE_SYMBOL
FROM events"""
_NULLS = [
    ("not_null", c, f"{c} IS NULL") for c in ("VARIANT_ID", "VARIANT_NAME", "VARIANT_VERSION", "GENE_SYMBOL")
]
_WIDTHS = [
    ("width", c, f"length({c}) > {n}") for c, n in (("VARIANT_ID", 10), ("VARIANT_NAME", 100), ("GENE_SYMBOL", 20))
]
_KINDS = [("type", "VARIANT_VERSION", "VARIANT_VERSION IS NOT NULL AND try_cast(VARIANT_VERSION AS INTEGER) IS NULL")]
V3_V5_V6 = _count_rows("kegg_human_variant", _LOOSE_VARIANT, _NULLS + _WIDTHS + _KINDS)

# --- sources, sinks, refresh -------------------------------------------------------------

S1 = sql(shapes.GENE)
S2 = sql(shapes.GENE2GO).replace('AS "#tax_id"', 'AS "#tax_id_n"')
S2 = f"""SELECT CAST("#tax_id_n" AS STRING) AS "#tax_id", * EXCLUDE ("#tax_id_n") FROM ({S2})"""

S3 = """
SELECT CAST(o_orderkey AS STRING) AS UID, 'N' || CAST(o_custkey AS STRING) AS NAME, o_orderpriority AS DESCRIPTION,
  'G' || o_orderstatus AS NOMENCLATURESYMBOL,
  CAST(o_custkey AS INTEGER) AS CHRSTART, CAST(o_orderkey AS INTEGER) AS CHRSTOP, CAST(9606 AS INTEGER) AS TAX_ID,
  CAST(o_custkey AS STRING) AS MIM_ID
FROM orders"""

S5_S6 = T10_SUMMARY
S7 = f"SELECT * FROM ({T3_DISEASE}) UNION ALL SELECT * FROM ({T3_DISEASE})"
S7_OVERWRITE = T6_PATHWAY_GENE
S9 = f"""
SELECT 'gene' AS SRC_TABLE, count(*) AS N_LINES FROM part
UNION ALL SELECT 'gene_disease', count(*) FROM lineitem
UNION ALL SELECT 'pathway', 2 * count(*) FROM supplier"""
S10 = """
SELECT CAST(l_orderkey AS STRING) AS _c0, 'R-HSA-' || CAST(l_partkey AS STRING) AS _c1,
  CAST(l_suppkey AS STRING) AS _c2, l_returnflag AS _c3
FROM lineitem"""

_KEGG_TABLES = {
    "kegg_human_pathway": SMALL_PATHWAY,
    "kegg_human_gene": T2_GENE,
    "kegg_human_gene_symbol_lookup": T2_SYMBOL,
    "kegg_human_disease": T3_DISEASE,
    "kegg_human_disease_name_lookup": T3_NAME,
    "kegg_human_variant": T4,
    "kegg_human_module": T5_MODULE,
    "kegg_human_module_name_lookup": T5_NAME,
    "kegg_human_pathway_gene_lookup": T6_PATHWAY_GENE,
    "kegg_human_pathway_module_lookup": T6_PATHWAY_MODULE,
    "kegg_human_pathway_disease_lookup": T6_PATHWAY_DISEASE,
    "kegg_human_gene_disease_lookup": T6_GENE_DISEASE,
    "kegg_human_ncbi_gene_lookup": T6_NCBI_GENE,
}
_NCBI_TABLES = {
    "ncbi_human_gene_info": T7_INFO,
    "ncbi_human_gene_info_symbol_lookup": T7_SYMBOL,
    "ncbi_human_gene_info_dbxref_lookup": T7_DBXREF,
    "ncbi_human_gene_info_otherdesig_lookup": T7_OTHERDESIG,
    "ncbi_human_gene_info_feature_lookup": T7_FEATURE,
    "ncbi_human_gene_orthologs": T8,
    "ncbi_human_gene2go": T9,
    "ncbi_human_gene_summary": T10_SUMMARY,
    "ncbi_human_gene_summary_symbol_lookup": T10_SYMBOL,
    "ncbi_human_gene_summary_omim_lookup": T10_OMIM,
    "ncbi_human_snp_summary": T11_SUMMARY,
    "ncbi_human_snp_summary_gene_lookup": T11_GENE,
    "ncbi_human_snp_summary_fxn_lookup": T11_FXN,
    "ncbi_human_snp_summary_ss_lookup": T11_SS,
}


def _counts(tables: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS TABLE_NAME, count(*) AS N_ROWS FROM ({text})" for name, text in tables.items()
    )


T13 = _over(
    shapes.GENE_ORTHOLOGS,
    """
SELECT 'G' || GeneID AS GENE_ID, relationship AS RELATIONSHIP, Other_tax_id AS OTHER_TAX_ID,
  Other_GeneID AS OTHER_GENE_ID
FROM raw WHERE "#tax_id" = 9606""",
)
T14_KEGG = _counts(_KEGG_TABLES)
T14_NCBI = _counts(_NCBI_TABLES)

T15_REPLACE = """
SELECT l_orderkey AS ID, l_linenumber AS VALUE FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT o_custkey, CAST(o_orderkey AS INTEGER) FROM orders"""

# Orders of status P get another name on the second day, and customers' numbers are new records.
T15 = """
SELECT DISEASE_ID, NAME FROM (
  SELECT 'DS' || CAST(o_orderkey AS STRING) AS DISEASE_ID,
    CASE o_orderstatus WHEN 'P' THEN 'new ' || o_orderpriority ELSE o_orderpriority END AS NAME FROM orders
  UNION ALL SELECT 'C' || CAST(c_custkey AS STRING), c_name FROM customer)"""

ORACLES = {
    "t01_pathway": T1,
    "t02_gene": T2_GENE,
    "t02_gene_symbol_lookup": T2_SYMBOL,
    "t03_disease": T3_DISEASE,
    "t03_disease_name_lookup": T3_NAME,
    "t04_variant": T4,
    "t05_module": T5_MODULE,
    "t05_module_name_lookup": T5_NAME,
    "t06_pathway_gene": T6_PATHWAY_GENE,
    "t06_pathway_module": T6_PATHWAY_MODULE,
    "t06_pathway_disease": T6_PATHWAY_DISEASE,
    "t06_gene_disease": T6_GENE_DISEASE,
    "t06_ncbi_gene": T6_NCBI_GENE,
    "t07_gene_info": T7_INFO,
    "t07_gene_info_symbol_lookup": T7_SYMBOL,
    "t07_gene_info_dbxref_lookup": T7_DBXREF,
    "t07_gene_info_otherdesig_lookup": T7_OTHERDESIG,
    "t07_gene_info_feature_lookup": T7_FEATURE,
    "t08_gene_orthologs": T8,
    "t09_gene2go": T9,
    "t10_gene_summary": T10_SUMMARY,
    "t10_gene_summary_symbol_lookup": T10_SYMBOL,
    "t10_gene_summary_omim_lookup": T10_OMIM,
    "t11_snp_summary": T11_SUMMARY,
    "t11_snp_summary_gene_lookup": T11_GENE,
    "t11_snp_summary_fxn_lookup": T11_FXN,
    "t11_snp_summary_ss_lookup": T11_SS,
    "t12_j01_gene_merged": J1,
    "t13_human_rows": T13,
    "t14_refresh_kegg": T14_KEGG,
    "t14_refresh_ncbi": T14_NCBI,
    "t15_upsert": T15,
    "t15_replace_keys": T15_REPLACE,
    "t15_new_files": T6_PATHWAY_GENE,
    "j02_pathway_genes": J2,
    "j03_pathway_modules": J3_MODULES,
    "j03_pathway_diseases": J3_DISEASES,
    "j04_gene_diseases": J4,
    "j05_matched_genes": J5,
    "j06_gene_snps": J6,
    "j07_gene_go_terms": J7_GO,
    "j07_gene_orthologs": J7_ORTHOLOGS,
    "j04_laid_out": J4,
    "j06_laid_out": J6,
    "j07_laid_out": J7_GO,
    "j08_gene_aliases": J8_ALIASES,
    "j08_variant_genes": J8_VARIANTS,
    "e01_pathway_class": E1,
    "e25_organism_tax_id": E25,
    "r09_running_number": R9,
    "r10_union_by_name": R10,
    "r11_ordered_summary": T10_SUMMARY,
    "r12_full_outer": R12,
    "r19_group_count": R19,
    "v02_unique": V2,
    "v03_v05_v06_columns": V3_V5_V6,
    "v04_reference": V4,
    "s01_tab_list": S1,
    "s02_tab_header_gzip": S2,
    "s03_docsum_xml": S3,
    "s04_paged_union": R10,
    "s05_s06_stage_parquet": S5_S6,
    "s05_s06_stage_csv": S5_S6,
    "s07_sink_append": S7,
    "s07_sink_overwrite": S7_OVERWRITE,
    "s09_landed_tables": S9,
    "s10_generic_tab": S10,
}

ORACLES.update(landed.oracles({name: ORACLES[name] for name in landed.JOB_OUTPUTS}))
ORACLES.update(versioned.oracles(ORACLES))
