"""Jobs for the gene source: annotation files and document-summary records.

One function per processed table, each a single narrow pass over the raw rows
that reads only the columns it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.functions import identifiers as ids
from codonmill.functions import names, positions, text
from codonmill.operators.columns import upper_columns
from codonmill.operators.lookup import lookup
from codonmill.schemas import rules

# --- annotation files --------------------------------------------------------


def only_human(df: DataFrame, column: str = "#tax_id") -> DataFrame:
    """Human rows. The taxon is compared in its own type, so the filter reaches the scan."""
    kinds = {name.upper(): kind for name, kind in df.dtypes}
    is_text = kinds[column.upper()] == "string"
    return df.where(F.col(f"`{column}`") == (str(fv.HUMAN_TAX_ID) if is_text else fv.HUMAN_TAX_ID))


def human_rows(raw: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Human rows under standard names and gene ids."""
    df = upper_columns(raw).withColumnsRenamed(
        {"#TAX_ID": "TAX_ID", "GENEID": "GENE_ID", **(renames or {})}
    )
    return (
        only_human(df, "TAX_ID")
        .drop("TAX_ID")
        .withColumn("GENE_ID", ids.prefixed(fv.GENE_PREFIX, F.col("GENE_ID")))
    )


def gene_info(raw: DataFrame) -> DataFrame:
    df = human_rows(
        raw, {"FULL_NAME_FROM_NOMENCLATURE_AUTHORITY": "NAME", "TYPE_OF_GENE": "GENE_TYPE"}
    )
    authority = F.col("SYMBOL_FROM_NOMENCLATURE_AUTHORITY")
    return df.select(
        "GENE_ID",
        positions.bar_chromosome(F.col("CHROMOSOME")).alias("CHROMOSOME"),
        positions.bar_chromosome(F.col("MAP_LOCATION")).alias("MAP_LOCATION"),
        "DESCRIPTION",
        names.gene_type(F.col("GENE_TYPE")).alias("GENE_TYPE"),
        names.approved_symbol(authority, F.col("SYMBOL")).alias("GENE_SYMBOL"),
        names.unless(F.col("NAME"), fv.DASH).alias("GENE_NAME"),
        names.flag(F.col("NOMENCLATURE_STATUS"), "O").alias("NOMENCLATURE_STATUS"),
    )


def _info_values(raw: DataFrame, column: str, name: str) -> DataFrame:
    return lookup(
        human_rows(raw),
        F.col("GENE_ID"),
        names.bar_values(F.col(column)),
        name,
        "gene_info",
        drop=[fv.DASH_PLACEHOLDER],
    )


def gene_info_symbol_lookup(raw: DataFrame) -> DataFrame:
    return _info_values(raw, "SYNONYMS", "GENE_SYMBOL")


def gene_info_dbxref_lookup(raw: DataFrame) -> DataFrame:
    item = F.col("DBXREF")
    return _info_values(raw, "DBXREFS", "DBXREF").select(
        "GENE_ID",
        text.after_last(item, ":").alias("REF_ID"),
        text.before(item, ":").alias("REF"),
        "LOOKUP_SOURCE",
    )


def gene_info_otherdesig_lookup(raw: DataFrame) -> DataFrame:
    return _info_values(raw, "OTHER_DESIGNATIONS", "OTHER_DESIGNATIONS")


def gene_info_feature_lookup(raw: DataFrame) -> DataFrame:
    item = F.col("FEATURE_TYPE")
    return _info_values(raw, "FEATURE_TYPE", "FEATURE_TYPE").select(
        "GENE_ID",
        text.before(item, ":").alias("FEATURE_CAT"),
        names.feature_name(item).alias("FEATURE"),
        "LOOKUP_SOURCE",
    )


def gene_orthologs(raw: DataFrame) -> DataFrame:
    return human_rows(raw, {"OTHER_GENEID": "OTHER_GENE_ID"}).drop("RELATIONSHIP")


def gene2go(raw: DataFrame) -> DataFrame:
    df = human_rows(raw).drop("PUBMED")
    return df.withColumn("GO_ID", ids.rewrite(F.col("GO_ID"), fv.GO_REWRITES))


# --- document-summary records ------------------------------------------------

def _gene_id() -> Column:
    return ids.prefixed(fv.GENE_PREFIX, F.col("UID")).alias("GENE_ID")


def gene_summary(raw: DataFrame) -> DataFrame:
    """One row per record. The writer puts the table in order of gene id."""

    def first(field: str) -> Column:
        return positions.genomic_info(F.col("GENOMICINFO"), field)

    return raw.select(
        _gene_id(),
        names.unless(F.col("NOMENCLATURESYMBOL"), "").alias("GENE_SYMBOL"),
        "DESCRIPTION",
        positions.comma_chromosome(F.col("CHROMOSOME")).alias("CHROMOSOME"),
        names.unless(F.col("MAPLOCATION"), "").alias("MAP_LOCATION"),
        names.unless(F.col("NOMENCLATURENAME"), "").alias("GENE_NAME"),
        F.col("GENEWEIGHT").alias("GENE_WEIGHT"),
        names.unless(F.col("SUMMARY"), "").alias("SUMMARY"),
        positions.start_or_zero(first("CHRSTART")).alias("CHRSTART"),
        F.coalesce(first("CHRSTOP"), F.lit(0)).alias("CHRSTOP"),
        first("EXONCOUNT").alias("EXONCOUNT"),
    )


def gene_summary_symbol_lookup(raw: DataFrame) -> DataFrame:
    """Aliases of each gene, and its name where that is not its official symbol.

    Both come from one pass: the name joins the list of aliases before the list
    is taken apart.
    """
    aliases, name = F.col("OTHERALIASES"), F.col("NAME")
    listed = F.when(aliases.isNotNull() & (aliases != ""), names.comma_space_values(aliases))
    other = F.when(names.is_other_name(name, F.col("NOMENCLATURESYMBOL")), F.array(name))
    none = F.array().cast("array<string>")
    both = F.concat(F.coalesce(listed, none), F.coalesce(other, none))
    return lookup(raw, _gene_id(), both, "GENE_SYMBOL", "gene_summary", keep_null=True)


def gene_summary_omim_lookup(raw: DataFrame) -> DataFrame:
    return lookup(raw, _gene_id(), F.col("MIM"), "OMIM_ID", "gene_summary")


def snp_summary(raw: DataFrame) -> DataFrame:
    df = upper_columns(raw).withColumnsRenamed({"CHR": "CHROMOSOME", "CHRPOS": "MAP_LOCATION"})
    made = {
        "SNP_ID": ids.prefixed(fv.SNP_PREFIX, F.col("SNP_ID")),
        "CLINICAL_SIGNIFICANCE": names.unless(F.col("CLINICAL_SIGNIFICANCE"), ""),
        **{key: names.keyed_value(F.col("DOCSUM"), key) for key in ("SEQ", "LEN", "HGVS")},
        **{
            name: F.lit(None).cast("string")
            for name in ("CHROMOSOME", "MAP_LOCATION")
            if name not in df.columns
        },
    }
    columns = [rule.name for rule in rules("ncbi_human_snp_summary")]
    return df.select(*[made.get(name, F.col(name)).alias(name) for name in columns])


def _snp_values(raw: DataFrame, listed: Column, name: str) -> DataFrame:
    snp_id = ids.prefixed(fv.SNP_PREFIX, F.col("SNP_ID")).alias("SNP_ID")
    return lookup(raw, snp_id, listed, name, "snp_summary", drop=[""])


def snp_summary_gene_lookup(raw: DataFrame) -> DataFrame:
    return _snp_values(raw, names.literal_gene_ids(F.col("GENES")), "GENE_ID")


def snp_summary_fxn_lookup(raw: DataFrame) -> DataFrame:
    return _snp_values(raw, names.comma_values(F.col("FXN_CLASS")), "FXN_CLASS")


def snp_summary_ss_lookup(raw: DataFrame) -> DataFrame:
    return _snp_values(raw, names.comma_values(F.col("SS")), "SS")
