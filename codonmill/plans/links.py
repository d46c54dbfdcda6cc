"""Queries across the processed tables.

All joins are equi-joins on standard identifiers. No side is marked for
broadcast: the planner broadcasts what its size estimate or the measured shuffle
size allows and splits skewed partitions otherwise. Columns are picked before the
joins' shuffles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.functions import identifiers as ids
from codonmill.operators.outer_join import full_outer


def gene_merged(
    gene_info: DataFrame, gene_summary: DataFrame, gene: DataFrame, ncbi_gene_lookup: DataFrame
) -> DataFrame:
    """One profile per gene from both sources; a gene known to either is kept.

    Gene id is the primary key of the two annotation tables, so their outer join
    cannot be skewed. The listed genes get their id from the other source's, and
    many may get the same.
    """
    listed = (
        gene.select("GENE_ID", "CHR_COMPLEMENT", F.col("GENE_TYPE").alias("GENE_TYPE_KEGG"))
        .join(ncbi_gene_lookup.select("GENE_ID", "NCBI_GENE_ID"), "GENE_ID", "left")
        .select(
            F.coalesce("NCBI_GENE_ID", "GENE_ID").alias("GENE_ID"),
            "CHR_COMPLEMENT",
            "GENE_TYPE_KEGG",
        )
    )
    info = gene_info.select("GENE_ID", "GENE_TYPE", "NOMENCLATURE_STATUS")
    has_id = F.col("GENE_ID").isNotNull()
    annotated = info.where(has_id).join(gene_summary.where(has_id), "GENE_ID", "full_outer")
    gene_type = F.coalesce("GENE_TYPE", "GENE_TYPE_KEGG")
    return full_outer(listed, annotated, "GENE_ID").select(
        "GENE_ID",
        gene_type.alias("GENE_TYPE"),
        "NOMENCLATURE_STATUS",
        *[name for name in gene_summary.columns if name != "GENE_ID"],
        "CHR_COMPLEMENT",
        F.when(F.col("GENE_TYPE_KEGG") != gene_type, F.col("GENE_TYPE_KEGG")).alias("GENE_TYPE_ALT"),
    )


def changed_profiles(
    before: dict[str, DataFrame], after: dict[str, DataFrame], changed: dict[str, DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Ids of the profiles that changes of the inputs touch, and these profiles as they are now.

    `before` and `after` are the inputs of `gene_merged` by the names of its arguments, of
    which `before` needs the lookup only; `changed` has for some of them the GENE_IDs with
    inserted, changed or removed rows. A listed gene touches the profile that it belonged to
    and the one that it belongs to. Everything else of the inputs is only looked up by key:
    `incremental.replace_keys(stored, profiles, "GENE_ID", ids)` is the table made anew.
    """
    ids_of = lambda name: changed[name].toDF("GENE_ID").distinct() if name in changed else None
    listed = [ids_of("gene"), ids_of("ncbi_gene_lookup")]
    moved = [ids for ids in listed if ids is not None]
    touched = [ids for ids in (ids_of("gene_info"), ids_of("gene_summary")) if ids is not None]
    if moved:
        genes = reduce(DataFrame.unionByName, moved).distinct()
        for lookup in (before["ncbi_gene_lookup"], after["ncbi_gene_lookup"]):
            mapped = genes.join(lookup.select("GENE_ID", "NCBI_GENE_ID"), "GENE_ID", "left")
            touched.append(mapped.select(F.coalesce("NCBI_GENE_ID", "GENE_ID").alias("GENE_ID")))
    if not touched:
        raise ValueError("no input has changed")
    ids = reduce(DataFrame.unionByName, touched).where("GENE_ID IS NOT NULL").distinct()

    links_now = after["ncbi_gene_lookup"]
    members = links_now.join(ids.toDF("NCBI_GENE_ID"), "NCBI_GENE_ID", "left_semi").select("GENE_ID")
    near = members.unionByName(ids).distinct()
    of = lambda name, keys: after[name].join(keys, "GENE_ID", "left_semi")
    profiles = gene_merged(
        of("gene_info", ids), of("gene_summary", ids), of("gene", near), of("ncbi_gene_lookup", near)
    )
    # A gene that stands under a touched id may belong to a profile that is not.
    return ids, profiles.join(ids, "GENE_ID", "left_semi")


def pathway_genes(pathway: DataFrame, pathway_gene_lookup: DataFrame, gene: DataFrame) -> DataFrame:
    return (
        pathway_gene_lookup.join(pathway.select("PATHWAY_ID", "PATHWAY_NAME"), "PATHWAY_ID")
        .join(gene.select("GENE_ID", "GENE_NAME", "CHROMOSOME"), "GENE_ID")
        .select("PATHWAY_ID", "PATHWAY_NAME", "GENE_ID", "GENE_NAME", "CHROMOSOME")
    )


def pathway_modules(
    pathway: DataFrame, pathway_module_lookup: DataFrame, module: DataFrame
) -> DataFrame:
    return (
        pathway_module_lookup.join(pathway.select("PATHWAY_ID", "PATHWAY_NAME"), "PATHWAY_ID")
        .join(module.select("MODULE_ID", "MODULE_NAME_COUNT"), "MODULE_ID")
        .select("PATHWAY_ID", "PATHWAY_NAME", "MODULE_ID", "MODULE_NAME_COUNT")
    )


def pathway_diseases(
    pathway: DataFrame, pathway_disease_lookup: DataFrame, disease: DataFrame
) -> DataFrame:
    return (
        pathway_disease_lookup.join(pathway.select("PATHWAY_ID", "PATHWAY_NAME"), "PATHWAY_ID")
        .join(disease.select("DISEASE_ID", "DISEASE_NAME_COUNT"), "DISEASE_ID")
        .select("PATHWAY_ID", "PATHWAY_NAME", "DISEASE_ID", "DISEASE_NAME_COUNT")
    )


def gene_diseases(gene: DataFrame, gene_disease_lookup: DataFrame, disease: DataFrame) -> DataFrame:
    return (
        gene_disease_lookup.join(gene.select("GENE_ID", "GENE_NAME"), "GENE_ID")
        .join(disease.select("DISEASE_ID", "DISEASE_NAME_COUNT"), "DISEASE_ID")
        .select("GENE_ID", "GENE_NAME", "DISEASE_ID", "DISEASE_NAME_COUNT")
    )


def matched_genes(gene: DataFrame, ncbi_gene_lookup: DataFrame, gene_info: DataFrame) -> DataFrame:
    """The gene of one source beside the same gene of the other."""
    info = gene_info.select(
        F.col("GENE_ID").alias("NCBI_GENE_ID"), "GENE_SYMBOL", F.col("GENE_TYPE").alias("NCBI_GENE_TYPE")
    )
    return (
        ncbi_gene_lookup.join(gene.select("GENE_ID", "GENE_TYPE"), "GENE_ID")
        .join(info, "NCBI_GENE_ID")
        .select("GENE_ID", "NCBI_GENE_ID", "GENE_SYMBOL", "GENE_TYPE", "NCBI_GENE_TYPE")
    )


def gene_snps(gene_info: DataFrame, snp_gene_lookup: DataFrame, snp_summary: DataFrame) -> DataFrame:
    """Variations of each gene. The lookup holds bare gene numbers, and GENE_KEY if it is laid out."""
    laid_out = "GENE_KEY" in snp_gene_lookup.columns
    gene = F.col("GENE_KEY") if laid_out else ids.prefixed(fv.GENE_PREFIX, F.col("GENE_ID"))
    pairs = snp_gene_lookup.select(gene.alias("GENE_ID"), "SNP_ID")
    return (
        pairs.join(gene_info.select("GENE_ID", "GENE_SYMBOL"), "GENE_ID")
        .join(snp_summary.select("SNP_ID", "SNP_CLASS"), "SNP_ID")
        .select("GENE_ID", "GENE_SYMBOL", "SNP_ID", "SNP_CLASS")
    )


def gene_go_terms(gene_info: DataFrame, gene2go: DataFrame) -> DataFrame:
    return gene2go.join(gene_info.select("GENE_ID", "GENE_SYMBOL"), "GENE_ID").select(
        "GENE_ID", "GENE_SYMBOL", "GO_ID", "GO_TERM", "CATEGORY"
    )


def gene_orthologs(gene_info: DataFrame, orthologs: DataFrame) -> DataFrame:
    return orthologs.join(gene_info.select("GENE_ID", "GENE_SYMBOL"), "GENE_ID").select(
        "GENE_ID", "GENE_SYMBOL", "OTHER_TAX_ID", "OTHER_GENE_ID"
    )


def gene_aliases(*symbol_lookups: DataFrame) -> DataFrame:
    """All symbols of all genes; LOOKUP_SOURCE tells who gave them."""
    columns = ["GENE_ID", "GENE_SYMBOL", "LOOKUP_SOURCE"]
    return reduce(DataFrame.unionByName, [df.select(*columns) for df in symbol_lookups])


def variant_genes(variant: DataFrame, aliases: DataFrame) -> DataFrame:
    """Genes a variant's symbol stands for, under any of their symbols.

    Empty text and the placeholder of genes without symbols are no symbols.
    """
    named = ~F.col("GENE_SYMBOL").isin("", fv.NO_SYMBOL)
    return variant.select("VARIANT_ID", "VARIANT_VERSION", "GENE_SYMBOL").where(named).join(
        aliases.where(named), "GENE_SYMBOL"
    ).select("VARIANT_ID", "VARIANT_VERSION", "GENE_SYMBOL", "GENE_ID", "LOOKUP_SOURCE")


#: Order of trust of a symbol: official, given by an authority or as main symbol, alias, other name.
OFFICIAL, MAIN, ALIAS, OTHER = range(1, 5)


def ranked_symbols(
    gene_info: DataFrame,
    gene_summary: DataFrame,
    gene_symbols: DataFrame,
    info_symbols: DataFrame,
    summary_symbols: DataFrame,
) -> DataFrame:
    """(GENE_SYMBOL, GENE_ID, RANK): every symbol of every gene and how far it is to be trusted.

    The official symbol of a gene comes first, then main symbols of either source, then
    aliases, then the names that summaries add.
    """
    official = F.when(F.col("NOMENCLATURE_STATUS") == 1, OFFICIAL).otherwise(MAIN)
    first = F.when(F.col("GENE_ALIAS_NO") == 1, MAIN).otherwise(ALIAS)
    ranked = [
        (gene_info, official),
        (gene_summary, F.lit(MAIN)),
        (gene_symbols, first),
        (info_symbols, F.lit(ALIAS)),
        (summary_symbols, F.lit(OTHER)),
    ]
    return reduce(
        DataFrame.unionByName, [df.select("GENE_SYMBOL", "GENE_ID", rank.alias("RANK")) for df, rank in ranked]
    ).where(F.col("GENE_ID").isNotNull() & ~F.col("GENE_SYMBOL").isin("", fv.NO_SYMBOL))


def resolved_symbols(ranked: DataFrame) -> DataFrame:
    """One row per symbol: the gene that holds it at the best rank, that rank, and its rivals.

    GENE_ID is NULL where several genes hold the symbol at that rank; N_RIVALS are the other
    genes that hold it at any. Genes of a symbol are reduced to one row each first, then to
    one row per symbol; both steps combine before their shuffle, so a symbol that very many
    genes hold is one row per task.
    """
    held = ranked.groupBy("GENE_SYMBOL", "GENE_ID").agg(F.min("RANK").alias("RANK"))
    at = lambda rank: F.col("RANK") == rank
    every = range(OFFICIAL, OTHER + 1)
    counted = held.groupBy("GENE_SYMBOL").agg(
        F.min("RANK").alias("RANK"),
        F.count(F.lit(1)).alias("_genes"),
        *[F.count_if(at(rank)).alias(f"_n{rank}") for rank in every],
        *[F.min(F.when(at(rank), F.col("GENE_ID"))).alias(f"_g{rank}") for rank in every],
    )
    alone = [F.when(at(rank) & (F.col(f"_n{rank}") == 1), F.col(f"_g{rank}")) for rank in every]
    return counted.select(
        "GENE_SYMBOL", F.coalesce(*alone).alias("GENE_ID"), "RANK", (F.col("_genes") - 1).alias("N_RIVALS")
    )


def variant_gene(variant: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row per variant: the gene its symbol stands for, NULL where unknown or ambiguous."""
    return variant.join(resolved, "GENE_SYMBOL", "left").select(
        "VARIANT_ID", "VARIANT_VERSION", "GENE_SYMBOL", "GENE_ID", "RANK", "N_RIVALS"
    )
