"""Jobs for the pathway source: list tables and link tables.

One function per processed table, each a single pass over the raw rows. All are
narrow but for the numbering of repeated genes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.functions import identifiers as ids
from codonmill.functions import names, positions, text
from codonmill.operators.lookup import lookup
from codonmill.operators.numbering import numbered_lookup
from codonmill.sources.delimited import POSITION, SURPLUS


def pathway(raw: DataFrame, with_class: bool = False) -> DataFrame:
    pathway_id = ids.rewrite(F.col("PATHWAY_ID"), fv.PATHWAY_LIST_REWRITES)
    kind = [ids.pathway_class(pathway_id).alias("PATHWAY_CLASS")] if with_class else []
    return raw.select(
        pathway_id.alias("PATHWAY_ID"),
        text.before(F.col("PATHWAY_NAME"), " - ").alias("PATHWAY_NAME"),
        *kind,
    )


def gene(raw: DataFrame) -> DataFrame:
    position, packed = F.col("CHROMOSOMAL_POSITION"), F.col("GENE_SYMBOL_AND_NAME")
    return raw.select(
        ids.rewrite(F.col("GENE_ID"), fv.GENE_REWRITES).alias("GENE_ID"),
        "GENE_TYPE",
        names.gene_name(packed).alias("GENE_NAME"),
        positions.chr_stop(position).alias("CHRSTOP"),
        positions.chr_start(position).alias("CHRSTART"),
        positions.complement_flag(position).alias("CHR_COMPLEMENT"),
        positions.list_chromosome(position).alias("CHROMOSOME"),
    )


def gene_symbol_lookup(raw: DataFrame) -> DataFrame:
    """Numbered symbols of each gene.

    Where the reader added line positions, gene ids may repeat and their numbers
    run on in file order; without positions each id must occur once.
    """
    placed = set(POSITION) <= set(raw.columns)
    file, block, row = POSITION
    return numbered_lookup(
        raw.select(
            ids.rewrite(F.col("GENE_ID"), fv.GENE_REWRITES).alias("GENE_ID"),
            "GENE_SYMBOL_AND_NAME",
            *(POSITION if placed else []),
        ),
        "GENE_ID",
        names.gene_symbols(F.col("GENE_SYMBOL_AND_NAME")),
        name="GENE_SYMBOL",
        number="GENE_ALIAS_NO",
        source="gene",
        order=[row] if placed else [],
        chunk=[file, block] if placed else [],
    )


def disease(raw: DataFrame) -> DataFrame:
    listed = names.disease_names(F.col("DISEASE_NAME"))
    return raw.select(
        ids.rewrite(F.col("DISEASE_ID"), fv.DISEASE_LIST_REWRITES).alias("DISEASE_ID"),
        F.array_size(listed).alias("DISEASE_NAME_COUNT"),
    )


def disease_name_lookup(raw: DataFrame) -> DataFrame:
    return lookup(
        raw,
        ids.rewrite(F.col("DISEASE_ID"), fv.DISEASE_LIST_REWRITES).alias("DISEASE_ID"),
        names.disease_names(F.col("DISEASE_NAME")),
        "DISEASE_NAME",
        "disease",
    )


def variant(raw: DataFrame) -> DataFrame:
    raw_id = F.col("VARIANT_ID")
    return raw.select(
        ids.variant_id(raw_id).alias("VARIANT_ID"),
        "VARIANT_NAME",
        ids.variant_version(raw_id).alias("VARIANT_VERSION"),
        text.before(F.col("VARIANT_NAME"), " ").alias("GENE_SYMBOL"),
    )


def module(raw: DataFrame) -> DataFrame:
    listed = names.module_names(F.col("MODULE_NAME"))
    return raw.select("MODULE_ID", F.array_size(listed).alias("MODULE_NAME_COUNT"))


def module_name_lookup(raw: DataFrame) -> DataFrame:
    listed = names.module_names(F.col("MODULE_NAME"))
    return lookup(raw, F.col("MODULE_ID"), listed, "MODULE_NAME", "module", keep_null=True)


def link(raw: DataFrame) -> DataFrame:
    """Pairs of identifiers; each known id column gets its standard spelling."""
    return raw.select(
        *[
            ids.rewrite(F.col(c), fv.LINK_REWRITES.get(c, [])).alias(c)
            for c in raw.columns
            if c not in (*POSITION, SURPLUS)
        ]
    )


def gene_disease_link(raw: DataFrame) -> DataFrame:
    """Pairs whose columns come in either order; the gene is the one spelled `hsa:`."""
    one, two = (F.col(name) for name in raw.columns[:2])
    gene_second = F.coalesce(two.startswith("hsa:") & ~one.startswith("hsa:"), F.lit(False))
    return link(
        raw.select(
            F.when(gene_second, two).otherwise(one).alias("GENE_ID"),
            F.when(gene_second, one).otherwise(two).alias("DISEASE_ID"),
        )
    )
