"""Registered tables: where their raw rows come from and which job makes them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codonmill import fixed_values as fv
from codonmill.plans import kegg, ncbi
from codonmill.schemas import conform, full_name
from codonmill.sources.delimited import read_tab_header, read_tab_list
from codonmill.sources.docsum import RAW_DDL, RESCUED, read_docsum_json, read_docsum_xml, union_pages

Job = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class TableSpec:
    """One raw table.

    `jobs` has one function per processed table, by short name. `read` takes a
    session and paths. With `stage`, raw rows that are costly to parse and feed
    several tables are written as Parquet first. `keep` is a filter that leaves
    few of the raw rows, as the taxon does: what it leaves is packed into fewer
    partitions. `order_by` names a processed table whose files are kept in order, and by which
    column. Where a job looks at the rows of all files together, `whole` is set, and rows of
    new files cannot be added to what was made of the others.
    """

    source: str
    name: str
    jobs: dict[str, Job]
    read: Callable[[SparkSession, list[str]], DataFrame]
    stage: bool = False
    keep: Job | None = None
    order_by: tuple[str, str] | None = None
    whole: bool = False

    def loose(self, raw: DataFrame) -> dict[str, DataFrame]:
        """Processed tables by full name, before types are applied."""
        return {full_name(self.source, short): job(raw) for short, job in self.jobs.items()}

    def run(self, raw: DataFrame) -> dict[str, DataFrame]:
        """Processed tables by full name, with their final columns and types."""
        return {full_name(self.source, short): self.table(raw, short) for short in self.jobs}

    def table(self, raw: DataFrame, short: str) -> DataFrame:
        """One of the processed tables."""
        return conform(self.jobs[short](raw), full_name(self.source, short))


def _read_list(spark: SparkSession, paths: list[str], name: str) -> DataFrame:
    # Gene symbols are numbered in file order, so that reader keeps positions.
    return read_tab_list(
        spark, paths, fv.KEGG_RAW_COLUMNS[name], position=name == "gene", surplus=True
    )


def _read_docsum(spark: SparkSession, paths: list[str], name: str) -> DataFrame:
    """Pages of both formats side by side, each read as what it is."""
    xml = [path for path in paths if _is_xml(path)]
    other = [path for path in paths if not _is_xml(path)]
    pages = [read_docsum_json(spark, other, name, rescue=True)] if other else []
    if xml:
        kinds = T.StructType.fromDDL(RAW_DDL[name])
        read = read_docsum_xml(spark, xml, name, rescue=True)
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds.fields]
        pages.append(read.select(*typed, RESCUED))
    return union_pages(pages)


def _is_xml(path: str) -> bool:
    return any(part.endswith((".xml", ".xml.gz")) for part in path.split("/")[-2:])


def _kegg(name: str, jobs: dict[str, Job]) -> TableSpec:
    # Symbols are numbered over all rows of a gene.
    return TableSpec("kegg", name, jobs, partial(_read_list, name=name), whole=name == "gene")


def _link(name: str, job: Job = kegg.link) -> TableSpec:
    return _kegg(name, {f"{name}_lookup": job})


_KEGG = [
    _kegg("pathway", {"pathway": kegg.pathway}),
    _kegg("gene", {"gene": kegg.gene, "gene_symbol_lookup": kegg.gene_symbol_lookup}),
    _kegg(
        "disease", {"disease": kegg.disease, "disease_name_lookup": kegg.disease_name_lookup}
    ),
    _kegg("variant", {"variant": kegg.variant}),
    _kegg("module", {"module": kegg.module, "module_name_lookup": kegg.module_name_lookup}),
    _link("pathway_gene"),
    _link("pathway_module"),
    _link("pathway_disease"),
    _link("gene_disease", kegg.gene_disease_link),
    _link("ncbi_gene"),
]

_NCBI = [
    TableSpec(
        "ncbi",
        "gene_info",
        {
            "gene_info": ncbi.gene_info,
            "gene_info_symbol_lookup": ncbi.gene_info_symbol_lookup,
            "gene_info_dbxref_lookup": ncbi.gene_info_dbxref_lookup,
            "gene_info_otherdesig_lookup": ncbi.gene_info_otherdesig_lookup,
            "gene_info_feature_lookup": ncbi.gene_info_feature_lookup,
        },
        read_tab_header,
        stage=True,
        keep=ncbi.only_human,
    ),
    TableSpec(
        "ncbi",
        "gene_orthologs",
        {"gene_orthologs": ncbi.gene_orthologs},
        read_tab_header,
        keep=ncbi.only_human,
    ),
    TableSpec(
        "ncbi", "gene2go", {"gene2go": ncbi.gene2go}, read_tab_header, keep=ncbi.only_human
    ),
    TableSpec(
        "ncbi",
        "gene_summary",
        {
            "gene_summary": ncbi.gene_summary,
            "gene_summary_symbol_lookup": ncbi.gene_summary_symbol_lookup,
            "gene_summary_omim_lookup": ncbi.gene_summary_omim_lookup,
        },
        partial(_read_docsum, name="gene_summary"),
        stage=True,
        order_by=("ncbi_human_gene_summary", "GENE_ID"),
    ),
    TableSpec(
        "ncbi",
        "snp_summary",
        {
            "snp_summary": ncbi.snp_summary,
            "snp_summary_gene_lookup": ncbi.snp_summary_gene_lookup,
            "snp_summary_fxn_lookup": ncbi.snp_summary_fxn_lookup,
            "snp_summary_ss_lookup": ncbi.snp_summary_ss_lookup,
        },
        partial(_read_docsum, name="snp_summary"),
        stage=True,
    ),
]

REGISTRY: dict[str, dict[str, TableSpec]] = {
    "kegg": {one.name: one for one in _KEGG},
    "ncbi": {one.name: one for one in _NCBI},
}


def spec(source: str, table: str) -> TableSpec:
    """The registered table, or an error that lists the valid names."""
    if source not in REGISTRY:
        raise ValueError(f"unknown source {source!r}; known are {sorted(REGISTRY)}")
    if table not in REGISTRY[source]:
        raise ValueError(f"unknown {source} table {table!r}; known are {list(REGISTRY[source])}")
    return REGISTRY[source][table]


def register(new: TableSpec) -> None:
    """Add a table, or a whole source, of the caller's own."""
    REGISTRY.setdefault(new.source, {})[new.name] = new
