"""Row rules of the table jobs, on small tables."""

import pytest

from codonmill import fixed_values as fv
from codonmill.plans.registry import REGISTRY, TableSpec, register, spec
from codonmill.schemas import rules
from tests.conftest import rows


def run(source, name, raw):
    return {k.split("_human_")[1]: rows(v) for k, v in spec(source, name).run(raw).items()}


def test_gene(table):
    raw = table(
        " ".join(fv.KEGG_RAW_COLUMNS["gene"]),
        [
            ("hsa:1", "CDS", "1:complement(14362..29370)", "A, B; name"),
            ("hsa:2", "miRNA", "X; Y", "bare"),
        ],
    )
    assert run("kegg", "gene", raw) == {
        "gene": [
            ("G1", "CDS", " name", 14362, 29370, 1, "1"),
            ("G2", "miRNA", "bare", 0, 0, 0, "X;Y"),
        ],
        "gene_symbol_lookup": [
            ("G1", "A", 1, "gene"), ("G1", "B", 2, "gene"), ("G2", "None", 1, "gene"),
        ],
    }


def test_disease_and_module(table):
    disease = table("DISEASE_ID DISEASE_NAME", [("H1", "a; b"), ("H2", "c")])
    assert run("kegg", "disease", disease) == {
        "disease": [("DS1", 2), ("DS2", 1)],
        "disease_name_lookup": [("DS1", "a", "disease"), ("DS1", "b", "disease"), ("DS2", "c", "disease")],
    }
    module = table("MODULE_ID MODULE_NAME", [("M1", "x (y), z"), ("M2", None)])
    assert run("kegg", "module", module) == {
        "module": [("M1", 2), ("M2", 1)],
        "module_name_lookup": [("M1", "x", "module"), ("M1", "y", "module"), ("M2", None, "module")],
    }


def test_variant(table):
    raw = table("VARIANT_ID VARIANT_NAME", [("1v2", "ABL1 (T315I)"), ("odd", "K x"), ("1vx", "K")])
    assert run("kegg", "variant", raw) == {
        "variant": [
            ("V1", "ABL1 (T315I)", 2, "ABL1"), ("V1", "K", None, "K"), (None, "K x", None, "K"),
        ]
    }


def test_links(table):
    raw = table("PATHWAY_ID GENE_ID", [("path:hsa1", "hsa:2"), ("path:map3", "hsa:4")])
    assert run("kegg", "pathway_gene", raw) == {"pathway_gene_lookup": [("P1", "G2"), ("P3", "G4")]}
    raw = table("PATHWAY_ID MODULE_ID", [("path:hsa1", "md:M2")])
    assert run("kegg", "pathway_module", raw) == {"pathway_module_lookup": [("P1", "M2")]}
    raw = table("PATHWAY_ID DISEASE_ID", [("path:hsa1", "ds:H2")])
    assert run("kegg", "pathway_disease", raw) == {"pathway_disease_lookup": [("P1", "DS2")]}
    raw = table("NCBI_GENE_ID GENE_ID", [("ncbi-geneid:1", "hsa:2")])
    assert run("kegg", "ncbi_gene", raw) == {"ncbi_gene_lookup": [("G1", "G2")]}


@pytest.mark.parametrize("pair", [("hsa:1", "ds:H2"), ("ds:H2", "hsa:1")])
def test_gene_disease_in_either_order(table, pair):
    raw = table("DISEASE_ID GENE_ID", [pair])
    assert run("kegg", "gene_disease", raw) == {"gene_disease_lookup": [("G1", "DS2")]}


INFO = (
    "#tax_id GeneID Symbol LocusTag Synonyms dbXrefs chromosome map_location description type_of_gene "
    "Symbol_from_nomenclature_authority Full_name_from_nomenclature_authority Nomenclature_status "
    "Other_designations Modification_date Feature_type"
)


def test_gene_info(table):
    raw = table(
        INFO,
        [
            ("9606", "1", "A1", "-", "A|NaN|B", "MIM:1|HGNC:HGNC:5", "X|Y", "-", "d", "protein-coding",
             "A1BG", "alpha", "O", "p", "2024", "regulatory:enhancer:x|misc"),
            ("9606", "2", "-", "-", "-", "-", "7", "1|2", "e", "unknown", "-", "-", "-", "-", "2024", "-"),
            ("10090", "3", "-", "-", "m", "-", "7", "-", "e", "unknown", "-", "-", "-", "-", "2024", "-"),
        ],
    )
    assert run("ncbi", "gene_info", raw) == {
        "gene_info": [
            ("G1", "X;Y", "Unknown", "d", "CDS", "A1BG", "alpha", 1),
            ("G2", "7", "1;2", "e", "Unknown", None, None, 0),
        ],
        "gene_info_symbol_lookup": [("G1", "A", "gene_info"), ("G1", "B", "gene_info")],
        "gene_info_dbxref_lookup": [("G1", "1", "MIM", "gene_info"), ("G1", "5", "HGNC", "gene_info")],
        "gene_info_otherdesig_lookup": [("G1", "p", "gene_info")],
        "gene_info_feature_lookup": [
            ("G1", "misc", None, "gene_info"), ("G1", "regulatory", "enhancer", "gene_info"),
        ],
    }


def test_orthologs_and_go(table):
    raw = table(
        "#tax_id GeneID relationship Other_tax_id Other_GeneID",
        [("9606", "1", "Ortholog", "10090", "77"), ("10090", "2", "Ortholog", "9606", "1")],
    )
    assert run("ncbi", "gene_orthologs", raw) == {"gene_orthologs": [("G1", 10090, "77")]}
    line = ("9606", "1", "GO:0005", "IEA", "q", "t", "12|13", "Process")
    raw = table("#tax_id GeneID GO_ID Evidence Qualifier GO_term PubMed Category", [line, line])
    assert run("ncbi", "gene2go", raw) == {"gene2go": [("G1", "GO0005", "IEA", "q", "t", "Process")] * 2}


def summary_row(uid, **given):
    names = [c.split()[0] for c in fv.GENE_SUMMARY_RAW_DDL.replace(", ", ",\0").split(",\0")]
    known = {"UID": uid, "DESCRIPTION": "d", "GENEWEIGHT": 3, "NOMENCLATURESYMBOL": "", **given}
    return tuple(known.get(n) for n in names)


def test_gene_summary(table):
    raw = table(
        None,
        [
            summary_row("1", NAME="A1BG", NOMENCLATURESYMBOL="A1BG", OTHERALIASES="A, B", MIM=["7", "8"],
                        CHROMOSOME="X, Y", SUMMARY="", MAPLOCATION="19q", NOMENCLATURENAME="alpha",
                        GENOMICINFO=[("19", "NC", 999999999, 999999999, 4), ("1", "NC", 1, 2, 3)]),
            summary_row("2", NAME="ND1", NOMENCLATURESYMBOL="MT-ND1", OTHERALIASES="", GENOMICINFO=[], MIM=[]),
            summary_row("3", NAME="LOC9", OTHERALIASES=None, SUMMARY="text"),
            summary_row("4", NAME="B", NOMENCLATURESYMBOL=None, OTHERALIASES="C", CHROMOSOME="7"),
            summary_row("5", NAME=None, NOMENCLATURESYMBOL="C"),
        ],
        fv.GENE_SUMMARY_RAW_DDL,
    )
    assert run("ncbi", "gene_summary", raw) == {
        "gene_summary": [
            ("G1", "A1BG", "d", "X;Y", "19q", "alpha", 3, None, 0, 999999999, 4.0),
            ("G2", "MT-ND1", "d", "Unknown", None, None, 3, None, 0, 0, None),
            ("G3", None, "d", "Unknown", None, None, 3, "text", 0, 0, None),
            ("G4", None, "d", "7", None, None, 3, None, 0, 0, None),
            ("G5", "C", "d", "Unknown", None, None, 3, None, 0, 0, None),
        ],
        "gene_summary_symbol_lookup": [
            ("G1", "A", "gene_summary"), ("G1", "B", "gene_summary"), ("G3", "LOC9", "gene_summary"),
            ("G4", "C", "gene_summary"), ("G5", None, "gene_summary"),
        ],
        "gene_summary_omim_lookup": [("G1", 7, "gene_summary"), ("G1", 8, "gene_summary")],
    }


def test_snp_summary(table):
    columns = [c.split()[0] for c in fv.SNP_SUMMARY_RAW_DDL.split(", ")] + ["uid2", "CHRPOS_SORT", "TEXT"]
    values = {
        "UID": "9", "SNP_ID": "9", "GENES": "[{'NAME': 'A', 'GENE_ID': '12'}]", "FXN_CLASS": "a,,b", "SS": None,
        "DOCSUM": "HGVS=h|SEQ=[A/G]|LEN=1", "CLINICAL_SIGNIFICANCE": "", "CHR": "7", "CHRPOS": "7:100",
        "SPDI": "s", "VALIDATED": "v", "UPD_BUILD": "155", "ALLELE": "R", "SNP_CLASS": "snv",
    }
    raw = table(" ".join(columns), [tuple(values.get(c) for c in columns)])
    want = {
        "snp_summary": [("rs9", "7:100", "[A/G]", None, "7", "s", "v", 155, "R", "snv", 1, "h")],
        "snp_summary_gene_lookup": [("rs9", "12", "snp_summary")],
        "snp_summary_fxn_lookup": [("rs9", "a", "snp_summary"), ("rs9", "b", "snp_summary")],
        "snp_summary_ss_lookup": [],
    }
    assert run("ncbi", "snp_summary", raw) == want
    without = run("ncbi", "snp_summary", raw.drop("CHR", "CHRPOS"))
    assert without["snp_summary"][0][1] is None and without["snp_summary"][0][4] is None


def test_every_processed_table_has_its_columns(spark):
    made = {f"{s}_human_{short}" for s in ("kegg", "ncbi") for one in REGISTRY[s].values() for short in one.jobs}
    assert made == set(fv.TABLES) and len(made) == 27
    for name in made:
        assert len({r.name for r in rules(name)}) == len(rules(name))


def test_registry(table):
    with pytest.raises(ValueError, match="gene_orthologs"):
        spec("ncbi", "nope")
    with pytest.raises(ValueError, match="kegg"):
        spec("nope", "gene")
    register(TableSpec("mine", "t", {"t": lambda raw: raw}, read=lambda spark, paths: None))
    assert spec("mine", "t").name == "t"
    del REGISTRY["mine"]
