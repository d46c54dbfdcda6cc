"""Values fixed by the published data model.

Everything below has to be exactly this for results to be right: identifier
prefixes, labels, sentinels, column names, column widths and keys. Nothing here
is a tuning knob.
"""

# --- constants -------------------------------------------------------------

HUMAN_TAX_ID = 9606
UNSET_POSITION = 999999999
NO_SYMBOL = "None"
UNKNOWN = "Unknown"
DASH = "-"
DASH_PLACEHOLDER = "NaN"

# --- identifier rewrites: (text, replacement), applied left to right -------

PATHWAY_LIST_REWRITES = [("hsa", "P")]
DISEASE_LIST_REWRITES = [("H", "DS")]
GENE_REWRITES = [("hsa:", "G")]
GO_REWRITES = [(":", "")]

LINK_REWRITES = {
    "PATHWAY_ID": [("path:hsa", "P"), ("path:map", "P")],
    "GENE_ID": [("hsa:", "G")],
    "DISEASE_ID": [("ds:H", "DS")],
    "MODULE_ID": [("md:", "")],
    "NCBI_GENE_ID": [("ncbi-geneid:", "G")],
}

GENE_PREFIX = "G"
SNP_PREFIX = "rs"
VARIANT_PREFIX = "V"

# --- labels ----------------------------------------------------------------

PATHWAY_CLASSES = {
    "11": "global_map",
    "12": "overview_map",
    "10": "chemical_struc_map",
    "7": "drug_struc_map",
}
PATHWAY_CLASS_DEFAULT = "regular_map"

GENE_TYPES = {"protein-coding": "CDS", "unknown": "Unknown"}

# --- raw columns, in file order --------------------------------------------

KEGG_RAW_COLUMNS = {
    "pathway": ["PATHWAY_ID", "PATHWAY_NAME"],
    "gene": ["GENE_ID", "GENE_TYPE", "CHROMOSOMAL_POSITION", "GENE_SYMBOL_AND_NAME"],
    "disease": ["DISEASE_ID", "DISEASE_NAME"],
    "variant": ["VARIANT_ID", "VARIANT_NAME"],
    "module": ["MODULE_ID", "MODULE_NAME"],
    "pathway_gene": ["PATHWAY_ID", "GENE_ID"],
    "pathway_module": ["PATHWAY_ID", "MODULE_ID"],
    "pathway_disease": ["PATHWAY_ID", "DISEASE_ID"],
    "gene_disease": ["GENE_ID", "DISEASE_ID"],
    "ncbi_gene": ["NCBI_GENE_ID", "GENE_ID"],
}

# Record element names of the two document-summary extracts.
GENE_SUMMARY_RAW_DDL = (
    "UID string, NAME string, DESCRIPTION string, STATUS string, CURRENTID string, "
    "CHROMOSOME string, GENETICSOURCE string, MAPLOCATION string, OTHERALIASES string, "
    "OTHERDESIGNATIONS string, NOMENCLATURESYMBOL string, NOMENCLATURENAME string, "
    "NOMENCLATURESTATUS string, MIM array<string>, "
    "GENOMICINFO array<struct<CHRLOC:string,CHRACCVER:string,CHRSTART:int,CHRSTOP:int,EXONCOUNT:int>>, "
    "GENEWEIGHT int, SUMMARY string, CHRSORT string, ORGANISM struct<TaxID:int>, LOCATIONHIST string"
)
SNP_SUMMARY_RAW_DDL = (
    "UID string, SNP_ID string, GENES string, FXN_CLASS string, SS string, DOCSUM string, "
    "CLINICAL_SIGNIFICANCE string, CHR string, CHRPOS string, SPDI string, VALIDATED string, "
    "UPD_BUILD string, ALLELE string, SNP_CLASS string"
)

# The same gene record as it is spelled in XML, wrappers included.
GENE_SUMMARY_XML_DDL = (
    "_uid string, Name string, Description string, Status string, CurrentID string, "
    "Chromosome string, GeneticSource string, MapLocation string, OtherAliases string, "
    "OtherDesignations string, NomenclatureSymbol string, NomenclatureName string, "
    "NomenclatureStatus string, Mim struct<int:array<string>>, "
    "GenomicInfo struct<GenomicInfoType:array<struct<ChrLoc:string,ChrAccVer:string,ChrStart:int,"
    "ChrStop:int,ExonCount:int>>>, GeneWeight int, Summary string, ChrSort string, "
    "Organism struct<TaxID:int>, LocationHist string"
)
SNP_SUMMARY_XML_DDL = (
    "_uid string, SNP_ID string, GENES struct<GENE_E:array<struct<NAME:string,GENE_ID:string>>>, "
    "FXN_CLASS string, SS string, DOCSUM string, CLINICAL_SIGNIFICANCE string, CHR string, "
    "CHRPOS string, SPDI string, VALIDATED string, UPD_BUILD string, ALLELE string, SNP_CLASS string"
)

REACTOME_FILES = {
    "all_levels": "NCBI2Reactome_PE_All_Levels.txt",
    "pathway": "NCBI2Reactome_PE_Pathway.txt",
    "reactions": "NCBI2Reactome_PE_Reactions.txt",
    "omim": "Reactome2OMIM.txt",
}

# --- processed tables: column, type, largest width (None: no limit), required ---

TABLES = {
    "kegg_human_pathway": [
        ("PATHWAY_ID", "string", 10, True),
        ("PATHWAY_NAME", "string", 100, True),
    ],
    "kegg_human_gene": [
        ("GENE_ID", "string", 10, True),
        ("GENE_TYPE", "string", 5, True),
        ("GENE_NAME", "string", None, True),
        ("CHRSTOP", "int", None, False),
        ("CHRSTART", "int", None, False),
        ("CHR_COMPLEMENT", "int", None, False),
        ("CHROMOSOME", "string", 8, False),
    ],
    "kegg_human_gene_symbol_lookup": [
        ("GENE_ID", "string", 10, True),
        ("GENE_SYMBOL", "string", 35, True),
        ("GENE_ALIAS_NO", "int", None, True),
        ("LOOKUP_SOURCE", "string", 4, True),
    ],
    "kegg_human_disease": [
        ("DISEASE_ID", "string", 10, True),
        ("DISEASE_NAME_COUNT", "int", None, True),
    ],
    "kegg_human_disease_name_lookup": [
        ("DISEASE_ID", "string", 10, True),
        ("DISEASE_NAME", "string", None, True),
        ("LOOKUP_SOURCE", "string", 7, True),
    ],
    "kegg_human_variant": [
        ("VARIANT_ID", "string", 10, True),
        ("VARIANT_NAME", "string", 100, True),
        ("VARIANT_VERSION", "int", None, True),
        ("GENE_SYMBOL", "string", 20, True),
    ],
    "kegg_human_module": [
        ("MODULE_ID", "string", 10, True),
        ("MODULE_NAME_COUNT", "int", None, True),
    ],
    "kegg_human_module_name_lookup": [
        ("MODULE_ID", "string", 10, True),
        ("MODULE_NAME", "string", 100, True),
        ("LOOKUP_SOURCE", "string", 6, True),
    ],
    "kegg_human_pathway_gene_lookup": [
        ("PATHWAY_ID", "string", 10, True),
        ("GENE_ID", "string", 10, True),
    ],
    "kegg_human_pathway_module_lookup": [
        ("PATHWAY_ID", "string", 10, True),
        ("MODULE_ID", "string", 10, True),
    ],
    "kegg_human_pathway_disease_lookup": [
        ("PATHWAY_ID", "string", 10, True),
        ("DISEASE_ID", "string", 10, True),
    ],
    "kegg_human_gene_disease_lookup": [
        ("GENE_ID", "string", 10, True),
        ("DISEASE_ID", "string", 10, True),
    ],
    "kegg_human_ncbi_gene_lookup": [
        ("NCBI_GENE_ID", "string", None, False),
        ("GENE_ID", "string", None, False),
    ],
    "ncbi_human_gene_info": [
        ("GENE_ID", "string", 10, True),
        ("CHROMOSOME", "string", 10, True),
        ("MAP_LOCATION", "string", 50, True),
        ("DESCRIPTION", "string", None, True),
        ("GENE_TYPE", "string", 20, True),
        ("GENE_SYMBOL", "string", 35, True),
        ("GENE_NAME", "string", None, False),
        ("NOMENCLATURE_STATUS", "int", None, True),
    ],
    "ncbi_human_gene_info_symbol_lookup": [
        ("GENE_ID", "string", 10, True),
        ("GENE_SYMBOL", "string", 35, True),
        ("LOOKUP_SOURCE", "string", 9, True),
    ],
    "ncbi_human_gene_info_dbxref_lookup": [
        ("GENE_ID", "string", 10, True),
        ("REF_ID", "string", 20, True),
        ("REF", "string", 20, True),
        ("LOOKUP_SOURCE", "string", 9, True),
    ],
    "ncbi_human_gene_info_otherdesig_lookup": [
        ("GENE_ID", "string", 10, True),
        ("OTHER_DESIGNATIONS", "string", None, True),
        ("LOOKUP_SOURCE", "string", 9, True),
    ],
    "ncbi_human_gene_info_feature_lookup": [
        ("GENE_ID", "string", 10, True),
        ("FEATURE_CAT", "string", 20, True),
        ("FEATURE", "string", 50, True),
        ("LOOKUP_SOURCE", "string", 9, True),
    ],
    "ncbi_human_gene_orthologs": [
        ("GENE_ID", "string", 10, True),
        ("OTHER_TAX_ID", "int", None, True),
        ("OTHER_GENE_ID", "string", 10, True),
    ],
    "ncbi_human_gene2go": [
        ("GENE_ID", "string", 10, True),
        ("GO_ID", "string", 10, True),
        ("EVIDENCE", "string", 4, True),
        ("QUALIFIER", "string", 50, True),
        ("GO_TERM", "string", None, True),
        ("CATEGORY", "string", 10, True),
    ],
    "ncbi_human_gene_summary": [
        ("GENE_ID", "string", 10, True),
        ("GENE_SYMBOL", "string", 35, True),
        ("DESCRIPTION", "string", None, True),
        ("CHROMOSOME", "string", 10, True),
        ("MAP_LOCATION", "string", 50, False),
        ("GENE_NAME", "string", None, False),
        ("GENE_WEIGHT", "int", None, True),
        ("SUMMARY", "string", None, False),
        ("CHRSTART", "int", None, True),
        ("CHRSTOP", "int", None, True),
        ("EXONCOUNT", "double", None, False),
    ],
    "ncbi_human_gene_summary_symbol_lookup": [
        ("GENE_ID", "string", 10, True),
        ("GENE_SYMBOL", "string", 35, True),
        ("LOOKUP_SOURCE", "string", 12, True),
    ],
    "ncbi_human_gene_summary_omim_lookup": [
        ("GENE_ID", "string", 10, True),
        ("OMIM_ID", "int", None, True),
        ("LOOKUP_SOURCE", "string", 12, True),
    ],
    "ncbi_human_snp_summary": [
        ("SNP_ID", "string", 15, True),
        ("MAP_LOCATION", "string", 25, True),
        ("SEQ", "string", None, True),
        ("CLINICAL_SIGNIFICANCE", "string", None, False),
        ("CHROMOSOME", "string", 15, True),
        ("SPDI", "string", None, True),
        ("VALIDATED", "string", 35, True),
        ("UPD_BUILD", "int", None, True),
        ("ALLELE", "string", 1, True),
        ("SNP_CLASS", "string", 7, True),
        ("LEN", "int", None, True),
        ("HGVS", "string", None, True),
    ],
    "ncbi_human_snp_summary_gene_lookup": [
        ("SNP_ID", "string", 15, True),
        ("GENE_ID", "string", 10, True),
        ("LOOKUP_SOURCE", "string", 11, True),
    ],
    "ncbi_human_snp_summary_fxn_lookup": [
        ("SNP_ID", "string", 15, True),
        ("FXN_CLASS", "string", 35, True),
        ("LOOKUP_SOURCE", "string", 11, True),
    ],
    "ncbi_human_snp_summary_ss_lookup": [
        ("SNP_ID", "string", 15, True),
        ("SS", "string", 10, True),
        ("LOOKUP_SOURCE", "string", 11, True),
    ],
}

PRIMARY_KEYS = {
    "kegg_human_disease": "DISEASE_ID",
    "kegg_human_gene": "GENE_ID",
    "kegg_human_module": "MODULE_ID",
    "kegg_human_pathway": "PATHWAY_ID",
    "ncbi_human_gene_info": "GENE_ID",
    "ncbi_human_gene_summary": "GENE_ID",
    "ncbi_human_snp_summary": "SNP_ID",
}

# child table -> (column, parent table)
FOREIGN_KEYS = {
    "kegg_human_disease_name_lookup": ("DISEASE_ID", "kegg_human_disease"),
    "kegg_human_gene_symbol_lookup": ("GENE_ID", "kegg_human_gene"),
    "kegg_human_module_name_lookup": ("MODULE_ID", "kegg_human_module"),
}

# Tables whose flat files are gzip-compressed.
GZIP_TABLES = ["gene2go", "gene_summary", "snp_summary"]
