"""Readers, stage, sinks, refresh and newly landed files, on local folders."""

import gzip

import pytest
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill import session
from codonmill.operators.dealing import dealt
from codonmill.plans import refresh
from codonmill.plans.refresh import Pipeline, main
from codonmill.session import shared_folder
from codonmill.sources import sinks
from codonmill.sources.delimited import (
    read_reactome,
    read_tab_generic,
    read_tab_header,
    read_tab_list,
)
from codonmill.operators.quality import unknown_check
from codonmill.sources.docsum import read_docsum_json, read_docsum_xml, rescued_fields, union_pages
from codonmill.sources.landing import landed_files, lines_per_table
from codonmill.sources.stage import load_stage, save_stage
from codonmill.streaming.landing import load_new_files
from harness import landed
from tests.conftest import rows


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".gz":
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)
    return str(path)


def test_tab_list_takes_fields_as_written(spark, tmp_path):
    path = put(tmp_path / "a.tsv", 'a\t"b\t\n\nNA\n\tx\ty\tz\n')
    assert rows(read_tab_list(spark, path, ["c1", "c2", "c3"])) == sorted(
        [("a", '"b', ""), ("NA", None, None), ("", "x", "y")], key=repr
    )


def test_tab_header_gzip(spark, tmp_path):
    for part in "ab":
        put(tmp_path / f"{part}.gz", f"#tax_id\tGeneID\tNote\n9606\t{part}\tnull\n\n")
    df = read_tab_header(spark, str(tmp_path))
    assert df.columns == ["#tax_id", "GeneID", "Note"]
    assert rows(df) == [("9606", "a", "null"), ("9606", "b", "null")]
    assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert read_tab_header(spark, str(tmp_path), ["geneid"]).columns == ["GeneID"]


def test_tab_header_reads_no_further_than_the_header(spark, tmp_path):
    """The rest of a file is not looked at before rows are asked for."""
    lines = "".join(f"{number * 7919 % 1000003}\t{number}\n" for number in range(200_000))
    for name, header in (("a", "k\tv"), ("b", "v\tk")):
        whole = gzip.compress(f"{header}\n{lines}".encode())
        (tmp_path / f"{name}.gz").write_bytes(whole[: len(whole) // 2])
    df = read_tab_header(spark, str(tmp_path))
    assert df.columns == ["k", "v"]
    with pytest.raises(Exception, match="Unexpected end|EOF"):
        df.count()


def test_landed_pages_are_bounded(spark, tmp_path, monkeypatch):
    """Records that one task writes land as several files, as no file of XML or gzip can be split."""
    monkeypatch.setattr(landed, "PAGE_RECORDS", 10)
    rows = spark.range(35, numPartitions=1).select(F.col("id").cast("string").alias("_uid"), F.lit("x").alias("Name"))
    landed.land_xml(rows, str(tmp_path / "a.xml"))
    landed.land_json(rows, str(tmp_path / "b"))
    assert len(list((tmp_path / "a.xml").glob("part-*"))) == 4
    assert len(list((tmp_path / "b").glob("part-*.json.gz"))) == 4
    assert read_docsum_xml(spark, str(tmp_path / "a.xml"), "gene_summary").count() == 35


def test_staged_rows_are_not_shuffled_to_pack_them(spark, tmp_path, monkeypatch):
    columns = "#tax_id GeneID Symbol LocusTag Synonyms dbXrefs chromosome map_location description type_of_gene"
    columns += " Symbol_from_nomenclature_authority Full_name_from_nomenclature_authority Nomenclature_status"
    header = "\t".join(f"{columns} Other_designations Modification_date Feature_type".split())
    for number in range(4):
        lines = [f"{taxon}\t{number}\tS\t-\tA|B" + "\t-" * 11 for taxon in (9606, 7)]
        put(tmp_path / f"in/ncbi_human_gene_info_{number}.gz", "\n".join([header, *lines]))
    plans = []

    def save(df, *args, **kinds):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return save_stage(df, *args, **kinds)

    monkeypatch.setattr(refresh, "save_stage", save)
    written = Pipeline(spark, "ncbi", str(tmp_path / "in"), str(tmp_path / "out")).refresh(["gene_info"])
    assert spark.read.parquet(written["ncbi_human_gene_info_symbol_lookup"]).count() == 8
    assert len(plans) == 1 and "Exchange" not in plans[0]


def test_tab_header_needs_a_header(spark, tmp_path):
    with pytest.raises(ValueError, match="no header"):
        read_tab_header(spark, put(tmp_path / "a.gz", ""))


def test_generic_tab(spark, tmp_path):
    df = read_tab_generic(spark, put(tmp_path / "a.txt", "1\tR\tx\n2\tS\n"))
    assert df.columns == ["_c0", "_c1", "_c2"]
    assert rows(df) == [("1", "R", "x"), ("2", "S", None)]


def test_reactome(spark, tmp_path):
    put(tmp_path / "Reactome2OMIM.txt", "R-HSA-1\t100\n")
    assert rows(read_reactome(spark, str(tmp_path), "omim")) == [("R-HSA-1", "100")]
    with pytest.raises(ValueError, match="omim"):
        read_reactome(spark, str(tmp_path), "nope")


GENE_XML = """<?xml version="1.0"?>
<eSummaryResult><DocumentSummarySet status="OK">
<DocumentSummary uid="{uid}"><Name>{name}</Name><Description>d</Description>
<Chromosome>19</Chromosome><OtherAliases>A, B</OtherAliases>
<NomenclatureSymbol>{symbol}</NomenclatureSymbol><NomenclatureName></NomenclatureName>
<Mim><int>138670</int><int>7</int></Mim>
<GenomicInfo><GenomicInfoType><ChrLoc>19</ChrLoc><ChrAccVer>NC_1</ChrAccVer><ChrStart>58353491</ChrStart>
<ChrStop>58345182</ChrStop><ExonCount>8</ExonCount></GenomicInfoType></GenomicInfo>
<GeneWeight>3</GeneWeight><Summary>text</Summary><ChrSort>19</ChrSort>
<Organism><ScientificName>Homo sapiens</ScientificName><TaxID>9606</TaxID></Organism>
</DocumentSummary></DocumentSummarySet></eSummaryResult>
"""


def gene_xml(uid, name="A1BG", symbol="A1BG"):
    return GENE_XML.format(uid=uid, name=name, symbol=symbol)


def test_docsum_xml(spark, tmp_path):
    path = put(tmp_path / "g.xml", gene_xml("01"))
    df = read_docsum_xml(spark, path, "gene_summary")
    row = df.collect()[0]
    assert (row.UID, row.NAME, row.MIM) == ("01", "A1BG", ["138670", "7"])
    assert (row.GENOMICINFO[0].ChrStart, row.ORGANISM.TaxID) == (58353491, 9606)


def test_snp_docsum_xml(spark, tmp_path):
    path = put(
        tmp_path / "s.xml",
        "<r><DocumentSummary uid='3'><SNP_ID>3</SNP_ID><GENES><GENE_E><NAME>A</NAME><GENE_ID>12</GENE_ID></GENE_E>"
        "</GENES><FXN_CLASS>x,y</FXN_CLASS><DOCSUM>HGVS=h|LEN=1</DOCSUM></DocumentSummary></r>",
    )
    raw = read_docsum_xml(spark, path, "snp_summary")
    pipeline = Pipeline(spark, "ncbi", str(tmp_path))
    made = pipeline.transform("snp_summary", raw)
    assert rows(made["ncbi_human_snp_summary_gene_lookup"]) == [("rs3", "12", "snp_summary")]
    assert made["ncbi_human_snp_summary"].first().LEN == 1


def test_pages(spark, tmp_path, table):
    put(tmp_path / "p1.json", '{"UID": "1", "NAME": "a"}\n')
    put(tmp_path / "p2.json", '{"UID": "2", "STATUS": "s", "MIM": ["5"]}\n')
    df = read_docsum_json(spark, str(tmp_path), "gene_summary")
    assert rows(df.select("UID", "NAME", "STATUS", "MIM")) == [("1", "a", None, None), ("2", None, "s", ["5"])]
    pages = union_pages([table("UID A", [("1", "a")]), table("UID B", [("2", "b")]), table("B UID", [("c", "3")])])
    assert rows(pages) == [("1", "a", None), ("2", None, "b"), ("3", None, "c")]


def test_json_in_lower_case(spark, tmp_path):
    put(
        tmp_path / "ncbi_human_gene_summary.json",
        '\n{"uid": "1", "name": "a", "nomenclaturesymbol": "b", "genomicinfo": [{"chrstart": 5, "chrstop": 4}]}\n',
    )
    pipeline = Pipeline(spark, "ncbi", str(tmp_path))
    pipeline.refresh(["gene_summary"])
    row = pipeline.processed["ncbi_human_gene_summary"].first()
    assert (row.GENE_ID, row.GENE_SYMBOL, row.CHRSTART, row.CHRSTOP) == ("G1", "b", 5, 4)


def test_landed_files_are_told_apart(spark, tmp_path):
    tables = list(fv.KEGG_RAW_COLUMNS)
    put(tmp_path / "kegg_human_gene.csv", "a\n")
    put(tmp_path / "kegg_human_gene_2024_01.csv", "b\n")
    put(tmp_path / "kegg_human_gene_disease.csv", "c\n")
    put(tmp_path / "kegg_human_pathway" / "part-0.txt", "d\n")
    put(tmp_path / "kegg_human_other.csv", "e\n")
    put(tmp_path / "ncbi_human_gene.csv", "f\n")
    found = lambda t: [p.rsplit("/", 1)[1] for p in landed_files(spark, str(tmp_path), "kegg", t, tables)]
    assert found("gene") == ["kegg_human_gene.csv", "kegg_human_gene_2024_01.csv"]
    assert found("gene_disease") == ["kegg_human_gene_disease.csv"]
    assert found("pathway") == ["part-0.txt"]
    assert found("module") == []
    assert rows(lines_per_table(spark, str(tmp_path), "kegg", tables)) == sorted(
        [("gene", 2), ("gene_disease", 1), ("pathway", 1), (None, 2)], key=repr
    )


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_stage_keeps_any_text(spark, table, tmp_path, fmt):
    rows_in = [("DS1", 'quo"te, comma\nline', "disease"), ("DS2", "", "disease"), ("DS3", None, "x\\y")]
    df = table("DISEASE_ID DISEASE_NAME LOOKUP_SOURCE", rows_in)
    path = save_stage(df, str(tmp_path), "disease_name_lookup", "kegg", fmt=fmt)
    assert path.endswith("/processed/kegg/kegg_human_disease_name_lookup")
    assert rows(load_stage(spark, str(tmp_path), "disease_name_lookup", "kegg", fmt=fmt)) == rows_in


def test_stage_csv_of_large_tables_is_gzip(spark, table, tmp_path):
    df = table(" ".join(c[0] for c in fv.TABLES["ncbi_human_gene2go"]), [tuple("abcdef")])
    path = save_stage(df, str(tmp_path), "gene2go", "ncbi", fmt="csv")
    assert spark.read.text(path).inputFiles()[0].endswith(".csv.gz")
    assert rows(load_stage(spark, str(tmp_path), "gene2go", "ncbi", fmt="csv")) == [tuple("abcdef")]


def test_sink_folder_and_catalog(spark, table, tmp_path):
    df = table(None, [("DS1", 1)], "DISEASE_ID string, DISEASE_NAME_COUNT int")
    name = "kegg_human_disease"
    for overwrite, want in [(True, 1), (False, 2), (True, 1)]:
        assert spark.read.parquet(sinks.write_table(df, name, str(tmp_path), overwrite)).count() == want
        sinks.write_table(df, name, None, overwrite, bucket_by=(2, "DISEASE_ID"))
        assert spark.table(name).count() == want
    assert "2" in str(spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").collect())
    spark.sql(f"DROP TABLE {name}")


def test_sink_narrows_doubles(spark, table, tmp_path):
    schema = ", ".join(f"{c} {t}" for c, t, _, _ in fv.TABLES["ncbi_human_gene_summary"])
    df = table(None, [("G1", "s", "d", "1", None, None, 1, None, 1, 2, 8.0)], schema)
    path = sinks.write_table(df, "ncbi_human_gene_summary", str(tmp_path))
    assert dict(spark.read.parquet(path).dtypes)["EXONCOUNT"] == "float"


def test_sink_errors_reach_the_caller(spark, table):
    df = table(None, [("DS1", 1)], "DISEASE_ID string, DISEASE_NAME_COUNT int")
    with pytest.raises(Exception, match="(?i)driver|jdbc"):
        sinks.write_jdbc(df, "kegg_human_disease", "jdbc:nosuch://host/db", {"user": "u"})


def land_kegg(folder):
    put(folder / "kegg_human_gene_1.csv", "hsa:1\tCDS\t1:5..9\tA, B; n\nhsa:2\tCDS\tX\tbare\n")
    put(folder / "kegg_human_gene_2.csv", "hsa:1\tCDS\t1:5..9\tC; n\n")
    put(folder / "kegg_human_gene_disease.csv", "hsa:1\tds:H7\n")
    put(folder / "kegg_human_disease.csv", "H7\tone; two\n")


def test_refresh_of_lists(spark, tmp_path):
    land_kegg(tmp_path / "in")
    pipeline = Pipeline(spark, "kegg", str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "stage"))
    written = pipeline.refresh(["gene", "gene_disease", "disease"])
    read = {name: rows(spark.read.parquet(path)) for name, path in written.items()}
    # Gene 1 is in two files; its symbols are numbered through, in file order.
    assert read["kegg_human_gene_symbol_lookup"] == [
        ("G1", "A", 1, "gene"), ("G1", "B", 2, "gene"), ("G1", "C", 3, "gene"), ("G2", "None", 1, "gene"),
    ]
    assert read["kegg_human_gene_disease_lookup"] == [("G1", "DS7")]
    assert read["kegg_human_disease"] == [("DS7", 2)]
    found = rows(pipeline.violations())
    assert ("kegg_human_gene", "unique", "GENE_ID", "G1", 2) in found and len(found) == 1


def test_refresh_reports_wrong_types(spark, tmp_path):
    put(tmp_path / "in" / "kegg_human_variant.csv", "1v2\tABL1 x\n1vx\tABL1 y\nodd\tK z\n")
    pipeline = Pipeline(spark, "kegg", str(tmp_path / "in"), str(tmp_path / "out"))
    pipeline.refresh(["variant"])
    assert rows(pipeline.violations()) == [
        ("kegg_human_variant", "not_null", "VARIANT_ID", None, 1),
        ("kegg_human_variant", "not_null", "VARIANT_VERSION", None, 1),
        ("kegg_human_variant", "type", "VARIANT_VERSION", None, 1),
    ]


def test_refresh_appends_and_overwrites(spark, tmp_path):
    land_kegg(tmp_path / "in")
    pipeline = Pipeline(spark, "kegg", str(tmp_path / "in"), str(tmp_path / "out"))
    for overwrite, want in [(True, 1), (False, 2), (True, 1)]:
        path = pipeline.refresh(["gene_disease"], overwrite=overwrite)["kegg_human_gene_disease_lookup"]
        assert spark.read.parquet(path).count() == want


def test_refresh_without_target_only_plans(spark, tmp_path):
    land_kegg(tmp_path)
    pipeline = Pipeline(spark, "kegg", str(tmp_path))
    assert pipeline.refresh(["disease"]) == {}
    assert rows(pipeline.processed["kegg_human_disease"]) == [("DS7", 2)]
    assert pipeline.raw["disease"].columns == ["DISEASE_ID", "DISEASE_NAME", "SRC_SURPLUS"]


def test_refresh_names_what_is_missing(spark, tmp_path):
    land_kegg(tmp_path)
    pipeline = Pipeline(spark, "kegg", str(tmp_path), str(tmp_path / "out"))
    with pytest.raises(FileNotFoundError, match="pathway"):
        pipeline.refresh(["pathway"])
    with pytest.raises(ValueError, match="pathway_gene"):
        pipeline.refresh(["nope"])
    with pytest.raises(ValueError, match="ncbi"):
        Pipeline(spark, "nope", str(tmp_path))


def land_ncbi(folder):
    head = (
        "#tax_id\tGeneID\tSymbol\tLocusTag\tSynonyms\tdbXrefs\tchromosome\tmap_location\tdescription\ttype_of_gene\t"
        "Symbol_from_nomenclature_authority\tFull_name_from_nomenclature_authority\tNomenclature_status\t"
        "Other_designations\tModification_date\tFeature_type\n"
    )
    tail = "\t-\tA|B\tMIM:1\t19\t19q\tdesc\tprotein-coding\tA1BG\talpha\tO\tp|q\t20240101\t-\n"
    body = "".join(f"{tax}\t{gene}\tA1{tail}" for tax, gene in [(9606, 1), (10090, 2), (9606, 10)])
    put(folder / "ncbi_human_gene_info.gz", head + body)
    put(folder / "ncbi_human_gene_summary" / "page1.xml", gene_xml("10"))
    put(folder / "ncbi_human_gene_summary" / "page2.xml", gene_xml("2", "ND1", "MT-ND1"))
    put(folder / "ncbi_human_gene_summary" / "page3.xml", gene_xml("1", "B", "C"))


def test_refresh_of_annotation_and_records(spark, tmp_path):
    land_ncbi(tmp_path / "in")
    pipeline = Pipeline(spark, "ncbi", str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "stage"))
    written = pipeline.refresh(["gene_info", "gene_summary"])
    read = {name: spark.read.parquet(path) for name, path in written.items()}
    assert len(read) == 8
    assert [r.GENE_ID for r in read["ncbi_human_gene_info"].orderBy("GENE_ID").collect()] == ["G1", "G10"]
    # Only human rows were staged.
    assert load_stage(spark, str(tmp_path / "stage"), "gene_info", "ncbi", "raw").count() == 2
    assert read["ncbi_human_gene_info_symbol_lookup"].count() == 4
    summary = [r.GENE_ID for r in read["ncbi_human_gene_summary"].coalesce(1).collect()]
    assert summary == ["G1", "G10", "G2"]
    assert read["ncbi_human_gene_summary_omim_lookup"].count() == 6
    names = rows(read["ncbi_human_gene_summary_symbol_lookup"].where("GENE_SYMBOL NOT IN ('A')"))
    assert names == [("G1", "B", "gene_summary")] * 2 + [
        ("G10", "B", "gene_summary"), ("G2", "B", "gene_summary"),
    ]


def test_kept_rows_are_packed_in_one_shuffle(spark, tmp_path):
    head = "#tax_id\tGeneID\trelationship\tOther_tax_id\tOther_GeneID\n"
    for part in "ab":
        put(tmp_path / f"ncbi_human_gene_orthologs_{part}.gz", head + f"9606\t{part}\tO\t1\t2\n7\tz\tO\t1\t2\n")
    pipeline = Pipeline(spark, "ncbi", str(tmp_path))
    pipeline.refresh(["gene_orthologs"])
    made = pipeline.processed["ncbi_human_gene_orthologs"]
    assert rows(made) == [("Ga", 1, "2"), ("Gb", 1, "2")]
    text = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("Exchange") == 1 and text.index("Exchange") < text.index("9606")


def test_rows_are_dealt_by_content(spark, tmp_path):
    """Rows dealt in turn would all be sorted in the memory of the task that reads a gzip file."""
    head, names = "#tax_id\tGeneID\tGO_ID\tEvidence\tQualifier\tGO_term\tPubMed\tCategory", ["Note", "NOTE", "a`b.c"]
    copies = "9606\t1\tGO:2\tIEA\t-\tt\t-\tP\n" * 3 + "7\t1\tGO:2\tIEA\t-\tt\t-\tP\n"
    for number in range(5):
        put(tmp_path / f"in/ncbi_human_gene2go_{number}.gz", f"{head}\n{copies}")
    odd = read_tab_header(spark, put(tmp_path / "odd.gz", "\t".join(names) + "\nx\ty\tz\nx\ty\tz\n"))
    assert odd.columns == names and rows(odd) == [("x", "y", "z")] * 2
    pipeline = Pipeline(spark, "ncbi", str(tmp_path / "in"))
    pipeline.refresh(["gene2go"])
    made = pipeline.processed["ncbi_human_gene2go"]
    assert rows(made) == [("G1", "GO2", "IEA", "-", "t", "P")] * 15
    landed_rows = landed.shapes.raw(spark, "/root/testdata/sf0.001", "gene2go", spread=True)
    plain = landed.shapes.raw(spark, "/root/testdata/sf0.001", "gene2go")
    assert landed_rows.exceptAll(plain).isEmpty() and landed_rows.count() == plain.count()
    for df in (odd, made, landed_rows):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" in plan and "RoundRobin" not in plan
    bare = dealt(spark.sql("SELECT map(id, id) AS m FROM range(3)"))
    assert bare.count() == 3


def test_refresh_script(spark, tmp_path, capsys):
    land_kegg(tmp_path / "in")
    main(["kegg", "disease", "--landing", str(tmp_path / "in"), "--target", str(tmp_path / "out"), "--check"])
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"  # few bytes: one per slot
    shown = capsys.readouterr().out
    assert "kegg_human_disease_name_lookup\t" in shown and "TABLE_NAME" in shown


def test_update_writes_a_new_version(spark, tmp_path):
    land_kegg(tmp_path / "in1")
    Pipeline(spark, "kegg", str(tmp_path / "in1"), str(tmp_path / "v1")).refresh(["disease"])
    put(tmp_path / "in2" / "kegg_human_disease.csv", "H8\tnew\nH7\tonly\n")
    second = Pipeline(spark, "kegg", str(tmp_path / "in2"), str(tmp_path / "v2"))
    second.transform("disease", second.extract("disease"))
    path = second.update("kegg_human_disease", str(tmp_path / "v1"))
    assert rows(spark.read.parquet(path)) == [("DS7", 1), ("DS8", 1)]
    path = second.update("kegg_human_disease_name_lookup", str(tmp_path / "v1"))
    assert rows(spark.read.parquet(path)) == [("DS7", "only", "disease"), ("DS8", "new", "disease")]
    with pytest.raises(ValueError, match="previous"):
        second.update("kegg_human_disease", str(tmp_path / "v2"))


def test_update_of_narrowed_columns(spark, table, tmp_path):
    land_ncbi(tmp_path / "in")
    name = "ncbi_human_gene_summary"
    Pipeline(spark, "ncbi", str(tmp_path / "in"), str(tmp_path / "v1")).refresh(["gene_summary"])
    again = Pipeline(spark, "ncbi", str(tmp_path / "in"), str(tmp_path / "v2"))
    again.transform("gene_summary", again.extract("gene_summary"))
    path = again.update(name, str(tmp_path / "v1"))
    assert rows(spark.read.parquet(path)) == rows(spark.read.parquet(str(tmp_path / "v1" / name)))


def test_raw_parquet_can_land(spark, table, tmp_path):
    raw = table("DISEASE_ID DISEASE_NAME", [("H1", "a; b")])
    raw.write.parquet(str(tmp_path / "in" / "kegg_human_disease"))
    written = Pipeline(spark, "kegg", str(tmp_path / "in"), str(tmp_path / "out")).refresh(["disease"])
    assert rows(spark.read.parquet(written["kegg_human_disease"])) == [("DS1", 2)]


def test_new_files_are_loaded_once(spark, tmp_path):
    folder, out, memory = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "memory")
    put(folder / "kegg_human_disease_1.csv", "H1\ta; b\n\n")
    put(folder / "kegg_human_gene_disease.csv", "hsa:1\tds:H7\n")
    names = f"{out}/kegg_human_disease_name_lookup"

    def load():
        load_new_files(spark, str(folder), "disease", out, memory).awaitTermination()
        return rows(spark.read.parquet(names).select("DISEASE_ID", "DISEASE_NAME"))

    put(folder / "kegg_human_gene.csv", "hsa:1\tCDS\tX\tA; n\n")
    assert load() == [("DS1", "a"), ("DS1", "b")]
    load_new_files(spark, str(folder), "gene", out, memory).awaitTermination()
    assert spark.read.parquet(f"{out}/kegg_human_gene").count() == 1
    put(folder / "kegg_human_disease_2.csv", "H2\tc\n")
    assert load() == [("DS1", "a"), ("DS1", "b"), ("DS2", "c")]
    assert load() == [("DS1", "a"), ("DS1", "b"), ("DS2", "c")]


def test_shuffles_follow_the_size_of_the_files(spark, tmp_path, monkeypatch):
    put(tmp_path / "a" / "x.csv", "x" * 1000)
    put(tmp_path / "b.csv", "x" * 1000)
    monkeypatch.setattr(session, "BYTES_PER_PARTITION", 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffles(spark, str(tmp_path)) == 20
        assert spark.conf.get("spark.sql.shuffle.partitions") == "20"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_folder(spark), shared_folder(spark)
    assert first != second
    if base:
        assert first.startswith(base)


def test_rescued_fields(spark, tmp_path):
    (tmp_path / "one.json").write_text(
        '{"uid": "1", "NAME": "a", "odd": null, "More": [1, 2], "other": {"x": "y"}}\n{"UID": "2", "Name": "b"}\nbroken\n'
    )
    read = read_docsum_json(spark, str(tmp_path / "one.json"), "gene_summary", rescue=True)
    found = rescued_fields(read, "UID").collect()
    assert sorted((r.UID, r.NAME, r.VALUE) for r in found) == [
        ("1", "More", "[1,2]"), ("1", "odd", None), ("1", "other", '{"x":"y"}')
    ]
    assert read.count() == 3 and read.where("RESCUED IS NULL AND NAME = 'b'").count() == 1
    (tmp_path / "two.xml").write_text(
        "<S><DocumentSummary uid='3'><Name>c</Name><Odd>x &amp; y</Odd><Deep><A>1</A></Deep><Void/></DocumentSummary>"
        "<DocumentSummary uid='4'><Name>d</Name></DocumentSummary></S>"
    )
    read = read_docsum_xml(spark, str(tmp_path / "two.xml"), "gene_summary", rescue=True)
    found = {(r.UID, r.NAME): r.VALUE for r in rescued_fields(read, "UID").collect()}
    assert set(found) == {("3", "Odd"), ("3", "Deep"), ("3", "Void")}
    assert found["3", "Odd"] == "x & y" and "<A>1</A>" in found["3", "Deep"]
    report = unknown_check(rescued_fields(read), "t").collect()
    assert sorted((r.RULE, r.COLUMN_NAME, r.N_ROWS) for r in report) == [("unknown", n, 1) for n in ("Deep", "Odd", "Void")]
