"""Tables laid out by gene: same rows as plain joins, no exchange where both are bucketed."""

import pytest
from pyspark.sql import functions as F

from codonmill.plans import links
from codonmill.plans.layout import by_gene, lay_out, laid_out, linked
from tests.conftest import rows


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def laid(df, name, folder, **more):
    chosen, key = by_gene(df, name)
    return lay_out(chosen, f"{name}_laid", key, 4, str(folder), **more)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def link_tables(table):
    info = table("GENE_ID GENE_SYMBOL", [(f"NCBI{n}", f"S{n}") for n in range(40)])
    pairs = [("7", f"rs{n}") for n in range(50)] + [(str(n), f"rs{n}") for n in range(60)] + [(None, "rs1"), ("", "rs2")]
    lookup = table("GENE_ID SNP_ID", pairs)
    snps = table("SNP_ID SNP_CLASS", [(f"rs{n}", "c") for n in range(0, 60, 2)])
    return info, lookup, snps


def test_hot_and_missing_genes(spark, table, tmp_path):
    info, lookup, snps = link_tables(table)
    prefix = by_gene(lookup, "ncbi_human_snp_summary_gene_lookup")[0].where("GENE_ID = '7'").first()["GENE_KEY"][:-1]
    info = info.withColumn("GENE_ID", F.concat(F.lit(prefix), F.substring("GENE_ID", 5, 9)))
    one = laid(info, "ncbi_human_gene_info", tmp_path, hot_rows=5)
    other = laid(lookup, "ncbi_human_snp_summary_gene_lookup", tmp_path, hot_rows=5)
    assert other.hot.where("GENE_ID = '7'").count() == 51 and other.hot.where("GENE_ID IS NULL").count() == 1
    assert one.hot.count() == 0 and rows(other.whole().select("GENE_ID", "SNP_ID")) == rows(lookup)
    want = rows(links.gene_snps(info, lookup, snps))
    assert want and rows(linked(lambda a, b: links.gene_snps(a, b, snps), one, other)) == want
    # The other way round, and with a key that is hot on both sides.
    assert rows(linked(lambda a, b: links.gene_snps(b, a, snps), other, one)) == want
    twice = lay_out(info.unionByName(info), "both_hot", "GENE_ID", 4, str(tmp_path), hot_rows=1)
    assert twice.hot.count() == 0  # no gene has more rows than a bucket on average
    sevens = info.where(F.col("GENE_ID") == prefix + "7")
    many = info.unionByName(sevens.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(30)))).drop("_n"))
    hot = lay_out(many, "both_hot", "GENE_ID", 4, str(tmp_path), hot_rows=1)
    assert hot.hot.count() == 31
    assert rows(linked(lambda a, b: links.gene_snps(a, b, snps), hot, other)) == rows(links.gene_snps(many, lookup, snps))


def test_buckets_join_without_an_exchange(spark, table, tmp_path, no_broadcast):
    gene = table("GENE_ID GENE_NAME GENE_SYMBOL", [(f"G{n}", "n", "s") for n in range(50)])
    laid(gene, "kegg_human_gene", tmp_path)
    gene = laid_out(spark, "kegg_human_gene_laid").even
    terms = table("GENE_ID GO_ID GO_TERM CATEGORY", [(f"G{n % 60}", "g", "t", "c") for n in range(90)])
    terms = laid(terms, "ncbi_human_gene2go", tmp_path).even
    joined = links.gene_go_terms(gene, terms)
    assert "Exchange" not in plan(joined) and joined.count() == 80

    pairs = table("GENE_ID DISEASE_ID", [(f"G{n}", f"D{n % 3}") for n in range(50)])
    pairs = laid(pairs, "kegg_human_gene_disease_lookup", tmp_path).even
    disease = table("DISEASE_ID DISEASE_NAME_COUNT", [("D0", "1"), ("D1", "2")])
    text = plan(links.gene_diseases(gene, pairs, disease))
    assert "hashpartitioning(DISEASE_ID" in text and "hashpartitioning(GENE_ID" not in text

    info, lookup, snps = link_tables(table)
    info = laid(info, "ncbi_human_gene_info", tmp_path).even
    lookup = laid(lookup, "ncbi_human_snp_summary_gene_lookup", tmp_path).even
    text = plan(links.gene_snps(info, lookup, snps))
    assert "hashpartitioning(SNP_ID" in text and "hashpartitioning(GENE" not in text


def test_empty_table(spark, table, tmp_path):
    none = table("GENE_ID GENE_SYMBOL", [])
    got = lay_out(none, "nothing", "GENE_ID", 4, str(tmp_path))
    assert got.whole().count() == 0
    assert by_gene(none.drop("GENE_ID"), "other") is None
