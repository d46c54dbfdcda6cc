"""Shared operators against brute force, with one key that holds a third of all rows."""

import random
from collections import Counter

from pyspark.sql import functions as F

from codonmill.operators import quality
from codonmill.operators.columns import drop_marked, upper_columns
from codonmill.operators.numbering import numbered_lookup
from codonmill.operators.ordering import ordered_by
from codonmill.operators.outer_join import full_outer
from codonmill.plans import links
from codonmill.plans.incremental import changed_rows, replace_keys, upsert
from tests.conftest import rows


def skewed_keys(n, distinct, seed=7):
    draw = random.Random(seed)
    return ["hot" if draw.random() < 0.34 else f"k{draw.randrange(distinct)}" for _ in range(n)]


def test_numbers_run_on_over_repeated_keys(table):
    keys = skewed_keys(600, 40)
    values = [[f"s{i}-{j}" for j in range(1 + i % 3)] for i in range(600)]
    df = table(
        None,
        [(k, i, i // 50, v) for i, (k, v) in enumerate(zip(keys, values))],
        "id string, n int, chunk int, v array<string>",
    ).repartition(7)
    got = numbered_lookup(df, "id", F.col("v"), "s", "no", "x", order=["n"], chunk=["chunk"])
    seen, want = Counter(), []
    for key, listed in zip(keys, values):
        for value in listed:
            seen[key] += 1
            want.append((key, value, seen[key], "x"))
    assert rows(got) == sorted(want, key=repr)


def test_rows_without_a_key_get_no_number(table):
    df = table(None, [(None, 1, 0, ["a"]), ("k", 2, 0, ["b"])], "id string, n int, c int, v array<string>")
    got = numbered_lookup(df, "id", F.col("v"), "s", "no", "x", order=["n"], chunk=["c"])
    assert rows(got) == [("k", "b", 1, "x"), (None, "a", None, "x")]


def brute_outer(left, right):
    by_key = {}
    for key, value in right:
        by_key.setdefault(key, []).append(value)
    out = [(k, a, b) for k, a in left if k is not None for b in by_key.get(k, [None])]
    have = {k for k, _ in left}
    return out + [(k, None, b) for k, b in right if k is not None and k not in have]


def test_full_outer(table):
    left = list(zip(skewed_keys(300, 50), map(str, range(300)))) + [(None, "x")]
    right = [(f"k{i}", f"r{i}") for i in range(30, 80)] + [("hot", "h"), ("k31", "twice"), (None, "y")]
    got = full_outer(table("k a", left), table("k b", right), "k")
    assert rows(got) == sorted(brute_outer(left, right), key=repr)
    empty = table("k a", [])
    assert rows(full_outer(empty, table("k b", right), "k").select("k", "a", "b")) == sorted(
        brute_outer([], right), key=repr
    )


def test_ordered_by(table):
    data = [("G10", "a"), ("G2", "b"), ("G1", "c")] + [("G1", "same")] * 50 + [(None, "z")]
    got = ordered_by(table("k v", data), "k").collect()
    assert [r.k for r in got] == ["G1"] * 51 + ["G10", "G2", None]
    assert Counter(map(tuple, got)) == Counter(data)


def test_columns(table):
    df = table("a b_SORT c", [("1", "2", "3")])
    assert upper_columns(df).columns == ["A", "B_SORT", "C"]
    assert drop_marked(df, ["missing", "C"], "_SORT").columns == ["a"]


def test_gene_merged_example(table):
    info = table(
        None,
        [("G1", "CDS", 1), ("G2", "ncRNA", 0), (None, "CDS", 1)],
        "GENE_ID string, GENE_TYPE string, NOMENCLATURE_STATUS int",
    )
    summary = table(None, [("G1", 5), ("G3", 7), (None, 1)], "GENE_ID string, CHRSTART int")
    gene = table(
        None,
        [("G91", "CDS", 1), ("G2", "miRNA", 0), ("G4", "CDS", 1)],
        "GENE_ID string, GENE_TYPE string, CHR_COMPLEMENT int",
    )
    pairs = table("NCBI_GENE_ID GENE_ID", [("G1", "G91")])
    merged = links.gene_merged(info, summary, gene, pairs)
    assert merged.columns == [
        "GENE_ID", "GENE_TYPE", "NOMENCLATURE_STATUS", "CHRSTART", "CHR_COMPLEMENT", "GENE_TYPE_ALT",
    ]
    assert rows(merged) == [
        ("G1", "CDS", 1, 5, 1, None),
        ("G2", "ncRNA", 0, None, 0, "miRNA"),
        ("G3", None, None, 7, None, None),
        ("G4", "CDS", None, None, 1, None),
    ]


def test_gene_merged_keeps_repeated_ids(table):
    info = table(None, [("G1", "CDS", 1)], "GENE_ID string, GENE_TYPE string, NOMENCLATURE_STATUS int")
    summary = table(None, [("G1", 5)], "GENE_ID string, CHRSTART int")
    gene = table(
        None, [(f"G{i}", "CDS", i % 2) for i in range(10, 40)],
        "GENE_ID string, GENE_TYPE string, CHR_COMPLEMENT int",
    )
    pairs = table("NCBI_GENE_ID GENE_ID", [("G1", f"G{i}") for i in range(10, 40)])
    merged = links.gene_merged(info, summary, gene, pairs)
    assert Counter(map(tuple, merged.collect())) == Counter(
        ("G1", "CDS", 1, 5, i % 2, None) for i in range(10, 40)
    )


def test_upsert(table):
    stored = table("k a b", [("1", "x", None), ("2", "y", "y"), ("3", "z", "z")])
    incoming = table("k b a", [("1", "x", None), ("2", "y", "y"), ("4", None, "n")])
    # (x, NULL) became (NULL, x): a hash that passes over NULLs would not see it.
    assert rows(changed_rows(stored, incoming).select("k", "a", "b")) == [
        ("1", None, "x"), ("4", "n", None),
    ]
    assert rows(upsert(stored, incoming, "k")) == [
        ("1", None, "x"), ("2", "y", "y"), ("3", "z", "z"), ("4", "n", None),
    ]


def test_upsert_against_brute_force(table):
    draw = random.Random(3)
    stored = {str(i): str(draw.randrange(3)) for i in range(200)}
    incoming = {str(i): str(draw.randrange(3)) for i in range(100, 300)}
    got = upsert(table("k v", list(stored.items())), table("k v", list(incoming.items())), "k")
    assert rows(got) == sorted({**stored, **incoming}.items(), key=repr)


def test_replace_keys(table):
    stored = table("k v", [("1", "a"), ("1", "b"), ("2", "c")])
    incoming = table("k v", [("1", "n"), ("3", "m"), ("3", "m")])
    assert rows(replace_keys(stored, incoming, "k")) == [("1", "n"), ("2", "c"), ("3", "m"), ("3", "m")]


def test_quality(table):
    disease = table(None, [("DS1", 1), ("DS1", 2), ("DS2", None)], "DISEASE_ID string, DISEASE_NAME_COUNT int")
    names = table(
        "DISEASE_ID DISEASE_NAME LOOKUP_SOURCE",
        [("DS1", "a", "disease"), ("DS9", "b", "disease"), ("DS9", None, "much too wide")],
    )
    found = quality.all_checks(
        {"kegg_human_disease": disease, "kegg_human_disease_name_lookup": names}
    )
    assert rows(found) == sorted(
        [
            ("kegg_human_disease", "unique", "DISEASE_ID", "DS1", 2),
            ("kegg_human_disease", "not_null", "DISEASE_NAME_COUNT", None, 1),
            ("kegg_human_disease_name_lookup", "not_null", "DISEASE_NAME", None, 1),
            ("kegg_human_disease_name_lookup", "width", "LOOKUP_SOURCE", None, 1),
            ("kegg_human_disease_name_lookup", "reference", "DISEASE_ID", "DS9", 2),
        ],
        key=repr,
    )
    pairs = table("NCBI_GENE_ID GENE_ID", [(None, None)])
    assert rows(quality.column_checks(pairs, "kegg_human_ncbi_gene_lookup")) == []


def test_type_check(table):
    raw = table("VARIANT_ID VARIANT_NAME VARIANT_VERSION GENE_SYMBOL", [("V1", "n", "x", "s"), ("V1", "n", "2", "s")])
    assert rows(quality.column_checks(raw, "kegg_human_variant")) == [
        ("kegg_human_variant", "type", "VARIANT_VERSION", None, 1)
    ]


def test_rows_split_as_the_checks_count(spark, tmp_path):
    rows = [("V1", "n", "1", "S"), (None, "n" * 101, "x", "S"), ("V2", None, None, "S" * 21), ("V3", "n", "3", "")]
    loose = spark.createDataFrame(rows * 2, "VARIANT_ID string, VARIANT_NAME string, VARIANT_VERSION string, GENE_SYMBOL string")
    accepted, rejected, found = quality.split_rows(loose, "kegg_human_variant", str(tmp_path))
    assert sorted(map(tuple, accepted.collect())) == sorted([("V1", "n", 1, "S"), ("V3", "n", 3, "")] * 2)
    broken = {(r.VARIANT_ID, tuple(sorted(r.BROKEN))) for r in rejected.collect()}
    assert broken == {
        (None, ("not_null VARIANT_ID", "type VARIANT_VERSION", "width VARIANT_NAME")),
        ("V2", ("not_null VARIANT_NAME", "not_null VARIANT_VERSION", "width GENE_SYMBOL")),
    }
    assert sorted(map(str, found.collect())) == sorted(map(str, quality.column_checks(loose, "kegg_human_variant").collect()))
    clean = quality.split_rows(loose.limit(0), "kegg_human_variant", str(tmp_path / "none"))
    assert [df.count() for df in clean] == [0, 0, 0]


def test_resolved_symbols(spark):
    ranked = spark.createDataFrame(
        [("A", "G1", 1), ("A", "G2", 2), ("A", "G1", 4), ("B", "G1", 3), ("B", "G2", 3), ("B", "G3", 4), ("C", "G5", 4)],
        "GENE_SYMBOL string, GENE_ID string, RANK int",
    )
    resolved = links.resolved_symbols(ranked)
    assert sorted(map(tuple, resolved.collect())) == [("A", "G1", 1, 1), ("B", None, 3, 2), ("C", "G5", 4, 0)]
    variant = spark.createDataFrame([("V1", 1, "A"), ("V1", 2, "B"), ("V2", 1, "D"), ("V3", 1, None)], "VARIANT_ID string, VARIANT_VERSION int, GENE_SYMBOL string")
    assert sorted(map(tuple, links.variant_gene(variant, resolved).collect())) == [
        ("V1", 1, "A", "G1", 1, 1), ("V1", 2, "B", None, 3, 2), ("V2", 1, "D", None, None, None), ("V3", 1, None, None, None, None),
    ]
