"""Golden values of the column expressions."""

import random

import pytest
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.functions import identifiers as ids
from codonmill.functions import names, positions, text

X = None


@pytest.fixture(autouse=True)
def _column(spark):
    # Columns can be made only once a session runs.
    global X
    X = F.col("x")


def evaluate(table, values, *columns):
    df = table("x", [(v,) for v in values])
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


POSITIONS = [
    ("1:11874..14409", 14409, 11874, 0, "1"),
    ("1:complement(14362..29370)", 29370, 14362, 1, "1"),
    ("6:join(1..2,3..4)", 0, 0, 0, "6"),
    ("6:complement(join(1..2,3..4))", 0, 0, 1, "6"),
    ("X:5000", 0, 5000, 0, "X"),
    ("1p36.1", 0, 0, 0, "1"),
    ("12q24", 0, 0, 0, "12"),
    ("MT:1..5", 5, 1, 0, "MT"),
    ("X; Y", 0, 0, 0, "X;Y"),
    ("Un", 0, 0, 0, "Unknown"),
    ("Un:1..2", 2, 1, 0, "Un"),
    ("13cen", 0, 0, 0, "13"),
    ("", 0, 0, 0, "Unknown"),
    ("2:<1..>9", 0, 0, 0, "2"),
    # As written by int(): blanks around, a sign, grouped digits; no fractions.
    ("3: 7 .. +8 ", 8, 7, 0, "3"),
    ("3:1_000..2_000_000", 2000000, 1000, 0, "3"),
    ("3:1__0..2_", 0, 0, 0, "3"),
    ("3:1.5..2.5", 0, 0, 0, "3"),
    ("3:5...9", 0, 5, 0, "3"),
    ("3:5..9..7:8", 9, 5, 0, "3"),
    ("complement(5..9)(7)", 9, 5, 1, "complement(5..9)(7)"),
    ("complement", 0, 0, 1, "complement"),
    (None, 0, 0, 0, "Unknown"),
]


def test_gene_list_positions(table):
    got = evaluate(
        table,
        [p[0] for p in POSITIONS],
        positions.chr_start(X),
        positions.chr_stop(X),
        positions.complement_flag(X),
        positions.list_chromosome(X),
    )
    assert got == [p[1:] for p in POSITIONS]


def test_gene_names_and_symbols(table):
    got = evaluate(
        table,
        ["MIR6859-1, hsa-mir-6859-1; microRNA 6859-1", "uncharacterized", "A; b; c", None],
        names.gene_name(X),
        names.gene_symbols(X),
    )
    assert got == [
        (" microRNA 6859-1", ["MIR6859-1", "hsa-mir-6859-1"]),
        ("uncharacterized", ["None"]),
        (" b", ["A"]),
        (None, None),
    ]


def test_pathway_classes(table):
    ids_in = ["P11100", "P12200", "P10001", "P70110", "P07011", "P00010", None]
    assert evaluate(table, ids_in, ids.pathway_class(X)) == [
        "global_map",
        "overview_map",
        "chemical_struc_map",
        "drug_struc_map",
        "regular_map",
        "regular_map",
        None,
    ]


@pytest.mark.parametrize(
    ("pairs", "text", "want"),
    [
        (fv.PATHWAY_LIST_REWRITES, "hsa00010", "P00010"),
        (fv.LINK_REWRITES["PATHWAY_ID"], "path:hsa00010", "P00010"),
        (fv.LINK_REWRITES["PATHWAY_ID"], "path:map00010", "P00010"),
        (fv.DISEASE_LIST_REWRITES, "H00001", "DS00001"),
        (fv.DISEASE_LIST_REWRITES, "HH1", "DSDS1"),
        (fv.LINK_REWRITES["NCBI_GENE_ID"], "ncbi-geneid:7", "G7"),
        (fv.GO_REWRITES, "GO:0001", "GO0001"),
    ],
)
def test_rewrites(table, pairs, text, want):
    assert evaluate(table, [text, None], ids.rewrite(X, pairs)) == [want, None]


def test_pathway_name(table):
    got = evaluate(
        table,
        ["Glycolysis / Gluconeogenesis - Homo sapiens (human)", "A - B - Homo"],
        text.before(X, " - "),
    )
    assert got == ["Glycolysis / Gluconeogenesis", "A"]


def test_variant_ids(table):
    got = evaluate(
        table, ["1019v1", "av2v3", "v1", "abc", None], ids.variant_id(X), ids.variant_version(X)
    )
    assert got == [("V1019", "1"), ("Vav2", "3"), ("V", "1"), (None, None), (None, None)]


def test_module_names(table):
    got = evaluate(
        table,
        ["Glycolysis (Embden-Meyerhof pathway), glucose => pyruvate", "A, b (c), d", "Plain", None],
        names.module_names(X),
    )
    assert got == [
        ["Glycolysis", "Embden-Meyerhof pathway"],
        ["A", " b", "c"],
        ["Plain"],
        [None],
    ]


def test_references_and_features(table):
    got = evaluate(
        table,
        ["HGNC:HGNC:5", "regulatory:enhancer:x", "misc"],
        text.before(X, ":"),
        text.after_last(X, ":"),
        names.feature_name(X),
    )
    assert got == [("HGNC", "5", "HGNC"), ("regulatory", "x", "enhancer"), ("misc", "misc", None)]


def test_bar_fields(table):
    values = ["-", "Un", "X|Y", "XY", "1|2", "19q13.43", None]
    assert evaluate(table, values, positions.bar_chromosome(X)) == [
        "Unknown", "Unknown", "X;Y", "X;Y", "1;2", "19q13.43", None,
    ]
    assert evaluate(table, ["-", "a|-|b", ""], names.bar_values(X)) == [["NaN"], ["a", "-", "b"], [""]]


def test_comma_chromosomes(table):
    values = ["", None, "Un", "X, Y", "1, 2", "7"]
    assert evaluate(table, values, positions.comma_chromosome(X)) == [
        "Unknown", "Unknown", "Unknown", "X;Y", "1;2", "7",
    ]


def test_labels_and_flags(table):
    assert evaluate(table, ["protein-coding", "unknown", "ncRNA", None], names.gene_type(X)) == [
        "CDS", "Unknown", "ncRNA", None,
    ]
    assert evaluate(table, ["O", "I", "-", None], names.flag(X, "O")) == [1, 0, 0, 0]


def test_approved_symbol(table):
    df = table("a s", [("A1BG", "X"), ("-", "LOC1"), ("-", "-")])
    got = [r[0] for r in df.select(names.approved_symbol(F.col("a"), F.col("s"))).collect()]
    assert got == ["A1BG", "LOC1", None]


def test_other_names(table):
    df = table(
        "n s",
        [("A1BG", "A1BG"), ("ND1", "MT-ND1"), ("LOC9", ""), ("B", "C"), (None, "C"), ("B", None)],
    )
    got = [r[0] for r in df.select(names.is_other_name(F.col("n"), F.col("s"))).collect()]
    assert got == [False, False, True, True, True, False]


def test_literal_gene_ids(table):
    got = evaluate(
        table,
        [
            "[{'NAME': 'A', 'GENE_ID': '12'}, {'NAME': 'B', 'GENE_ID': '13'}]",
            "[{'NAME': \"3'x\", 'GENE_ID': '14'}]",
            "[{'NAME': 'A', 'GENE_ID': 15}]",
            "[]",
            None,
        ],
        names.literal_gene_ids(X),
    )
    assert got == [["12", "13"], ["14"], ["15"], [], None]


def test_keyed_values(table):
    got = evaluate(
        table,
        [
            "HGVS=NC_1:g.5=|LEN=1|LEN=2",
            "LEN",
            "SEQ=|XLEN=3",
            "",
            None,
            "LEN=1|LEN",
            "LEN|LEN=4=5",
            "A=LEN=7|HGVS=x|",
        ],
        *[names.keyed_value(X, key) for key in ("HGVS", "LEN", "SEQ")],
    )
    assert got == [
        ("NC_1:g.5", "2", None),
        (None, None, None),
        (None, None, ""),
        (None, None, None),
        (None, None, None),
        (None, None, None),
        (None, "4", None),
        ("x", None, None),
    ]


def test_starts_and_organism(spark):
    df = spark.createDataFrame(
        [([(5, 9, 2)], (9606,)), ([(999999999, 7, None)], (1,)), ([], None), (None, None)],
        "g array<struct<ChrStart:int,ChrStop:int,ExonCount:int>>, o struct<TaxID:int>",
    )
    first = lambda field: positions.genomic_info(F.col("g"), field)
    got = df.select(
        positions.start_or_zero(first("CHRSTART")),
        first("CHRSTOP"),
        first("EXONCOUNT"),
        positions.organism_tax_id(F.col("o")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (5, 9, 2, 9606), (0, 7, None, 1), (0, None, None, None), (0, None, None, None),
    ]


PIECES = ["a", "b", "é", ", ", ",", "; ", "|", "..", ".", "v", "\u0001", " "]


@pytest.mark.parametrize("mark", [";", ", ", "; ", "..", "|", "v", ","])
def test_text_parts_are_those_of_split(table, mark):
    draw = random.Random(mark)
    values = ["", mark, mark * 2, mark * 3] + [
        "".join(draw.choice([*PIECES, mark, mark]) for _ in range(draw.randrange(9))) for _ in range(150)
    ]
    got = evaluate(
        table, values, text.before(X, mark), text.second(X, mark), text.after_last(X, mark), text.parts(X, mark)
    )
    for value, (before, second, last, parts) in zip(values, got, strict=True):
        split = value.split(mark)
        assert (before, parts) == (split[0], split), value
        assert second == (split[1] if len(split) > 1 else None), value
        assert last == value.rsplit(mark, 1)[-1], value
    got = evaluate(table, values, text.before_last(X, mark))
    assert got == [v.rsplit(mark, 1)[0] if mark in v else None for v in values]
