"""The stages of the pipeline, one after the other, each against a plain version on its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from codonmill.llm import mixing, packing, quality_rules
from tests.llm import brute
from tests.llm.conftest import SF
from tests.llm.test_operators import assert_packed


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of every stage, as rows."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        found.append((docs, out))
        docs = out
    return dict(zip([name for name, _ in corpus_pipeline.STAGES], found, strict=True))


def test_order_and_columns(steps):
    assert list(steps) == ["quality_rules", "jaccard_join", "secret_scan", "mixing", "packing"]
    for docs, out in list(steps.values())[:-1]:
        assert out.dtypes == docs.dtypes


def test_quality(steps):
    docs, out = steps["quality_rules"]
    failed = {r.doc_id for r in docs.collect() if brute.quality(r.text)[-1]}
    judged = {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}
    kept = {r.doc_id for r in out.collect()}
    assert kept == judged and not kept & failed and len(kept) > 0.7 * docs.count()


def test_groups(steps):
    docs, out = steps["jaccard_join"]
    groups = brute.similar([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, c in groups.values()})
    assert out.count() < docs.count()


def test_secrets(steps):
    docs, out = steps["secret_scan"]
    before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
    assert before.keys() == after.keys()
    for doc_id, row in before.items():
        assert not brute.secrets(after[doc_id].text)
        if not brute.secrets(row.text):
            assert after[doc_id] == row
        else:
            assert after[doc_id].n_chars == len(after[doc_id].text)


def test_mixing(steps):
    docs, out = steps["mixing"]
    times = Counter(r.doc_id for r in out.collect())
    taken = {r.doc_id: r for r in mixing.mix(docs)[2].collect()}
    assert all(times[d] == int(r.taken / r.size + 0.5) for d, r in taken.items()) and max(times.values()) <= 2
    sizes, want = Counter(), Counter()
    for r in docs.collect():
        sizes[r.source] += len(brute.words(r.text))
    for r in out.collect():
        want[r.source] += len(brute.words(r.text))
    total = brute.targets(sizes)
    assert abs(sum(want.values()) - sum(total.values())) < 0.1 * sum(total.values())


def test_packing(steps):
    docs, out = steps["packing"]
    rows = out.collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(r.doc_id for r in docs.collect())
    bound = -(-sum(r.length for r in rows) // packing.CAPACITY)
    assert bound <= assert_packed(rows) <= bound + 1


def test_run(spark, steps):
    names = ["doc_id", "piece", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SF).select(*names).collect()
    assert Counter(got) == Counter(steps["packing"][1].select(*names).collect())


def test_stages_take_empty_and_odd_rows(spark):
    """No rows; null ids, texts and sources; repeated rows; columns of other names."""
    long = " ".join(f"the w{i} of" for i in range(40))
    rows = [(1, long, None), (1, long, None), (None, long, "b"), (2, None, "b"), (3, "", None), (4, long + " x", "a")]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, sequence_id int, size int"
    full = [(d, t, "en", s, len(t or ""), 1, 1) for d, t, s in rows]
    for some in (full, []):
        docs = spark.createDataFrame(some, ddl)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), ddl)
        ids = Counter(r.doc_id for r in docs.collect())
        assert set(ids) <= {1, None} and (not some or ids)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_repeated_ids_lose_no_text(spark):
    """Every (id, text) stays that is no later near copy of one that stays."""
    text = lambda a: " ".join(f"{a}{i}" for i in range(200))
    rows = [
        (1, text("a")), (1, text("b")), (1, text("a")), (2, text("c")), (2, text("c")), (3, text("c")),
        # Texts of one id that belong to unlike groups do not join these.
        (4, text("x")), (5, text("x") + " end"), (4, text("z")), (6, text("z") + " end"), (7, text("b") + " more"),
        (None, text("n")), (None, text("n")), (8, None), (9, ""), (8, "short"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter(map(tuple, corpus_pipeline.one_of_each_group(spark, docs, SF).collect()))
    assert max(n for (i, _), n in kept.items() if i is not None) == 1
    expected = {(1, text("a")), (1, text("b")), (2, text("c")), (None, text("n")), (8, None), (9, ""), (8, "short")}
    groups = [{(4, text("x")), (5, text("x") + " end")}, {(4, text("z")), (6, text("z") + " end")}]
    assert expected <= set(kept) and kept[None, text("n")] == 2
    rest = set(kept) - expected
    assert all(len(rest & group) == 1 for group in groups) and len(rest) == 2
