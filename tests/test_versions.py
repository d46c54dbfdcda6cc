"""Sets of versions, updates by range, refreshes of changed files, merging streams."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from codonmill.plans import ranged
from codonmill.plans.refresh import Pipeline
from codonmill.sources.versions import Conflict, Entry, TableSet
from codonmill.streaming.landing import LANDED, last_landed, merge_new_files

LINKS = "kegg_human_pathway_gene_lookup"


def land(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(f"{line}\n" for line in lines))


def names(spark, base):
    return sorted((r.DISEASE_ID, r.DISEASE_NAME) for r in TableSet(spark, base).read("kegg_human_disease_name_lookup").collect())


def links(spark, rows):
    return spark.createDataFrame(rows, "PATHWAY_ID string, GENE_ID string")


def test_commit_shows_all_or_nothing(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    assert tables.latest() == 0 and tables.tables() == []
    with tables.change() as change:
        change.write(links(spark, [("P1", "G1")]), LINKS)
    with pytest.raises(ZeroDivisionError), tables.change() as change:
        change.write(links(spark, [("P2", "G2")]), LINKS)
        1 / 0  # noqa: B018
    assert [tuple(r) for r in tables.read(LINKS).collect()] == [("P1", "G1")]
    with tables.change() as change:
        change.write(links(spark, [("P3", "G3")]), LINKS, overwrite=False)
    assert tables.latest() == 2 and tables.read(LINKS).count() == 2 and tables.read(LINKS, 1).count() == 1
    # Only what the broken change wrote is named nowhere.
    orphans = lambda keep: {r.path.split("/")[-1] for r in tables.unreferenced(keep).collect()}
    in_use = {path.split("/")[-1] for path in tables.read(LINKS).inputFiles()}
    broken = orphans(1)
    assert broken and not broken & in_use
    with tables.change() as change:
        change.write(links(spark, [("P4", "G4")]), LINKS)
    assert orphans(2) == broken and orphans(1) == broken | in_use
    with pytest.raises(KeyError):
        tables.read("none")


def test_conflict_and_broken_commit(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    one, two = tables.change(), tables.change()
    one.write(links(spark, [("P1", "G1")]), LINKS)
    two.write(links(spark, [("P2", "G2")]), LINKS)
    assert one.commit() == 1
    with pytest.raises(Conflict):
        two.commit()
    # A commit that broke off before its file appeared.
    (tmp_path / "commits" / "commit=2" / "_temporary").mkdir(parents=True)
    assert tables.latest() == 1
    with tables.change() as change:
        change.write(links(spark, [("P5", "G5")]), LINKS)
    assert tables.latest() == 3 and tables.read(LINKS).first().PATHWAY_ID == "P5"


def test_failed_refresh_keeps_old_tables(spark, tmp_path):
    landing, base = tmp_path / "in", str(tmp_path / "out")
    land(landing, "kegg_human_disease.csv", ["H1\ta; b"])
    land(landing, "kegg_human_pathway.csv", ["hsa1\tone - x"])
    pipeline = Pipeline(spark, "kegg", str(landing), base, versioned=True)
    pipeline.refresh(["disease", "pathway"])
    land(landing, "kegg_human_disease.csv", ["H1\tc"])
    with pytest.raises(FileNotFoundError):
        pipeline.refresh(["disease", "module"])
    assert names(spark, base) == [("DS1", "a"), ("DS1", "b")]
    pipeline.refresh(["disease"])
    assert names(spark, base) == [("DS1", "c")] and len(pipeline.tables.tables()) == 3


def test_refresh_of_changed_files_only(spark, tmp_path):
    landing, base = tmp_path / "in", str(tmp_path / "out")
    land(landing, "kegg_human_disease_one.csv", ["H1\ta; b"])
    land(landing, "kegg_human_pathway.csv", ["hsa1\tone - x"])
    land(landing, "kegg_human_gene.csv", ["hsa:1\tCDS\t1:1..2\tA, B; x"])

    def refresh():
        pipeline = Pipeline(spark, "kegg", str(landing), base, versioned=True)
        return sorted(pipeline.refresh(["disease", "pathway", "gene"], changed_only=True))

    both = ["kegg_human_disease", "kegg_human_disease_name_lookup"]
    assert len(refresh()) == 5
    first = TableSet(spark, base).parts("kegg_human_disease")
    assert refresh() == []
    land(landing, "kegg_human_disease_two.csv", ["H2\tc"])
    assert refresh() == both
    # The rows of the old file were not read again.
    assert TableSet(spark, base).parts("kegg_human_disease")[:1] == first
    assert names(spark, base) == [("DS1", "a"), ("DS1", "b"), ("DS2", "c")]
    (landing / "kegg_human_disease_one.csv").unlink()
    assert refresh() == both and names(spark, base) == [("DS2", "c")]
    # Symbols are numbered over all files.
    land(landing, "kegg_human_gene_more.csv", ["hsa:1\tCDS\t1:1..2\tC; x"])
    assert refresh() == ["kegg_human_gene", "kegg_human_gene_symbol_lookup"]
    symbols = TableSet(spark, base).read("kegg_human_gene_symbol_lookup")
    assert sorted(r.GENE_ALIAS_NO for r in symbols.collect()) == [1, 2, 3]
    (landing / "kegg_human_disease_two.csv").unlink()
    refresh()
    assert TableSet(spark, base).tables() == ["kegg_human_gene", "kegg_human_gene_symbol_lookup", "kegg_human_pathway"]
    with pytest.raises(ValueError):
        Pipeline(spark, "kegg", str(landing), base).refresh(changed_only=True)


@pytest.fixture
def stored(spark, tmp_path):
    rows = [(f"P{i:03}", f"G{j}") for i in range(200) for j in range(1 + i % 3)] + [("P007", "G9")] * 2 + [(None, "G1")]
    tables = TableSet(spark, str(tmp_path))
    with tables.change() as change:
        ranged.save_ranged(change, links(spark, rows), LINKS, "PATHWAY_ID", ranges=8)
    return tables, rows


def updated(spark, tables, rows, came=None):
    with tables.change() as change:
        touched = ranged.update_ranged(change, links(spark, rows), LINKS, "PATHWAY_ID", came)
    return touched, Counter(map(tuple, tables.read(LINKS).collect()))


def test_update_touches_changed_ranges_only(spark, stored):
    tables, rows = stored
    before = tables.parts(LINKS)
    assert len(before) > 4 and Counter(map(tuple, tables.read(LINKS).collect())) == Counter(rows)
    # One id with other rows, one as it is, one new.
    touched, got = updated(spark, tables, [("P100", "new"), ("P050", "G0"), ("P050", "G1"), ("P050", "G2"), ("P0505", "x")])
    assert got == Counter([r for r in rows if r[0] != "P100"] + [("P100", "new"), ("P0505", "x")])
    after = tables.parts(LINKS)
    assert 1 <= len(touched) <= 2
    same = [a.data == b.data and a.digests == b.digests for a, b in zip(before, after, strict=True)]
    assert [e.part for e, s in zip(before, same, strict=True) if not s] == touched
    # What is as it was stored writes nothing, copies of a row included.
    assert updated(spark, tables, [("P007", "G0"), ("P007", "G1"), ("P007", "G9"), ("P007", "G9"), (None, "G1")])[0] == []
    touched, got = updated(spark, tables, [("P007", "G0"), ("P007", "G1"), ("P007", "G9")])
    assert len(touched) == 1 and got["P007", "G9"] == 1


def test_update_reads_touched_ranges_only(spark, stored, monkeypatch):
    tables, _ = stored
    read, paths = ranged._read, []
    monkeypatch.setattr(ranged, "_read", lambda s, folders, like: (paths.extend(folders), read(s, folders, like))[1])
    parts = {e.part: e for e in tables.parts(LINKS)}
    touched, _ = updated(spark, tables, [("P100", "new")])
    assert set(paths) == {parts[touched[0]].data, parts[touched[0]].digests}


def test_emptied_keys_and_ranges(spark, stored):
    tables, rows = stored
    came = links(spark, [(f"P{i:03}", "") for i in range(200)] + [("Q", "")]).select("PATHWAY_ID")
    touched, got = updated(spark, tables, [("P000", "G0")], came)
    assert got == Counter([("P000", "G0"), (None, "G1")])
    _, got = updated(spark, tables, [(None, "G2"), ("P199", "back")])
    assert got == Counter([("P000", "G0"), (None, "G2"), ("P199", "back")])


def test_ranges_against_plain_update(spark, stored):
    import random

    draw, (tables, rows) = random.Random(1), stored
    for _ in range(3):
        keys = draw.sample(range(220), 12)
        new = [(f"P{k:03}", f"G{j}") for k in keys for j in range(draw.randrange(1, 4))]
        rows = [r for r in rows if r[0] not in {n[0] for n in new}] + new
        assert updated(spark, tables, new)[1] == Counter(rows)


def test_update_reads_what_is_stored_once(spark, stored, monkeypatch):
    """One comparison of digests also gives those that stay; a missing key is one like others."""
    tables, rows = stored
    read, paths = ranged._read, []
    monkeypatch.setattr(ranged, "_read", lambda s, folders, like: (paths.extend(folders), read(s, folders, like))[1])
    new = [("P100", "new"), (None, "G5")]
    _, got = updated(spark, tables, new, links(spark, [*new, ("P101", "")]).select("PATHWAY_ID"))
    assert got == Counter([r for r in rows if r[0] not in ("P100", "P101", None)] + new)
    assert len(paths) == len(set(paths))
    assert updated(spark, tables, new)[0] == []


def test_last_landed_joins_ids_of_several_files_only(spark):
    """Without an id in two files, no row is shuffled; ties of time go to the larger path."""
    frame = lambda given: spark.sql("SELECT timestamp '2024-01-01' AS t").select(
        F.explode(F.lit(given)).alias("r"), "t"
    ).select(
        F.get("r", F.lit(0)).alias("ID"),
        F.get("r", F.lit(1)).alias("NAME"),
        F.struct(
            (F.col("t") + F.make_dt_interval(secs=F.get("r", F.lit(2)).cast("decimal(18,6)"))).alias("file_modification_time"),
            F.get("r", F.lit(3)).alias("file_path"),
        ).alias(LANDED),
    )
    alone = [["a", "1", "0", "x"], ["a", "2", "0", "x"], ["b", "3", "5", "y"]]
    last = last_landed(frame(alone), "ID")
    assert last.count() == 3
    assert "Exchange" not in last._jdf.queryExecution().executedPlan().toString()
    late = [["a", "4", "1", "w"], ["b", "5", "5", "z"], ["b", "6", "5", "x"], ["", "7", "1", "x"], ["", "8", "0", "y"]]
    got = last_landed(frame(alone + late), "ID").select("ID", "NAME").collect()
    assert sorted(map(tuple, got)) == [("", "7"), ("a", "4"), ("b", "5")]


def test_merging_stream(spark, tmp_path):
    landing, base, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    run = lambda: merge_new_files(spark, str(landing), "disease", base, checkpoint, 4).awaitTermination()
    land(landing, "kegg_human_disease_1.csv", ["H1\ta; b", "H2\tc", "H3\td"])
    run()
    land(landing, "kegg_human_disease_2.csv", ["H2\tnew; newer", "H4\te"])
    land(landing, "kegg_human_disease_3.csv", ["H3"])
    run()
    assert names(spark, base) == [("DS1", "a"), ("DS1", "b"), ("DS2", "new"), ("DS2", "newer"), ("DS4", "e")]
    assert TableSet(spark, base).read("kegg_human_disease").count() == 4
    number = TableSet(spark, base).latest()
    run()
    assert TableSet(spark, base).latest() == number


def test_last_file_of_a_batch_wins(spark, tmp_path):
    import os

    landing, base = tmp_path / "in", str(tmp_path / "out")
    for name, text, when in (("b", "H1\told", 1000), ("a", "H1\tnew; one", 2000)):
        land(landing, f"kegg_human_disease_{name}.csv", [text])
        os.utime(landing / f"kegg_human_disease_{name}.csv", (when, when))
    merge_new_files(spark, str(landing), "disease", base, str(tmp_path / "c")).awaitTermination()
    assert names(spark, base) == [("DS1", "new"), ("DS1", "one")]
    # The same batch once more changes nothing: the commit remembers it.
    remembered = [e for e in TableSet(spark, base).entries() if e.kind == "stream"]
    assert remembered == [Entry("stream", f"kegg/disease@{tmp_path / 'c'}", batch=0)]


def test_load_from_stage_in_another_session(spark, tmp_path):
    landing, stage, target = tmp_path / "in", str(tmp_path / "stage"), str(tmp_path / "out")
    land(landing, "kegg_human_disease.csv", ["H1\ta; b"])
    first = Pipeline(spark, "kegg", str(landing), stage=stage)
    first.extract("disease")
    first.save("disease")
    first.transform("disease")
    first.save("kegg_human_disease")
    (landing / "kegg_human_disease.csv").unlink()
    second = Pipeline(spark, "kegg", str(landing), target, stage=stage)
    assert spark.read.parquet(second.load("kegg_human_disease")).count() == 1
    # No processed table is staged under this name: it is made from the staged raw rows.
    assert spark.read.parquet(second.load("kegg_human_disease_name_lookup")).count() == 2
    with pytest.raises(KeyError):
        second.load("kegg_human_nothing")
    assert second.violations().where(F.col("RULE") == "unique").count() == 0
