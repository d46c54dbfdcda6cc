"""Run-length index, fill-in-the-middle and conversation trie against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from codonmill.llm import conversation_trie as ct
from codonmill.llm import fill_in_middle as fim
from codonmill.llm import mixing, queries
from codonmill.llm import run_index_dedup as rid
from harness.compare import difference, oracle_connection
from tests.llm.conftest import SF
from tests.llm.test_operators import HARD

LENGTH = rid.LENGTH


# --- 11 ----------------------------------------------------------------------


def plain_removal(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    known = Counter(t[i : i + LENGTH] for _, t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for ident, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - LENGTH + 1):
            if known[text[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\x01" * LENGTH
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        out.append((ident, len(text), sum(gone), len(re.findall(b"\x01+", gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def removal(docs, **how):
    rows = rid.remove_repeats(docs, **how).collect()
    digest = lambda kept: hashlib.sha256(kept).hexdigest()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, digest(r.kept)) for r in rows), key=repr)


def prose(draw, n):
    return "".join(draw.choice("abcdefgh  \n") for _ in range(n))


@pytest.fixture(scope="module")
def repetitive(make):
    draw = random.Random(5)
    passage, line = prose(draw, 700), prose(draw, 230)
    rows = [(i, prose(draw, 300) + passage + prose(draw, 500)) for i in range(12)]
    rows += [(20, passage[:399]), (21, passage[:400]), (22, passage[1:401] + "é" * 300), (23, "é" * 201)]
    # Repeats within one text, of periods below and above the width of a window.
    rows += [(30, line * 5), (31, "ab" * 900), (32, prose(draw, 450) * 2), (33, "\x00" * 1000), (34, "\x00" * 399)]
    whole = prose(draw, 2000)
    rows += [(40, whole), (41, whole), (42, whole[:1000] + "X" + whole[1000:]), (43, whole + "Y"), (40, whole)]
    return rows + HARD[:3] + [(None, whole), (None, None)]


def test_removal_against_plain_version(make, repetitive):
    assert removal(make(repetitive)) == plain_removal(repetitive)


def test_frequent_marks_are_counted_alike(make, repetitive):
    """With tiny buckets every mark counts as too frequent for one."""
    assert removal(make(repetitive), bucket=8) == plain_removal(repetitive)


def test_removal_of_given_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert removal(documents) == plain_removal(rows)


def test_removal_of_nothing(make):
    assert removal(make([])) == []
    assert removal(make([(1, "x" * 399)])) == plain_removal([(1, "x" * 399)])


def test_run_index_is_smaller_where_texts_repeat():
    draw = random.Random(1)
    base = prose(draw, 5000).encode()
    text = np.frombuffer(b"\xff".join([base] * 20) + b"\xff", np.uint8)
    index = rid.RunIndex(text)
    assert len(index.heads) < len(text) / 10
    assert index.lengths.sum() == len(text)
    order = rid.suffix_order(text)
    assert [bytes(text[i:]) for i in order[:300]] == sorted(bytes(text[i:]) for i in range(len(text)))[:300]


def test_matches_against_plain_version():
    draw = random.Random(2)
    parts = [prose(draw, 40).encode() for _ in range(3)]
    segments = [b"".join(draw.choices(parts, k=3)) + prose(draw, 5).encode() for _ in range(8)]
    text = np.frombuffer(b"".join(s + b"\xff" for s in segments), np.uint8)
    ends = np.cumsum([len(s) + 1 for s in segments])
    left = np.repeat(ends - 1, [len(s) + 1 for s in segments]) - np.arange(len(text))
    found = rid.RunIndex(text).matches(left)
    suffixes = [s[i:] for s in segments for i in range(len(s))]
    places = [i for i in range(len(text)) if text[i] != 255]

    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    for at, suffix in zip(places, suffixes, strict=True):
        best = max(common(suffix, other) for place, other in zip(places, suffixes, strict=True) if place != at)
        assert found[at] == best


def test_every_window_lies_in_one_segment():
    draw = random.Random(3)
    for text in (prose(draw, 30_000), "ab" * 5000, "x" * 400, prose(draw, 300) * 40):
        start, size, mark, again = rid.marks(text.encode())
        assert start[0] == 0 and size.sum() == len(text) - LENGTH + 1
        assert (np.diff(start) == size[:-1]).all() and size.max() <= rid.MOST_WINDOWS
    assert again.any() and not len(rid.marks(b"x" * 399)[0])


# --- 7: the mix itself --------------------------------------------------------


def test_blocks_of_the_mix(make):
    draw = random.Random(8)
    rows = [(i, " ".join(f"{i}.{j}" for j in range(draw.choice([3, 70, 200])))) for i in range(60)] + [(None, "x y"), (5, None)]
    docs = make(rows).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 3 == 1, "b"))
    again = docs.unionByName(docs.where("doc_id = 7"))
    drawn, _, taken = mixing.mix(again)
    blocks = mixing.mixed_blocks(again).collect()
    assert len(blocks) == drawn.count() == sum(r.slots for r in mixing.shard_counts(drawn).collect())
    assert {(r.source, r.slot) for r in blocks} == {(None if r.key == "2" else r.key[1:], r.slot) for r in drawn.collect()}
    words = Counter(w for r in blocks for w in r.text.split(" "))
    by_doc = Counter()
    for word, n in words.items():
        by_doc[word.split(".")[0]] += n
    for row in taken.collect():
        if row.doc_id is not None and row.doc_id != 7 and row.size:
            assert by_doc[str(row.doc_id)] == row.taken
    assert by_doc["7"] == sum(r.taken for r in taken.collect() if r.doc_id == 7)
    # Blocks are whole but for one at each source's end, and drawn as evenly as can be.
    lengths = Counter((r.source, r.text) for r in blocks)
    for source in {r.source for r in blocks}:
        short = {t for s, t in lengths if s == source and len(t.split(" ")) < mixing.BLOCK}
        assert len(short) <= 1
        drawn_times = [n for (s, _), n in lengths.items() if s == source]
        assert max(drawn_times) - min(drawn_times) <= 1


# --- 12 ----------------------------------------------------------------------


def plain_middle(ident, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return ident, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return ident, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return ident, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TRICKY = [(i, t) for i in range(100, 112) for t in (
    "a <P> b", "<<S", "P> x <M", " lead and trail \n", "　  wide x", "\U0001f600 \x00 y", "one", "\r\n", "S> <", "<S>",
)]


def test_middle_against_plain_version(make):
    rows = HARD + TRICKY
    out = fim.restore(fim.transform(make(rows)))
    got = sorted(map(tuple, out.collect()), key=repr)
    assert [g[:6] for g in got] == sorted((plain_middle(*r) for r in rows), key=repr)
    assert Counter((g[0], g[6]) for g in got) == Counter((i, t or "") for i, t in rows)


def test_middle_of_nothing(make):
    assert fim.restore(fim.transform(make([]))).count() == 0


def test_restore_keeps_other_columns(spark):
    rows = spark.createDataFrame([("a", "plain", "x", "old"), ("b", None, "y", "old")], "id string, form string, output string, restored string")
    assert sorted(map(tuple, fim.restore(rows).collect())) == [("a", "plain", "x", "x"), ("b", None, "y", None)]


def test_rotation_is_its_own_inverse():
    draw = random.Random(4)
    for _ in range(200):
        text = bytes(draw.choices(b"<>PSM ab", k=draw.randrange(1, 30)))
        if any(s in text for s in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE)):
            continue
        first, second = sorted(draw.choices(range(len(text) + 1), k=2))
        for form in ("psm", "spm"):
            assert fim.restored(fim.rearranged(text, first, second, form), form) == text


# --- 13 ----------------------------------------------------------------------


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own[c])] for c in own}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        family = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = turns.get(family, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, sequence in whole.items():
        for d in range(len(sequence) + 1):
            members[tuple(sequence[:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    totals = defaultdict(lambda: [0, 0])
    for k in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        totals[k][0] += not children[k]
        totals[k][1] += (len(members[k]) - 1) * words
        if k:
            totals[k[:-1]] = [a + b for a, b in zip(totals[k[:-1]], totals[k], strict=True)]
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(k))))
        parent = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), parent, len(m), children[k], *totals[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_of(df, **how):
    nodes = ct.trie(*ct.rebuilt(ct.ordered_turns(df)), **how).drop("p1", "p2")
    return sorted(map(tuple, nodes.collect()), key=repr)


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(6)
    rows = [(7, i, "user", f"turn {i // 2}") for i in range(70)] + [(27, i, "user", f"turn {i // 2}") for i in range(60)]
    for c in [*range(0, 90), -5, -20, -45, 10**12, 10**12 + 3, 2**63 - 1]:
        if draw.random() < 0.8:
            for i in range(draw.choice([1, 2, 3, 5])):
                turn = None if draw.random() < 0.1 else i
                rows.append((c, turn, draw.choice(["u", "a", None]), draw.choice(["x", "y z", None, "", " q  r"])))
    return rows + rows[-20:] + [(None, 1, "u", "x")]


def frame(spark, rows):
    schema = "conv_id long, turn long, role string, text string, depth int, words string, at string"
    return spark.createDataFrame([(*r, 1, "w", "a") for r in rows], schema)


@pytest.mark.parametrize("band", [2, 16])
def test_trie_against_plain_version(spark, talks, band):
    assert trie_of(frame(spark, talks), band=band) == plain_trie(talks)


def test_trie_of_nothing(spark):
    assert trie_of(frame(spark, [])) == []
    assert trie_of(frame(spark, [(None, 0, "u", "x")])) == []


def test_many_ends_at_one_node(spark):
    """More than one piece of ids, digested as a stream."""
    rows = [(c * 1000 - 400_000, 0, "u", "same") for c in range(1000)]
    assert trie_of(frame(spark, rows)) == plain_trie(rows)


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_conversation_trie"])
def test_queries_against_sql(spark, name):
    assert difference(spark, oracle_connection(SF), SF, name) is None


def test_registered(spark):
    columns = queries.QUERIES["op11_suffix_array_dedup"](spark, SF).columns
    assert columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {"op11_suffix_array_dedup", "op12_fill_in_middle", "op13_conversation_trie"} <= set(queries.QUERIES)
