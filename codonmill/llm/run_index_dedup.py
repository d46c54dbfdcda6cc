"""Removal of repeated byte strings by run-compressed indexes.

A string of `LENGTH` bytes that also starts anywhere else is removed, wherever it stands.

1. Segments: the smallest hash of the `GRAM`-byte strings in a window of `LENGTH` bytes is
   the window's mark. Neighbouring windows of one mark form a segment, so every window
   lies in one segment, and equal windows lie in segments of one mark. Equal texts are one
   text with a number of places, and equal segments one segment. Marks that have one place
   only, and whose string stands there once, need no look.
2. Index: segments are dealt to buckets by their mark. Of the text of a bucket, the
   Burrows-Wheeler transform is built and kept as runs, with the suffix-array samples of
   both ends of every run (`RunIndex`).
3. Matching statistics: the places of the samples cut the text into stretches along which
   the neighbour in suffix order moves on together with the place. So one comparison per
   sample and one pass over the text give each place the length of its longest match
   elsewhere in the bucket (`RunIndex.matches`); samples are as many as runs, few where
   texts repeat. Places with `LENGTH` bytes or more, and segments with two places, are
   repeated.
4. Marks whose distinct segments are more than `BUCKET` / 2 bytes, as those in a passage
   that very many texts share, would not fit a bucket. Their windows are counted by 128-bit
   digests instead, which any number of tasks can share.
5. Repeated stretches go back to the texts, which are cut.

The text is moved twice, other steps move segments of shared marks only.

Rows: null texts are empty ones. Texts under `LENGTH` bytes have no window. Repeated rows
are repeated text. A null id is an id like others. Matches never cross texts. Only the id
and the text column are read, so other columns may have any names. An empty table gives an
empty table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codonmill.llm.chunks import mixed
from codonmill.session import shared_folder

LENGTH = 400
GRAM = 16
#: Bytes of segments in a bucket, on average.
BUCKET = 1024 * 1024
#: A segment has so many windows at most; longer ones are cut in several.
MOST_WINDOWS = 4096
#: Bytes that are hashed at a time.
AT_ONCE = 4 * 1024 * 1024

#: Stands between segments of a bucket; a byte that UTF-8 never uses.
BETWEEN = 255
_BYTES = np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


# --- segments ----------------------------------------------------------------


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, the first of them highest; missing ones are 0."""
    padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    twos = (padded[:-1] << np.uint64(8)) | padded[1:]
    fours = (twos[:-2] << np.uint64(16)) | twos[2:]
    return ((fours[:-4] << np.uint64(32)) | fours[4:])[: len(data)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on that has as many."""
    words = eights(data)
    n = len(data) - GRAM + 1
    return mixed(words[:n] * _FIRST + words[8 : n + 8] * _SECOND)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` neighbours, from minima over powers of two."""
    least, span = values, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def marks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of windows, mark, whether the mark's string stands there again) of a text's segments."""
    starts, found, again = [], [], []
    span = LENGTH - GRAM
    windows = len(text) - LENGTH + 1
    data = np.frombuffer(text, np.uint8)
    for low in range(0, max(windows, 0), AT_ONCE):
        part = data[low : low + AT_ONCE + LENGTH - 1]
        hashes = gram_hashes(part)
        least = window_minima(hashes, span + 1)
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        ends = np.append(first[1:], len(least)) + span
        starts.append(first + low)
        found.append(least[first])
        rows = zip(first.tolist(), ends.tolist(), found[-1], strict=True)
        again.append(np.array([np.count_nonzero(hashes[a:b] == m) > 1 for a, b, m in rows], bool))
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    start, mark, twice = np.concatenate(starts), np.concatenate(found), np.concatenate(again)
    size = np.diff(np.append(start, windows))
    pieces = -(-size // MOST_WINDOWS)
    if pieces.max() > 1:
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        rest = np.repeat(size, pieces) - number * MOST_WINDOWS
        start = np.repeat(start, pieces) + number * MOST_WINDOWS
        mark, twice, size = np.repeat(mark, pieces), np.repeat(twice, pieces), np.minimum(rest, MOST_WINDOWS)
    return start, size, mark, twice


def _marked(batches):
    """Texts without their text: arrays of their segments' places, marks and digests."""
    for batch in batches:
        columns: list[list] = [[] for _ in _SEGMENT]
        for whole in batch["text"]:
            text = whole.as_buffer().to_pybytes()
            start, size, mark, twice = marks(text)
            pairs = zip(start.tolist(), (start + size + LENGTH - 1).tolist(), strict=True)
            digests = [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in pairs]
            for column, values in zip(columns, (start, size, mark.view(np.int64), digests, twice), strict=True):
                column.append(np.array(values, np.uint64).view(np.int64))
        lists = [_lists(c) for c in columns]
        kept = [batch[c] for c in ("k1", "k2", "who")]
        yield pa.RecordBatch.from_arrays([*kept, *lists], names=["k1", "k2", "who", *_SEGMENT])


_SEGMENT = ["start", "size", "mark", "digest", "again"]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, k1, k2, who): k1 and k2 are a digest of the text, `who` one of the id."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.select(
        "*",
        F.xxhash64("text").alias("k1"),
        F.xxhash64(F.lit(1), "text").alias("k2"),
        F.xxhash64(F.lit(2), "doc_id").alias("who"),
    )


# --- index -------------------------------------------------------------------


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of all suffixes in their order, by doubling the length they are sorted by.

    The text ends with a byte that it has nowhere else in its last eight. Only places whose rank
    is shared are looked at again. What is sorted is one number for each place: rank, rank
    of what follows, and the place itself in its low bits, where these fit 64 bits.
    """
    n = len(text)
    bits = max(1, int(n).bit_length())
    packs = 3 * bits <= 64
    low = np.uint64((1 << bits) - 1)
    if packs:
        span = min(8, (64 - bits) // 8)
        keys = eights(text) >> np.uint64(64 - 8 * span)
        mixed_keys = np.sort((keys << np.uint64(bits)) | np.arange(n, dtype=np.uint64))
        order = (mixed_keys & low).astype(np.int64)
        ordered = mixed_keys >> np.uint64(bits)
    else:
        span, keys = 8, eights(text)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    # Slots of the order that share their rank with a neighbour.
    open_slots = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(open_slots):
        places = order[open_slots]
        pair = (rank[places].astype(np.uint64) << np.uint64(bits if packs else 32)) | (
            rank[np.minimum(places + span, n)] + 1
        ).astype(np.uint64)
        if packs:
            sorted_pairs = np.sort((pair << np.uint64(bits)) | places.astype(np.uint64))
            places, pair = (sorted_pairs & low).astype(np.int64), sorted_pairs >> np.uint64(bits)
        else:
            again = np.argsort(pair, kind="stable")
            places, pair = places[again], pair[again]
        order[open_slots] = places
        fresh = np.concatenate(([True], pair[1:] != pair[:-1]))
        rank[places] = open_slots[np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))]
        open_slots = open_slots[~(fresh & np.append(fresh[1:], True))]
        span *= 2
    return order


class RunIndex:
    """A Burrows-Wheeler transform as runs, with suffix-array samples of the runs' ends.

    `heads` and `lengths` are the runs' bytes and lengths. `first` are the places of the
    suffixes at the runs' starts and `before` those just above them in suffix order; `last`
    and `after` are those at the runs' ends and just below. Suffixes that begin a segment
    are runs of their own, since what precedes them is no part of a text.
    """

    def __init__(self, text: np.ndarray):
        order = suffix_order(text)
        preceding = text[order - 1]
        apart = preceding == BETWEEN
        new = np.concatenate(([True], (preceding[1:] != preceding[:-1]) | apart[1:]))
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(order)) - 1
        self.text = text
        self.heads, self.lengths = preceding[starts], ends - starts + 1
        self.first, self.last = order[starts], order[ends]
        self.before = np.concatenate(([-1], order[starts[1:] - 1]))
        self.after = np.append(order[ends[:-1] + 1], -1)

    def matches(self, left: np.ndarray) -> np.ndarray:
        """For each place, the length of its longest match at another place.

        `left` is the number of bytes from a place to the end of its segment.
        """
        words = eights(self.text)
        one = self._along(words, left, self.first, self.before)
        return np.maximum(one, self._along(words, left, self.last, self.after))

    def _along(self, words: np.ndarray, left: np.ndarray, samples: np.ndarray, neighbours: np.ndarray) -> np.ndarray:
        """Matches with one neighbour in suffix order: between samples, a step costs a byte."""
        by_place = np.argsort(samples, kind="stable")
        samples, neighbours = samples[by_place], neighbours[by_place]
        common = common_bytes(words, left, samples, neighbours)
        at = np.zeros(len(left), np.int64)
        at[samples] = np.arange(len(samples))
        at = np.maximum.accumulate(at)
        return common[at] - (np.arange(len(left)) - samples[at])


def common_bytes(words: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning from places a and b on, within their segments; b may be -1."""
    limit = np.where(b >= 0, np.minimum(left[a], left[b]), 0)
    found = np.zeros(len(a), np.int64)
    open_ = np.flatnonzero(limit > 0)
    x, y, top = a[open_], b[open_], limit[open_]
    done = 0
    while len(open_):
        differ = words[x + done] ^ words[y + done]
        # Eight less the bytes up to the highest that differs are alike.
        same = 8 - np.searchsorted(_BYTES, differ, side="right")
        reach = done + same
        ended = (same < 8) | (reach >= top)
        found[open_[ended]] = np.minimum(reach, top)[ended]
        go = ~ended
        open_, x, y, top = open_[go], x[go], y[go], top[go]
        done += 8
    return found


def repeated_windows(contents: list[bytes], counts: list[int]) -> list[np.ndarray]:
    """For each segment, the starts of its windows that occur elsewhere too."""
    sizes = np.array([len(c) for c in contents])
    text = np.frombuffer(b"".join(c + b"\xff" for c in contents), np.uint8)
    ends = np.cumsum(sizes + 1)
    left = np.repeat(ends - 1, sizes + 1) - np.arange(len(text))
    best = RunIndex(text).matches(left)
    found = []
    for size, end, count in zip(sizes.tolist(), ends.tolist(), counts, strict=True):
        begin = end - size - 1
        here = best[begin : begin + size - LENGTH + 1] >= LENGTH
        found.append(np.arange(len(here)) if count > 1 else np.flatnonzero(here))
    return found


def runs(starts: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last of the runs of neighbouring numbers in an ascending array."""
    if not len(starts):
        return [], []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.append(0, cut + 1)].tolist(), starts[np.append(cut, len(starts) - 1)].tolist()


_FOUND = "mark long, digest long, low array<int>, high array<int>"


def _searched(table: pa.Table) -> pa.Table:
    found = repeated_windows(table["content"].to_pylist(), table["places"].to_pylist())
    spans = [runs(f) for f in found]
    return pa.table(
        {
            "mark": table["mark"],
            "digest": table["digest"],
            "low": pa.array([s[0] for s in spans], pa.list_(pa.int32())),
            "high": pa.array([s[1] for s in spans], pa.list_(pa.int32())),
        }
    )


# --- windows of very frequent marks --------------------------------------------


def window_hashes(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each window, from hashes of powers of two of bytes."""
    data = np.frombuffer(content, np.uint8)
    out = []
    for salt in (_FIRST, _SECOND):
        spans = {8: mixed(eights(data)[: len(data) - 7] ^ salt)}
        span = 8
        while span * 2 <= LENGTH:
            h = spans[span]
            spans[span * 2] = mixed(h[:-span] * salt + h[span:])
            span *= 2
        n = len(data) - LENGTH + 1
        total, at, rest = np.zeros(n, np.uint64), 0, LENGTH
        while rest:
            # The last piece may overlap the one before it.
            piece = max(s for s in spans if s <= rest or s == 8)
            at = min(at, LENGTH - piece)
            total = mixed(total * salt + spans[piece][at : at + n])
            at, rest = at + piece, max(0, rest - piece)
        out.append(total)
    return out[0], out[1]


def _windowed(batches):
    for batch in batches:
        rows = zip(*[batch[c].to_pylist() for c in ("mark", "digest", "places", "content")], strict=True)
        for mark, digest, places, content in rows:
            first, second = window_hashes(content)
            n = len(first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(first.view(np.int64)),
                    pa.array(second.view(np.int64)),
                    pa.array(np.arange(n, dtype=np.int32)),
                    pa.array(np.full(n, mark)),
                    pa.array(np.full(n, digest)),
                    pa.array(np.full(n, places)),
                ],
                names=["w1", "w2", "at", "mark", "digest", "places"],
            )


def _counted_windows(contents: DataFrame, written: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """As `_searched`, for segments of marks that no bucket can hold.

    What a join brings to very frequent keys is written, so that the join can deal them out.
    """
    rows = contents.mapInArrow(_windowed, "w1 long, w2 long, at int, mark long, digest long, places long")
    twice = rows.groupBy("w1", "w2").agg(F.sum("places").alias("n")).where("n > 1").select("w1", "w2")
    twice = written(twice, "twice")
    found = rows.join(twice, ["w1", "w2"]).groupBy("mark", "digest").agg(F.sort_array(F.collect_set("at")).alias("s"))
    before = F.filter("s", lambda x, i: (i == 0) | (F.get("s", i - 1) < x - 1))
    last = F.filter("s", lambda x, i: (i == F.size("s") - 1) | (F.get("s", i + 1) > x + 1))
    return found.select("mark", "digest", before.alias("low"), last.alias("high"))


# --- the whole ---------------------------------------------------------------


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """One row per row of `docs`, see SCHEMA; `kept` is what remains of the text's bytes."""
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = keyed(docs, doc_id, text)
    arrays = ", ".join(f"{c} array<long>" for c in _SEGMENT)
    long_rows = rows.where(F.octet_length("text") >= LENGTH).select("k1", "k2", "who", "text")
    per_row = long_rows.mapInArrow(_marked, f"k1 long, k2 long, who long, {arrays}")
    texts = written(
        per_row.groupBy("k1", "k2").agg(
            F.count(F.lit(1)).alias("places"),
            F.min("who").alias("who"),
            F.first(F.struct(*_SEGMENT)).alias("segment"),
        ),
        "texts",
    )
    segment = F.explode(F.arrays_zip(*[F.col("segment")[c].alias(c) for c in _SEGMENT])).alias("s")
    placed = texts.select("k1", "k2", "who", "places", segment).select("k1", "k2", "who", "places", "s.*")

    place = F.struct("k1", "k2", "who", "start", "size")
    distinct = written(
        placed.groupBy("mark", "digest").agg(
            F.sum("places").alias("places"), F.max("again").alias("again"), F.min(place).alias("at")
        ),
        "distinct",
    )
    size = F.col("at.size") + LENGTH - 1
    shared = distinct.groupBy("mark").agg(
        F.sum("places").alias("n"), F.max("again").alias("again"), F.sum(size).alias("mark_bytes")
    )
    shared = written(shared.where("n > 1 OR again > 0").select("mark", "mark_bytes"), "shared")
    total = shared.agg(F.sum("mark_bytes")).first()[0] or 0

    # Every segment of a shared mark is cut out of one text that has it.
    wanted = F.collect_list(F.struct("mark", "digest", "places", "mark_bytes", "at.start", "at.size")).alias("wanted")
    asked = distinct.join(shared, "mark").groupBy("at.k1", "at.k2", "at.who").agg(wanted)
    contents = written(
        long_rows.join(asked, ["k1", "k2", "who"])
        .mapInArrow(_cut_out, _CONTENT)
        # Rows that are alike in id and text have been cut each.
        .groupBy("mark", "digest")
        .agg(*[F.first(c).alias(c) for c in ("places", "mark_bytes", "content")]),
        "contents",
    )
    hot = F.col("mark_bytes") > bucket // 2
    number = F.pmod(F.xxhash64("mark"), F.lit(max(1, math.ceil(total / bucket)))).alias("bucket")
    searched = (
        contents.where(~hot).select("mark", "digest", "places", "content", number).groupBy("bucket").applyInArrow(_searched, _FOUND)
    )
    counted = _counted_windows(contents.where(hot).select("mark", "digest", "places", "content"), written)
    found = written(searched.where("size(low) > 0").unionByName(counted), "found")

    there = placed.select("k1", "k2", "start", "mark", "digest")
    begin, end = F.transform("low", lambda x: x + F.col("start")), F.transform("high", lambda x: x + F.col("start"))
    spans = (
        there.join(found, ["mark", "digest"])
        .select("k1", "k2", F.arrays_zip(begin.alias("low"), end.alias("high")).alias("spans"))
        .groupBy("k1", "k2")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )
    spans = written(spans, "spans")
    return rows.select("doc_id", "text", "k1", "k2").join(spans, ["k1", "k2"], "left").select(
        "doc_id", "text", "spans.low", "spans.high"
    ).mapInArrow(_removed, SCHEMA)


_CONTENT = "mark long, digest long, places long, mark_bytes long, content binary"


def _cut_out(batches):
    for batch in batches:
        columns: list[list] = [[], [], [], [], []]
        for whole, wanted in zip(batch["text"], batch["wanted"].to_pylist(), strict=True):
            text = whole.as_buffer().to_pybytes()
            for s in wanted:
                content = text[s["start"] : s["start"] + s["size"] + LENGTH - 1]
                for column, value in zip(columns, (*list(s.values())[:4], content), strict=True):
                    column.append(value)
        names = [c.split()[0] for c in _CONTENT.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64() if i < 4 else pa.binary()) for i, c in enumerate(columns)], names=names
        )


def cut(text: bytes, low: list[int], high: list[int]) -> tuple[bytes, int, int]:
    """What remains when all windows that start in the stretches are taken out, bytes gone, and spans."""
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, np.array(high) + LENGTH, -1)
    gone = np.cumsum(change[:-1]) > 0
    spans = np.count_nonzero(gone[1:] & ~gone[:-1]) + int(gone[:1].any())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), int(spans)


def _removed(batches):
    for batch in batches:
        columns: list[list] = [[], [], [], []]
        for whole, low, high in zip(batch["text"], batch["low"].to_pylist(), batch["high"].to_pylist(), strict=True):
            text = whole.as_buffer().to_pybytes()
            kept, gone, spans = cut(text, low, high) if low else (text, 0, 0)
            for column, value in zip(columns, (len(text), gone, spans, kept), strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )
