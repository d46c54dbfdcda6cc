"""Repeated long spans by compaction of a De Bruijn graph of token windows.

An edge of the graph is a window of `WIDTH` consecutive words, from its first words to
its last. A document is a walk over edges. Instead of writing down every edge, the walk
is cut into paths: consecutive edges that select the same anchor, the smallest hash of
`ANCHOR` words inside the window (as genome assemblers cut reads by minimisers). Equal
windows select the same anchor, so equal edges always lie in paths of one anchor, and a
path is one row in place of some twenty edges.

1. Occurrences of paths: anchor, 128-bit digest of the words, source coordinates.
2. A join with what is known of each anchor keeps those in several documents, and compacts
   what does not branch: if all paths of an anchor have one digest, the path is decided as
   a whole, by the first document that holds it.
3. Paths of the other anchors are looked up at the source coordinates of their first
   occurrence, opened into edges, and each edge gets the first document that holds it; a
   join brings that back to every occurrence of the path.
4. Spans that go on at the same distance from their source are merged to runs, and every
   run is verified: its words, read at its own and at its source's coordinates, must have
   one SHA-256. Words are compared by it and not carried from document to document, as a
   passage would travel once per copy. If a single run fails, all is done again with other
   hashes, so what is cut never rests on the digests of 1 to 3 alone.
5. The runs (document, from, to) are cut out of the whole text.

Digests are two independent 64-bit sums over two independent halves of 128-bit word
hashes. Equal windows always have equal digests, and the first document is the smallest
that has the digest; so unlike windows of one digest either change nothing or fail in 4. Anchors and paths in very many documents are aggregated before they are shuffled;
the joins have one row per path on one side, so a hot path's partition can be split.

Rows: null, empty and short texts have no windows and lose nothing. A row without a
doc_id counts as later than all others. Repeated rows (one doc_id) do not count as earlier
than each other. All words of a text are looked at, whatever its length; only the id and
the text columns are read.
"""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codonmill.llm import chunks
from codonmill.session import shared_folder

WIDTH = 50
ANCHOR = 16
LAST_ID = 2**63 - 1
TRIES = 8

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


@cache
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    up = np.full(size, base, np.uint64)
    down = np.full(size, pow(base, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Words:
    """The words of a text with digests of any run of them."""

    def __init__(self, text: bytes, seed: int = 0, bits: int = 64):
        self.words = text.split()
        self.mask = np.uint64(2**bits - 1)
        joined = b"".join(map(xxhash.xxh3_128_digest, self.words, repeat(seed)))
        halves = np.frombuffer(joined, ">u8").astype(np.uint64).reshape(-1, 2)
        self.hashes = np.ascontiguousarray(halves[:, 0])
        size = 1 << max(10, len(self.words).bit_length())
        self.sums = []
        for base, half in zip(_BASES, (self.hashes, halves[:, 1]), strict=True):
            up, down = _powers(base, size)
            total = np.zeros(len(self.words) + 1, np.uint64)
            np.cumsum(half * up[: len(half)], out=total[1:], dtype=np.uint64)
            self.sums.append((total, down))

    def digests(self, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        """Two 64-bit numbers for each run of words [start, end)."""
        length = (end - start).astype(np.uint64)
        return [
            chunks.mixed((total[end] - total[start]) * down[start] + length) & self.mask
            for total, down in self.sums
        ]

    def paths(self, width: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, number of windows and anchor hash of every path."""
        n_windows = len(self.words) - width + 1
        if n_windows <= 0:
            none = np.empty(0, np.int64)
            return none, none, np.empty(0, np.uint64)
        hashed = chunks.run_hashes(self.hashes, anchor)
        views = np.lib.stride_tricks.sliding_window_view(hashed, width - anchor + 1)
        chosen = views.argmin(axis=1) + np.arange(n_windows)
        start = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        return start, np.diff(np.append(start, n_windows)), hashed[chosen[start]]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, sum, text): rows without an id come last; `sum` tells rows of one id apart."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(whole).alias("sum"),
        whole.cast("binary").alias("text"),
    )


def repeated_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    anchor: int = ANCHOR,
    bits: int = 64,
) -> DataFrame:
    """(id, sum, start, n, first_id, first_sum, first_start): runs of words that an earlier document has.

    The n words from `start` are those of document `first_id` from `first_start`, verified
    there; that is the first document that holds the run's windows. `sum` tells texts of one
    id apart. Runs may overlap. `bits` is the length of each of the two digests in the first
    try; every further try, should one fail, has twice as many up to 64, and other hashes.
    """
    return _verified(_keyed(docs, doc_id, text), width, anchor, bits)[0]


def _verified(keyed: DataFrame, width: int, anchor: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Runs that hold what their sources hold, and the texts cut by them (`_cut`)."""
    spark = keyed.sparkSession
    for seed in range(TRIES):
        folder = shared_folder(spark)
        spans = _likely_spans(keyed, width, anchor, seed, min(64, bits << seed))
        of_text = spans.groupBy("id", "sum").agg(F.collect_set(F.struct(*_SPAN)).alias("spans"))
        of_text.mapInArrow(_merge, f"id long, sum long, {_RUN}").write.parquet(f"{folder}/runs")
        runs = spark.read.parquet(f"{folder}/runs")
        _cut(keyed, runs).write.option("compression", "zstd").parquet(f"{folder}/cut")
        cut = spark.read.parquet(f"{folder}/cut")
        if not _unlike(cut, runs).count():
            return runs, cut
    raise RuntimeError(f"words at the two places of a run differed in {TRIES} tries with unlike hashes")


_SPAN = ["start", "end", "first_id", "first_sum", "first_start"]
_RUN = "start int, n int, first_id long, first_sum long, first_start int"


def _merge(batches):
    """The spans of each row merged where they meet and have one distance from one source."""
    for batch in batches:
        keys = [name for name in batch.schema.names if name != "spans"]
        column = batch["spans"]
        offsets = column.offsets.to_numpy()
        fields = [column.values.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in _SPAN]
        rows = []
        for at in range(batch.num_rows):
            start, end, first_id, first_sum, first_start = (f[offsets[at] : offsets[at + 1]] for f in fields)
            apart = first_start - start
            order = np.lexsort((start, apart, first_sum, first_id))
            start, end, first_id, first_sum, apart = (f[order] for f in (start, end, first_id, first_sum, apart))
            new = np.ones(len(start), bool)
            new[1:] = (np.diff(first_id) != 0) | (np.diff(first_sum) != 0) | (np.diff(apart) != 0)
            # How far the spans up to each reach, begun anew for every source and distance.
            lift = np.cumsum(new) * (int(end.max()) + 1)
            reach = np.maximum.accumulate(end + lift) - lift
            new[1:] |= start[1:] > reach[:-1]
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(start)) - 1
            begun = start[begin]
            run = (begun, reach[last] - begun, first_id[begin], first_sum[begin], begun + apart[begin])
            rows.append((np.full(len(begin), at), *run))
        if rows:
            at, start, n, first_id, first_sum, first_start = map(np.concatenate, zip(*rows, strict=True))
            yield pa.RecordBatch.from_pydict(
                {
                    **{name: batch[name].take(pa.array(at)) for name in keys},
                    "start": start.astype(np.int32),
                    "n": n.astype(np.int32),
                    "first_id": first_id,
                    "first_sum": first_sum,
                    "first_start": first_start.astype(np.int32),
                }
            )


_PLACE = ["id", "sum", "start", "n"]
_SOURCE = ["first_id", "first_sum", "first_start", "n"]


def _cut(keyed: DataFrame, runs: DataFrame) -> DataFrame:
    """(id, sum, n_words, n_removed, kept, places) of each text, in one pass over all.

    `places` are the runs of the text and those of other texts that have it for their
    source, each with the SHA-256 of its words. A place is there once, however many runs
    refer to it: places are made distinct within tasks before they are brought to the texts.
    """
    own = runs.select(*_PLACE, F.lit(True).alias("cut"))
    source = runs.select(*_SOURCE).toDF(*_PLACE).withColumn("cut", F.lit(False))
    wanted = own.unionByName(source).groupBy("id", "sum").agg(
        F.collect_set(F.struct("start", "n", "cut")).alias("places")
    )

    def cut(batches):
        for batch in batches:
            kept, n_words, n_removed, places = [], [], [], []
            for text, places_ in zip(batch["text"].to_pylist(), batch["places"].to_pylist(), strict=True):
                words = text.split()
                depth = np.zeros(len(words) + 1, np.int64)
                digests = []
                for place in places_ or ():
                    start, end = place["start"], place["start"] + place["n"]
                    digest = hashlib.sha256(b" ".join(words[start:end])).digest()
                    digests.append({"start": start, "n": place["n"], "digest": digest})
                    if place["cut"]:
                        # A run that its digests got wrong may reach beyond the text.
                        depth[min(start, len(words))] += 1
                        depth[min(end, len(words))] -= 1
                gone = np.cumsum(depth[:-1]) > 0
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]))
                places.append(digests)
            digested = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("digest", pa.binary())]))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch["id"],
                    "sum": batch["sum"],
                    "n_words": pa.array(n_words, pa.int64()),
                    "n_removed": pa.array(n_removed, pa.int64()),
                    "kept": pa.array(kept, pa.binary()),
                    "places": pa.array(places, digested),
                }
            )

    return keyed.join(wanted, ["id", "sum"], "left").mapInArrow(
        cut,
        "id long, sum long, n_words long, n_removed long, kept binary,"
        " places array<struct<start: int, n: int, digest: binary>>",
    )


def _unlike(cut: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs whose words are not those at the source's coordinates.

    Digests are joined to the runs by place, one row per place on that side.
    """
    # Repeated rows have one text.
    places = cut.select("id", "sum", F.inline("places")).distinct()
    there = places.toDF(*_SOURCE, "first_digest")
    return runs.join(places, _PLACE, "left").join(there, _SOURCE, "left").where(
        ~F.col("digest").eqNullSafe(F.col("first_digest")) | F.col("digest").isNull()
    )


def _likely_spans(keyed: DataFrame, width: int, anchor: int, seed: int, bits: int) -> DataFrame:
    """(id, sum, start, end, first_id, first_sum, first_start): spans whose digests an earlier document has."""
    spark = keyed.sparkSession
    folder = shared_folder(spark)

    def walk(batches):
        for batch in batches:
            rows = []
            for at, text_ in enumerate(batch["text"].to_pylist()):
                words = Words(text_, seed, bits)
                start, n_windows, hashed = words.paths(width, anchor)
                high, low = words.digests(start, start + n_windows + width - 1)
                rows.append((np.full(len(start), at), start, n_windows, hashed, high, low))
            if rows:
                at, start, n_windows, hashed, high, low = map(np.concatenate, zip(*rows, strict=True))
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": hashed.view(np.int64),
                        "high": high.view(np.int64),
                        "low": low.view(np.int64),
                        "id": batch["id"].take(pa.array(at)),
                        "sum": batch["sum"].take(pa.array(at)),
                        "start": start.astype(np.int32),
                        "n_windows": n_windows.astype(np.int32),
                    }
                )

    schema = "anchor long, high long, low long, id long, sum long, start int, n_windows int"
    keyed.mapInArrow(walk, schema).write.parquet(f"{folder}/walks")
    walks = spark.read.parquet(f"{folder}/walks")

    ends = [f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("id", "high", "low")]
    anchors = (
        walks.groupBy("anchor")
        .agg(*ends, *_of_first("start"))
        .where("min_id < max_id")
        .selectExpr(
            "anchor",
            "min_id AS first_id",
            "first_sum",
            "first_start",
            "min_high = max_high AND min_low = max_low AS straight",
        )
    )
    # Read again, so that the join deals out both sides itself and can split a hot anchor.
    anchors.write.parquet(f"{folder}/anchors")
    anchors = spark.read.parquet(f"{folder}/anchors")
    walks.join(anchors, "anchor").drop("anchor").write.parquet(f"{folder}/shared")
    shared = spark.read.parquet(f"{folder}/shared")

    first = ["first_id", "first_sum", "first_start"]
    straight = shared.where("straight").select(
        "id", "sum", "start", (F.col("start") + F.col("n_windows") + width - 1).alias("end"), *first
    )
    branching = shared.where("NOT straight").select("high", "low", "id", "sum", "start", "n_windows")
    opened = (
        branching.join(_opened(keyed, branching, width, seed, bits), ["high", "low"])
        .select(
            "id",
            "sum",
            (F.col("start") + F.col("offset")).alias("start"),
            (F.col("start") + F.col("offset") + F.col("n")).alias("end"),
            *first,
        )
    )
    return straight.unionByName(opened).where("first_id < id")


def _of_first(start: str) -> list[Column]:
    """Text and place of the row with the smallest id; of several, one of them for both."""
    return [F.min_by("sum", "id").alias("first_sum"), F.min_by(start, "id").alias("first_start")]


def _opened(keyed: DataFrame, branching: DataFrame, width: int, seed: int, bits: int) -> DataFrame:
    """(high, low, offset, n, first_id, first_sum, first_start) of paths that share edges with others.

    Each edge of a path is held first by one document, text and place; edges of one path that
    go on at one distance from one source are one row.
    The words of each path are read again at the coordinates of its first occurrence.
    """
    path = ["high", "low"]
    firsts = branching.groupBy(*path).agg(F.min("id").alias("id"))
    where = (
        branching.join(firsts, [*path, "id"])
        .groupBy(*path, "id")
        .agg(F.min(F.struct("sum", "start", "n_windows")).alias("at"))
        .select(*path, "id", "at.*")
    )
    wanted = where.groupBy("id", "sum").agg(
        F.collect_list(F.struct(*path, "start", "n_windows")).alias("wanted")
    )
    # One text per id and sum; rows that agree in both have one text.
    sources = keyed.join(wanted, ["id", "sum"]).select("id", "sum", "text", "wanted")

    def edges(batches):
        for batch in batches:
            rows = []
            columns = (batch[c].to_pylist() for c in ("id", "sum", "text", "wanted"))
            for id_, sum_, text, wanted_ in zip(*columns, strict=True):
                words = Words(text, seed, bits)
                for one in wanted_:
                    offset = np.arange(one["n_windows"])
                    found = words.digests(one["start"] + offset, one["start"] + offset + width)
                    of_path = np.tile([[one["high"]], [one["low"]], [id_], [sum_]], len(offset))
                    rows.append((*found, offset, one["start"] + offset, of_path))
            if rows:
                high, low, offset, at = (np.concatenate([r[k] for r in rows]) for k in range(4))
                of_path = np.concatenate([r[4] for r in rows], axis=1)
                places = [offset.astype(np.int32), at.astype(np.int32)]
                columns = [high.view(np.int64), low.view(np.int64), *places, *of_path]
                names = ["edge_high", "edge_low", "offset", "at", "high", "low", "id", "sum"]
                yield pa.RecordBatch.from_pydict(dict(zip(names, columns, strict=True)))

    schema = "edge_high long, edge_low long, offset int, at int, high long, low long, id long, sum long"
    opened = sources.mapInArrow(edges, schema)
    first_of = opened.groupBy("edge_high", "edge_low").agg(F.min("id").alias("first_id"), *_of_first("at"))
    of_path = (
        opened.drop("id", "sum", "at")
        .join(first_of, ["edge_high", "edge_low"])
        .select(*path, F.col("offset").alias("start"), (F.col("offset") + width).alias("end"), *_SPAN[2:])
        .groupBy(*path)
        .agg(F.collect_set(F.struct(*_SPAN)).alias("spans"))
    )
    return of_path.mapInArrow(_merge, f"high long, low long, {_RUN}").withColumnRenamed("start", "offset")


def cut_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    anchor: int = ANCHOR,
    bits: int = 64,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text without its repeated words.

    Kept words are joined by one blank.
    """
    cut = _verified(_keyed(docs, doc_id, text), width, anchor, bits)[1]
    return cut.select(
        F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"),
        "n_words",
        "n_removed",
        F.col("kept").cast("string").alias("kept"),
    )
