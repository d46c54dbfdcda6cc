"""Counts of hashed keys over a whole corpus, brought back to the texts that hold them.

Texts are dealt to chunks of bounded size by a hash. Each chunk sends its distinct keys
and their counts to the ranges of the key space they fall into; each range adds up the
counts and answers every chunk with one total per key it sent. A key that stands in a
third of all texts is one entry per chunk, so no key is hot. Both directions are packed
arrays: keys as differences of sorted numbers, byte plane by byte plane.

Chunks are a function of the rows, never of the task that reads them, so a lost
executor's tasks give the same chunks when they run again.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 4 * 1024 * 1024
RANGE_BYTES = 8 * 1024 * 1024

_STEP = np.uint64(0x9E3779B97F4A7C15)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def parts(total: int, size: int) -> int:
    return max(1, math.ceil(total / size))


def dealt(key: Column, n_chunks: int) -> Column:
    """Chunk number of a row by the hash of `key`."""
    return F.pmod(F.xxhash64(F.lit("chunk"), key), F.lit(n_chunks)).cast("int")


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of the splitmix generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of `width` neighbours; runs of unlike widths differ."""
    n = len(hashes) - width + 1
    if n <= 0:
        return hashes[:0]
    total = np.full(n, width, np.uint64)
    for j in range(width):
        total = total * _STEP + hashes[j : j + n]
    return mixed(total)


def packed(numbers: np.ndarray) -> bytes:
    """64-bit numbers as bytes, each of the eight byte planes compressed by itself.

    Planes of random bytes stay as they are; those of small or rare values shrink.
    """
    planes = np.ascontiguousarray(numbers.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    coder = zstandard.ZstdCompressor(level=1)
    coded = [coder.compress(plane.tobytes()) for plane in planes]
    return np.array([len(c) for c in coded], "<u4").tobytes() + b"".join(coded)


def unpacked(data: bytes) -> np.ndarray:
    ends = np.cumsum(np.frombuffer(data, "<u4", 8)) + 32
    coder = zstandard.ZstdDecompressor()
    planes = [coder.decompress(data[a:b]) for a, b in zip([32, *ends], ends, strict=False)]
    together = np.frombuffer(b"".join(planes), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(together.T).view(np.uint64).reshape(-1)


def corpus_totals(
    chunked: DataFrame,
    keys: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]],
    use: Callable[[pa.Table, np.ndarray], pa.Table],
    schema: str,
    n_ranges: int,
) -> DataFrame:
    """`use` of every chunk of `chunked` (column `chunk`), given its keys' totals.

    `keys` gives a chunk's distinct keys in ascending order and their counts, and must
    depend on the set of its rows alone. `use` gets the rows and the sums of the counts of
    these keys over all chunks, in the same order; what it derives from the texts it derives
    once, for the keys and for what it makes of them.
    """
    edges = np.array([(i << 64) // n_ranges for i in range(1, n_ranges)], np.uint64)

    def ask(table: pa.Table) -> pa.Table:
        found, counts = keys(table)
        cuts = [0, *np.searchsorted(found, edges), len(found)]
        spans = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        return pa.table(
            {
                "chunk": pa.array([table["chunk"][0].as_py()] * len(spans), pa.int32()),
                "range": pa.array([i for i, _, _ in spans], pa.int32()),
                "keys": pa.array(
                    [packed(np.diff(found[a:b], prepend=np.uint64(0))) for _, a, b in spans], pa.binary()
                ),
                "counts": pa.array([packed(counts[a:b]) for _, a, b in spans], pa.binary()),
            }
        )

    def answer(table: pa.Table) -> pa.Table:
        found = [np.cumsum(unpacked(x.as_py()), dtype=np.uint64) for x in table["keys"]]
        counts = np.concatenate([unpacked(x.as_py()) for x in table["counts"]])
        cuts = np.cumsum([len(x) for x in found])[:-1]
        together = np.concatenate(found)
        order = np.argsort(together, kind="stable")
        ordered = together[order]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        sums = np.add.reduceat(counts[order], first)
        totals = np.empty(len(together), np.uint64)
        totals[order] = np.repeat(sums, np.diff(np.append(first, len(ordered))))
        return pa.table(
            {
                "chunk": table["chunk"],
                "range": table["range"],
                "totals": pa.array([packed(x) for x in np.split(totals, cuts)], pa.binary()),
            }
        )

    def finish(rows: pa.Table, answers: pa.Table) -> pa.Table:
        in_order = answers.sort_by("range")["totals"]
        return use(rows, np.concatenate([np.empty(0, np.uint64), *[unpacked(x.as_py()) for x in in_order]]))

    asked = chunked.groupBy("chunk").applyInArrow(ask, "chunk int, range int, keys binary, counts binary")
    answered = asked.groupBy("range").applyInArrow(answer, "chunk int, range int, totals binary")
    return chunked.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(finish, schema)
