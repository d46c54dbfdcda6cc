"""Stupid-backoff language-model scores of documents, from counts over all documents.

n-grams of every order up to `ORDER` are hashed. Texts are dealt to chunks; a chunk's
distinct n-grams and counts go to the hash ranges of the count table, where they are added
up, and the count of every n-gram comes back to the chunks that hold it (`chunks`). There
each n-gram of a document is joined with its count, and the scores are summed per document.

A document's own counts are taken out before it is scored, so text that stands nowhere
else backs off: the score of a word is the count of the longest n-gram that other
documents hold, over the count of its context, times `BACKOFF` for every order given up.
A word that no other document holds scores as half an occurrence.

Rows: null and empty texts have no words, a score of 0 and no mean. Repeated rows are
documents of their own. Only the id and the text columns are read; words are cut at ASCII
white space and taken unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codonmill.llm import chunks

ORDER = 3
BACKOFF = 0.4
#: Larger chunks hold fewer distinct n-grams for their size.
CHUNK_BYTES = 8 * 1024 * 1024
#: The key under which chunks send their number of words.
ALL_WORDS = np.uint64(0)

SCHEMA = "doc_id long, n_words long, n_backed_off long, log10_score double, mean_log10 double"


def ngrams(text: bytes, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams of each order from 1, by the place of their first word."""
    hashes = chunks.word_hashes(text.split())
    return [chunks.run_hashes(hashes, n) for n in range(1, order + 1)]


def own_counts(places: np.ndarray) -> np.ndarray:
    """How often each number occurs in the array, for every entry.

    The number and its entry share one integer, so that sorting needs no indirection.
    """
    n = len(places)
    bits = max(1, n.bit_length())
    ordered = np.sort((places << bits) | np.arange(n))
    values = ordered >> bits
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if n else places
    sizes = np.diff(np.append(first, n))
    counts = np.empty(n, np.int64)
    counts[ordered & ((1 << bits) - 1)] = np.repeat(sizes, sizes)
    return counts


def word_scores(grams: list[np.ndarray], others: list[np.ndarray], n_words: int, backoff: float):
    """log10 of each word's score and the number of orders it gave up.

    `others` has for each n-gram how often other documents hold it.
    """
    n = len(grams[0])
    seen = others[0].astype(float)
    score = np.where(seen > 0, seen, 0.5) / max(n_words, 1)
    given_up = np.zeros(n, np.int64)
    for order in range(2, len(grams) + 1):
        if n < order:
            break
        # The n-gram of this order that ends at a word starts order - 1 words before it.
        count = others[order - 1].astype(float)
        context = others[order - 2][: len(count)].astype(float)
        at = np.arange(order - 1, n)
        held = count > 0
        score[at] = np.where(held, count / np.maximum(context, 1), backoff * score[at])
        given_up[at] = np.where(held, 0, given_up[at] + 1)
    return np.log10(score), given_up


def score_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, backoff: float = BACKOFF
) -> DataFrame:
    """One row per row of `docs`, see SCHEMA; logarithms are to base 10."""
    total = chunks.text_bytes(docs, text)

    def small(batches):
        """Texts compressed one by one, as all of them are shuffled once."""
        coder = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            coded = [coder.compress(t) for t in batch["text"].to_pylist()]
            yield batch.set_column(1, "text", pa.array(coded, pa.binary()))

    def texts_of(table: pa.Table) -> list[bytes]:
        coder = zstandard.ZstdDecompressor()
        return [coder.decompress(t) for t in table["text"].to_pylist()]

    def keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        every, n_words = [], 0
        for text_ in texts_of(table):
            grams = ngrams(text_, order)
            n_words += len(grams[0])
            every += grams
        found, counts = np.unique(np.concatenate([*every, np.empty(0, np.uint64)]), return_counts=True)
        return np.insert(found, 0, ALL_WORDS), np.insert(counts, 0, n_words)

    def use(table: pa.Table, totals: np.ndarray) -> pa.Table:
        every = [ngrams(text_, order) for text_ in texts_of(table)]
        together = np.concatenate([*[g for grams in every for g in grams], np.empty(0, np.uint64)])
        # The place of each n-gram among the keys, whose first is that of all words.
        _, place = np.unique(together, return_inverse=True)
        sums, rows, at = totals[1:].astype(np.int64), [], 0
        for grams in every:
            n, others = len(grams[0]), []
            for own in grams:
                here = place[at : at + len(own)]
                at += len(own)
                others.append(sums[here] - own_counts(here))
            logs, given_up = word_scores(grams, others, int(totals[0]) - n, backoff)
            whole = float(logs.sum())
            rows.append((n, int((given_up > 0).sum()), whole, whole / n if n else None))
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        names = ["doc_id", "n_words", "n_backed_off", "log10_score", "mean_log10"]
        return pa.table([table["doc_id"].combine_chunks(), *columns], names=names)

    whole = F.coalesce(F.col(text), F.lit(""))
    chunked = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        whole.cast("binary").alias("text"),
        chunks.dealt(
            F.xxhash64(F.col(doc_id), whole), chunks.parts(total, CHUNK_BYTES)
        ).alias("chunk"),
    ).mapInArrow(small, "doc_id long, text binary, chunk int")
    return chunks.corpus_totals(
        chunked, keys, use, SCHEMA, chunks.parts(total * order, chunks.RANGE_BYTES)
    )
