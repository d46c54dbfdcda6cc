"""Exact Jaccard join of documents on word shingles, with token-combination prefixes.

Tokens are the hashed shingles of a document. All documents order tokens alike: those in
few documents first. If two sets reach the similarity, at most a known number of tokens
of one is missing in the other, so long enough prefixes share tokens. Documents with one
text are one representative from the start.

- Rare tokens (in at most `FREQUENT` representatives) are signatures by themselves. A
  token of one representative only cannot be shared and is not indexed.
- Frequent tokens are signatures in pairs, within one of `M` classes chosen by hash. Two
  sets that share no pair of a class share at most one token of it, so every class that a
  prefix touches costs one token more: prefixes are extended until rare tokens plus
  frequent tokens minus touched classes exceed the number that may be missing. Sets up to
  `SMALL` shingles use one class; larger ones use many, so that pairs stay few. Sets near
  the border use both, as a pair of similar sets may lie across it.

Within a signature, everyone is first compared with the smallest document; what this links
is one group, and after that only documents of different groups are compared. So a
group of n near copies costs n comparisons and not n squares, while every pair that could
join two groups is still verified on whole sets. Each set also has `BITS` parity bits: every
token flips one. Sets differ in at least as many tokens as their bits differ in places, an
exact bound (Sandes et al., "Bitmap Filter", 2017), which the join of a signature's rows
checks before it gives out a pair.

Rows: null texts and texts without words have no shingles and link with nothing. Rows
without a doc_id are returned with the component of the documents of the same text, or
null. Repeated rows are returned as often as they come. Only the id and the text columns
are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codonmill.llm import chunks
from codonmill.llm.components import components
from codonmill.session import shared_folder

FREQUENT = 64
SMALL = 200
M = 64
BITS = 512


def shingles(text: bytes, words_each: int = 5) -> np.ndarray:
    """Distinct shingles of a text as ascending hashes; a shorter text is one shingle."""
    words = text.lower().split()
    hashes = chunks.word_hashes(words)
    return np.unique(chunks.run_hashes(hashes, min(words_each, max(len(words), 1))))


def may_lack(n: int, percent: int) -> int:
    """How many of n tokens may be missing in a set at least `percent` % similar."""
    return n - (-(-percent * n // 100))


def signatures(tokens: np.ndarray, n_docs: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of one set, given in how many sets each of its tokens stands."""
    order = np.lexsort((tokens, n_docs))
    tokens, n_docs = tokens[order], n_docs[order]
    n, lack = len(tokens), may_lack(len(tokens), percent)
    n_rare = int(np.searchsorted(n_docs, FREQUENT, side="right"))
    if n == 1:  # similar to equal sets only
        return tokens[n_docs > 1]
    single = tokens[: min(n_rare, lack + 1)]
    found = [single[n_docs[: len(single)] > 1]]
    if n_rare <= lack:
        frequent = tokens[n_rare:]
        if n <= SMALL:
            found.append(_pairs(frequent, lack + 1 - n_rare, 1))
        if 100 * n > percent * SMALL:
            found.append(_pairs(frequent, lack + 1 - n_rare, M))
    return np.concatenate(found)


def _pairs(tokens: np.ndarray, needed: int, n_classes: int) -> np.ndarray:
    """Hashes of all pairs within a class, in the shortest prefix that covers `needed`."""
    kind = (tokens % np.uint64(n_classes)).astype(np.int64)
    new = np.zeros(len(tokens), bool)
    new[np.unique(kind, return_index=True)[1]] = True
    covered = np.cumsum(~new)
    length = min(int(np.searchsorted(covered, needed)) + 1, len(tokens))
    tokens, kind = tokens[:length], kind[:length]
    found = []
    for c in np.unique(kind):
        own = np.sort(tokens[kind == c])
        i, j = np.triu_indices(len(own), 1)
        found.append(chunks.mixed(chunks.mixed(own[i] + np.uint64(n_classes)) * np.uint64(3) + own[j]))
    return np.concatenate(found) if found else tokens[:0]


def parity_bits(tokens: np.ndarray) -> np.ndarray:
    """`BITS` bits as longs; each token flips the one its hash names."""
    flips = np.bincount((tokens % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def similar_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words_each: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row, see the module."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    whole = F.coalesce(F.col(text), F.lit(""))
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.unhex(F.md5(whole)).alias("digest"))
    first = (
        ids.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc"))
    )
    _sets(docs.select(F.unhex(F.md5(whole)).alias("digest"), whole.alias("text")), words_each, percent).join(
        first, "digest", "left"
    ).write.parquet(f"{folder}/sets")
    sets = spark.read.parquet(f"{folder}/sets")

    links = _links(sets, percent, folder)
    found = sets.select("digest", "n", "doc").join(
        components(links).withColumnRenamed("node", "doc"), "doc", "left"
    )
    return ids.join(found.select("digest", "n", "doc", "component"), "digest", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id"))
        .otherwise(F.coalesce("component", "doc"))
        .alias("component_id"),
    )


def _sets(texts: DataFrame, words_each: int, percent: int) -> DataFrame:
    """One row per distinct text: (digest, n, signatures, bits and members if it has signatures)."""
    total = chunks.text_bytes(texts)
    n_chunks = chunks.parts(total, chunks.CHUNK_BYTES)

    def once(batches):
        """Drop copies that this task has seen, so that copies meet in small numbers."""
        seen: set[bytes] = set()
        for batch in batches:
            new = []
            for i, digest in enumerate(batch["digest"].to_pylist()):
                if digest not in seen:
                    seen.add(digest)
                    new.append(i)
            yield batch.take(pa.array(new, pa.int64()))

    def distinct(table: pa.Table) -> dict[bytes, np.ndarray]:
        texts_of = dict(zip(table["digest"].to_pylist(), table["text"].to_pylist(), strict=True))
        return {d: shingles(texts_of[d], words_each) for d in sorted(texts_of)}

    def keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        all_tokens = np.concatenate([*distinct(table).values(), np.empty(0, np.uint64)])
        return np.unique(all_tokens, return_counts=True)

    def use(table: pa.Table, totals: np.ndarray) -> pa.Table:
        sets = distinct(table)
        found = np.unique(np.concatenate([*sets.values(), np.empty(0, np.uint64)]))
        signed = [signatures(s, totals[np.searchsorted(found, s)], percent) for s in sets.values()]
        return pa.table(
            {
                "digest": pa.array(sets, pa.binary()),
                "n": pa.array([len(s) for s in sets.values()], pa.int64()),
                "signatures": pa.array([x.view(np.int64) for x in signed], pa.list_(pa.int64())),
                "bits": pa.array(
                    [parity_bits(s) if len(x) else None for s, x in zip(sets.values(), signed, strict=True)],
                    pa.list_(pa.int64()),
                ),
                "members": pa.array(
                    [s.tobytes() if len(x) else None for s, x in zip(sets.values(), signed, strict=True)],
                    pa.binary(),
                ),
            }
        )

    binary = texts.select("digest", F.col("text").cast("binary").alias("text"))
    chunked = binary.mapInArrow(once, "digest binary, text binary").withColumn(
        "chunk", chunks.dealt(F.col("digest"), n_chunks)
    )
    return chunks.corpus_totals(
        chunked,
        keys,
        use,
        "digest binary, n long, signatures array<long>, bits array<long>, members binary",
        chunks.parts(total, chunks.RANGE_BYTES),
    )


def _links(sets: DataFrame, percent: int, folder: str) -> DataFrame:
    """Enough verified links (a, b) to connect what any link connects."""
    spark = sets.sparkSession
    signed = sets.where("doc IS NOT NULL").select("doc", "n", "bits", F.explode("signatures").alias("signature"))

    heads = (
        signed.groupBy("signature")
        .agg(F.min("doc").alias("head"), F.max("doc").alias("last"))
        .where("head < last")
        .drop("last")
    )
    stars = signed.join(heads, "signature").where("doc <> head").select("head", "doc").distinct()
    _verified(stars.toDF("a", "b"), sets, percent).write.parquet(f"{folder}/stars")
    links = spark.read.parquet(f"{folder}/stars")

    grouped = components(links).withColumnsRenamed({"node": "doc", "component": "part"})
    placed = signed.join(grouped, "doc", "left").withColumn("part", F.coalesce("part", "doc"))
    parted = (
        placed.groupBy("signature")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"))
        .where("low < high")
        .select("signature")
    )
    open_rows = placed.join(parted, "signature")
    one, two = open_rows.alias("one"), open_rows.alias("two")
    n_one, n_two = F.col("one.n"), F.col("two.n")
    differ = sum(
        (F.bit_count(F.col("one.bits")[i].bitwiseXOR(F.col("two.bits")[i])) for i in range(BITS // 64)), F.lit(0)
    )
    may_link = (
        (F.col("one.signature") == F.col("two.signature"))
        & (F.col("one.part") < F.col("two.part"))
        & (100 * n_one >= percent * n_two)
        & (100 * n_two >= percent * n_one)
        & ((100 + percent) * differ <= (100 - percent) * (n_one + n_two))
    )
    crossing = (
        one.join(two, may_link)
        .select(F.col("one.doc").alias("a"), F.col("two.doc").alias("b"))
        .distinct()
        .join(links, ["a", "b"], "left_anti")
    )
    return links.unionByName(_verified(crossing, sets, percent))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    own = sets.where("members IS NOT NULL").select("doc", "n", "members")

    def check(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch["x"], batch["y"], strict=True)):
                one, two = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * both >= percent * (len(one) + len(two) - both):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    with_a = pairs.join(own.toDF("a", "na", "x"), "a")
    with_b = with_a.join(own.toDF("b", "nb", "y"), "b").where(
        (100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na"))
    )
    return with_b.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")
