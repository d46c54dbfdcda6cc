"""Best-fit packing of tokenised documents, certified by lower bounds.

Documents become pieces of at most `CAPACITY` tokens. Pieces are dealt to groups by a
hash, and every group is packed by best-fit decreasing in one task. Dual feasible
functions bound from below how many sequences a group's pieces need at all; a group that
meets its bound is certified. Groups with a gap give up their sequences that are not
nearly full, certified groups only the emptiest one, and what was given up is dealt anew
and packed again. Rounds end when all that is left fits one group, or after `ROUNDS`.

A group holds `GROUP` pieces on average however large the input is; what a group gives up
shrinks from round to round, as full sequences stay where they are.

Rows: a null text is an empty one, which is its end token alone. Repeated rows are packed
as often as they come. Rows without a doc_id are packed like others. Long texts are
encoded in parts that end at white space, so a task holds one text and its ids, and words
of `SLICE` bytes at a time.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codonmill.llm import chunks
from codonmill.session import shared_folder

CAPACITY = 2048
END = 0
GROUP = 20_000
ROUNDS = 6
NEARLY_FULL = 0.99
CACHED_WORDS = 250_000
SLICE = 1 << 20
WORD_END = "</w>"
_SPACE = re.compile(rb"\s")
#: Of ASCII, what the tokenizer takes together; not the apostrophe, which may begin a token with letters.
_TAIL = string.punctuation.replace("'", "").encode()

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def parts(text: bytes) -> Iterator[bytes]:
    """The text in parts of about `SLICE` bytes, cut where white space is."""
    at = 0
    while len(text) - at > SLICE:
        space = _SPACE.search(text, at + SLICE)
        if space is None:
            break
        yield text[at : space.start()]
        at = space.start()
    yield text[at:]


def before_tail(word: bytes) -> bytes | None:
    """What stands before the punctuation that a word ends with, if that is tokenised apart.

    It is after a Latin letter, unless the punctuation belongs to a special token.
    """
    stem = word.rstrip(_TAIL)
    if not stem or stem == word or b"<|" in word:
        return None
    last = stem.decode()[-1]
    return stem if last.isalpha() and last < "\u0250" else None


class Encoder:
    """Token ids of whole texts as bytes (unsigned little-endian 32-bit numbers).

    The tokenizer ignores case, treats white space as a border and drops it, so a text's
    ids are those of its blank-separated parts in lower case. Punctuation after a Latin
    letter at a part's end is tokenised apart. Parts without it are encoded once and
    kept while they fit the cache; a full cache keeps what the present texts need.
    Special tokens keep their case, as it counts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, at in self.tokenizer.get_vocab().items():
            self.ends_word[at] = token.endswith(WORD_END)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text, of about `SLICE` bytes of them at a time."""
        done: list[list[bytes]] = [[] for _ in texts]
        held, size = [], 0
        for at, text in enumerate(texts):
            lowered = text if b"<|" in text else text.lower()
            for part in parts(lowered):
                held.append((at, part))
                size += len(part)
                if size >= SLICE:
                    self._encode(held, done)
                    held, size = [], 0
        self._encode(held, done)
        return [b"".join(ids) for ids in done]

    def _encode(self, held: list[tuple[int, bytes]], done: list[list[bytes]]) -> None:
        split = pc.ascii_split_whitespace(pa.array([part for _, part in held], pa.large_binary()).view(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        # Python sees each word of the slice once; the ids of all its places are laid by Arrow.
        used = coded.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, used))
        if len(self.known) > CACHED_WORDS:
            self.known = {w: ids for w, ids in zip(used, found, strict=True) if ids is not None}
        missing = [at for at, ids in enumerate(found) if ids is None]
        new = {used[at] for at in missing}
        tails = {w: stem for w in new if not w.isalpha() and (stem := before_tail(w))}
        self._learn((new - tails.keys()).union(tails.values(), [w[len(stem) :] for w, stem in tails.items()]))
        self.known.update((w, self.known[stem] + self.known[w[len(stem) :]]) for w, stem in tails.items())
        for at in missing:
            found[at] = self.known[used[at]]
        laid = pa.array(found, pa.large_binary()).take(coded.indices)
        ends = np.append(0, np.frombuffer(laid.buffers()[1], np.int64)[1 : len(laid) + 1])[split.offsets.to_numpy()].tolist()
        ids = memoryview(laid.buffers()[2] or b"")
        for (at, _), low, high in zip(held, ends, ends[1:], strict=False):
            done[at].append(bytes(ids[low:high]))

    def _learn(self, words: set[bytes]) -> None:
        """Encode words not yet known, those of letters alone many at a time.

        A word of letters is one part to the tokenizer, and its last token, no other, ends
        a word; so the ids of many of them can be told apart.
        """
        unknown = words.difference(self.known)
        plain = [w for w in unknown if w.isalpha() or not w.isascii() and w.decode().isalpha()]
        for at in range(0, len(plain), 1000):
            some = plain[at : at + 1000]
            ids = np.array(self._ids([b" ".join(some).decode()])[0], "<u4")
            cuts = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            if len(cuts) == len(some):
                # Sliced without a Python step per word, as most words come once.
                self.known.update(zip(some, map(ids.tobytes().__getitem__, map(slice, [0, *cuts], cuts)), strict=True))
        rest = list(unknown.difference(self.known))
        coded = self._ids([w.decode() for w in rest])
        self.known.update((w, np.array(ids, "<u4").tobytes()) for w, ids in zip(rest, coded, strict=True))

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@cache
def encoder(path: str) -> Encoder:
    """One per Python worker, which runs many tasks and keeps what it has encoded."""
    return Encoder(path)


def pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, on request, ids.

    `ids` holds unsigned little-endian 32-bit numbers, the end token included.
    """
    path = tokenizer or default_tokenizer()
    end = np.array([END], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches):
        coder = encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                rows = []
                for id_, coded in zip(batch["doc_id"].to_pylist(), coder.encode(batch["text"].to_pylist()), strict=True):
                    ids = coded + end
                    for piece, start in enumerate(range(0, len(ids), step)):
                        part = ids[start : start + step]
                        rows.append((id_, piece, start // 4, len(part) // 4, zlib.crc32(part), part))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                n = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays(columns[:n], names[:n])

    given = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    return given.mapInArrow(cut, PIECE + (", ids binary" if with_ids else ""))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing of these lengths needs, by dual feasible functions.

    Such a function maps lengths so that no set that fits one sequence maps to more than
    1; the sum over all lengths is then a bound. Used are the threshold functions, which
    round large lengths up and small ones down, and the rounding functions of step k.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    for least in range(1, capacity // 2 + 1):
        large = int(count[capacity - least + 1 :].sum())
        middle = int((count * size)[least : capacity - least + 1].sum())
        best = max(best, large + -(-middle // capacity))
    for k in range(1, 21):
        scaled = (k + 1) * size
        exact = scaled % capacity == 0
        value = np.where(exact, k * size, scaled // capacity * capacity)  # in units of 1 / (k capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Sequence number of each length, by best-fit decreasing.

    Open sequences are stacked by the room they have left; a bit mask of the rooms in use
    gives the smallest that is large enough at once.
    """
    number = np.empty(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, n = 0, 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[at])
        fitting = used >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            one = rooms[room].pop()
            if not rooms[room]:
                used ^= 1 << room
        else:
            room, one, n = capacity, n, n + 1
        left = room - length
        rooms[left].append(one)
        used |= 1 << left
        number[at] = one
    return number


def pack(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """`rows` of pieces (column `length`) with sequence_id and offset."""
    spark = rows.sparkSession
    folder = shared_folder(spark)
    names = rows.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    packed_schema = f"{fields}, _seed long, sequence_id long, offset long, _open boolean"

    def one_round(number: int):
        def run(table: pa.Table) -> pa.Table:
            keys = [(k, "ascending") for k in ("length", "_seed", *[n for n in names if n not in ("length", "ids")])]
            table = table.sort_by(keys)
            lengths = table["length"].to_numpy()
            bins = best_fit(lengths, capacity)
            fill = np.bincount(bins, weights=lengths).astype(np.int64)
            gap = len(fill) - lower_bound(lengths, capacity)
            is_open = (fill < NEARLY_FULL * capacity) if gap > 0 else np.zeros(len(fill), bool)
            is_open[np.argmin(fill)] = fill.min() < capacity
            order = np.argsort(bins, kind="stable")
            before = np.cumsum(lengths[order]) - lengths[order]
            first = np.flatnonzero(np.concatenate(([True], np.diff(bins[order]) > 0)))
            offset = np.empty(len(bins), np.int64)
            offset[order] = before - np.repeat(before[first], np.diff(np.append(first, len(bins))))
            own = table["_group"][0].as_py()
            return (
                table.drop_columns(["_group"])
                .append_column("sequence_id", pa.array((number << 56) + (own << 28) + bins))
                .append_column("offset", pa.array(offset))
                .append_column("_open", pa.array(is_open[bins]))
            )

        return run

    seed = F.xxhash64(*[F.col(n) for n in names if n != "ids"])
    pool = rows.withColumn("_seed", seed)
    closed: list[DataFrame] = []
    n_pool = rows.count()
    for number in range(ROUNDS):
        n_groups = chunks.parts(n_pool, group)
        dealt = pool.withColumn(
            "_group", F.pmod(F.xxhash64(F.lit(number), "_seed"), F.lit(n_groups)).cast("int")
        )
        path = f"{folder}/round-{number}"
        dealt.groupBy("_group").applyInArrow(one_round(number), packed_schema).write.parquet(path)
        now = spark.read.parquet(path)
        n_open = now.where("_open").count()
        if n_groups == 1 or number == ROUNDS - 1 or not n_open:
            closed.append(now)
            break
        closed.append(now.where("NOT _open"))
        pool = now.where("_open").select(*names, "_seed")
        n_pool = n_open
    result = closed[0]
    for more in closed[1:]:
        result = result.unionByName(more)
    return result.drop("_seed", "_open")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: sequence_id and offset; on request with ids.

    Packing moves lengths only. The ids stay where they were written and are joined to
    their places once, by the number of the written row.
    """
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/pieces"
    cut = pieces(docs, tokenizer=tokenizer, with_ids=with_ids)
    if not with_ids:
        cut.write.parquet(path)
        return pack(spark.read.parquet(path))
    cut.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    cut = spark.read.parquet(path)
    return pack(cut.drop("ids")).join(cut.select("_row", "ids"), "_row").drop("_row")


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the ids of each sequence's pieces, laid by offset.

    A sequence has as many pieces as tokens at most, so a group is bounded by its capacity.
    """
    laid = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(laid, F.lit(b""), lambda so_far, piece: F.concat(so_far, piece["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), ids.alias("ids"))
