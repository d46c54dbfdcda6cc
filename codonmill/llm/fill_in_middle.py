"""Fill-in-the-middle texts by block rotation within one buffer.

A text is scanned once for the ends of its units (a word with the white space before it,
or white space at the end). Two cuts drawn from a hash of the id part it into prefix,
middle and suffix. The three sentinels are inserted into a bytearray of the text, and the
order of the blocks is changed in place: two neighbouring blocks change places when each
of them and then both together are reversed. `restore` finds the sentinels of an output,
rotates back, and takes them out, which gives the text exactly.

The work is a narrow pass over the rows: no shuffle, and one text in a buffer at a time.

Rows: null texts are empty ones; empty texts, and texts that hold a sentinel themselves,
stay plain. A null id is drawn as an id without digits. Texts of any length are cut whole.
Repeated rows are cut alike. Only the id and the text column are read, so other columns
may have any names. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
#: Of 100 texts, so many are changed, and of 100 changed ones so many begin with the suffix.
CHANGED, SUFFIX_FIRST = 50, 80

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def unit_ends(text: np.ndarray) -> np.ndarray:
    """Places in bytes where units end, the start of the text as the first of them."""
    white = _WHITE[text]
    ends = np.flatnonzero(~white[:-1] & white[1:]) + 1
    return np.concatenate(([0], ends, [len(text)] if len(text) else [])).astype(np.int64)


def code_points(text: np.ndarray) -> int:
    return int(np.count_nonzero((text & 0xC0) != 0x80))


def reverse(buffer: bytearray, start: int, end: int) -> None:
    """Reverse the bytes from `start` to `end` where they stand."""
    part = np.frombuffer(buffer, np.uint8)[start:end]
    half = len(part) // 2
    head = part[:half].copy()
    part[:half] = part[len(part) - half :][::-1]
    part[len(part) - half :] = head[::-1]


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Let the blocks start…middle and middle…end change places, by three reversals."""
    reverse(buffer, start, middle)
    reverse(buffer, middle, end)
    reverse(buffer, start, end)


def rearranged(text: bytes, first: int, second: int, form: str) -> bytes:
    """The text cut at two places in bytes, with sentinels, in the order of `form`."""
    buffer = bytearray(text)
    for place, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[place:place] = sentinel
    middle = first + len(PREFIX)
    suffix = second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return bytes(buffer)


def restored(output: bytes, form: str) -> bytes:
    """The text of which `rearranged` made the output."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "psm":
        start = buffer.index(SUFFIX)
        rotate(buffer, start, buffer.index(MIDDLE, start), len(buffer))
    else:
        rotate(buffer, 0, buffer.index(PREFIX), len(buffer))
    middle = buffer.index(MIDDLE)
    suffix = buffer.index(SUFFIX, middle)
    for place, sentinel in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        del buffer[place : place + len(sentinel)]
    return bytes(buffer)


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2^32 from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    changed: int = CHANGED,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """One row per row of `docs`, see SCHEMA; lengths are in code points, n in units."""

    def cut(batches):
        for batch in batches:
            drawn = [batch[c].to_pylist() for c in ("doc_id", "h1", "h2", "form")]
            rows = []
            for ident, h1, h2, form, whole in zip(*drawn, batch["text"], strict=True):
                raw = whole.as_buffer().to_pybytes()
                seen = np.frombuffer(raw, np.uint8)
                ends = unit_ends(seen)
                n = len(ends) - 1
                if form == "plain" or not raw or any(s in raw for s in (PREFIX, SUFFIX, MIDDLE)):
                    rows.append((ident, n, "plain", None, None, raw))
                    continue
                first, second = (int(ends[i]) for i in sorted((h1 % (n + 1), h2 % (n + 1))))
                lengths = code_points(seen[:first]), code_points(seen[first:second])
                rows.append((ident, n, form, *lengths, rearranged(raw, first, second, form)))
            yield _batch(rows)

    h1, h2, h3, h4 = draws(F.col(doc_id), seed)
    form = (
        F.when(h3 % 100 >= changed, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    )
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        h1.alias("h1"),
        h2.alias("h2"),
        form.alias("form"),
    ).mapInArrow(cut, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def restore(outputs: DataFrame, form: str = "form", output: str = "output", into: str = "restored") -> DataFrame:
    """`outputs` with a last column of the texts rebuilt from form and output alone.

    A row without form or output has no text; a column that has the name already goes.
    """
    given = outputs.drop(into)

    def rebuild(batches):
        for batch in batches:
            pairs = zip(batch[form].to_pylist(), batch[output], strict=True)
            texts = [
                restored(o.as_buffer().to_pybytes(), f) if f is not None and o.is_valid else None for f, o in pairs
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, into]
            )

    schema = T.StructType([*given.schema.fields, T.StructField(into, T.StringType())])
    return given.mapInArrow(rebuild, schema)
