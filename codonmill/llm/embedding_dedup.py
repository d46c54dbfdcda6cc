"""Near-duplicate vectors within a label, by randomised binary codes.

Equal vectors of a label are one class from the start. Every class's unit vector is turned
by random rotations; the signs after a rotation are its binary code. Stored beside the
first code is the correction factor, the inner product of code and turned vector, with
which code and another vector give an unbiased estimate of their inner product (Gao and
Long, "RaBitQ", 2024). The other vector takes part as 8-bit numbers, whose exact error
joins the bound.

Candidates are classes that agree in all `bits` of one of several groups of code bits. As
many groups are used as let a pair at the threshold escape with a chance of `MISSED`. A
pair is looked at in the first group in which it meets. Where the confidence bound of an
estimate, in either direction, stays below the threshold, the pair is dropped; every other
pair is computed again from the whole vectors in double precision, and links only if that
reaches the threshold.

Large groups are split into blocks, and each pair of blocks is a task of its own, so no
task grows with a group. Vectors move only for pairs that are computed again.

Rows: vectors that are null, zero or hold null or non-finite components, and rows without
label or id, link with nothing. `vec_id` is taken as a key; repeated rows count as copies.
Vectors of unlike length are not compared.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codonmill.llm.components import components
from codonmill.session import shared_folder

THRESHOLD = 0.93
MISSED = 0.002
CONFIDENCE = 4.5  # standard deviations of an estimate
BLOCK = 512
GROUP_ROWS = 16
SEED = 8


@cache
def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    normal = np.random.default_rng([SEED, dim, number]).standard_normal((dim, dim))
    q, r = np.linalg.qr(normal)
    return q * np.sign(np.diag(r))


def plan(n_in_label: int, threshold: float) -> tuple[int, int]:
    """Bits per group and number of groups, for labels of about this many classes."""
    bits = max(4, min(30, math.ceil(math.log2(max(n_in_label, 1) / GROUP_ROWS + 1))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log(1 - agree))


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `vectors`."""
    spark = vectors.sparkSession
    folder = shared_folder(spark)
    _classed(vectors, vec_id, embedding, label).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    kind = ["label", "digest"]
    classes = rows.where("valid").groupBy(*kind).agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    own = (
        rows.where("valid")
        .join(classes.withColumnRenamed("node", "vec_id"), [*kind, "vec_id"])
        .dropDuplicates([*kind, "vec_id"])
        .select(F.col("vec_id").alias("node"), "label", "digest", "vector", "copies")
    )
    own.write.parquet(f"{folder}/classes")
    own = spark.read.parquet(f"{folder}/classes")

    largest = own.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    pairs = _candidates(own.select("node", "label", "vector"), *plan(largest, threshold), threshold)
    _exact(pairs, own.select("node", "vector"), threshold).write.parquet(f"{folder}/links")
    links = spark.read.parquet(f"{folder}/links")

    copies = own.select("node", "copies")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = (
        both.join(copies.withColumnRenamed("node", "b"), "b")
        .groupBy(F.col("a").alias("node"))
        .agg(F.sum("copies").alias("others"))
    )
    found = (
        own.select("node", "label", "digest", "copies")
        .join(degree, "node", "left")
        .join(components(links), "node", "left")
        .select(
            *kind,
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    alone = rows.where("NOT valid").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    linked = rows.where("valid").join(found, kind).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )


def _classed(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """Rows with their vector as bytes (doubles), a digest of it, and whether it can link."""
    numbers = F.col(embedding).cast("array<double>")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(numbers, lambda x: x != 0)
    usable = F.col(label).isNotNull() & F.col(vec_id).isNotNull() & finite & nonzero
    given = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.coalesce(usable, F.lit(False)).alias("valid"),
        F.when(usable, numbers).alias("numbers"),
    )

    def as_bytes(batches):
        for batch in batches:
            data = [
                None if x is None else np.array(x, float).tobytes() for x in batch["numbers"].to_pylist()
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch["vec_id"],
                    "label": batch["label"],
                    "valid": batch["valid"],
                    "digest": pa.array([None if d is None else xxhash.xxh3_128_digest(d) for d in data], pa.binary()),
                    "vector": pa.array(data, pa.binary()),
                }
            )

    return given.mapInArrow(as_bytes, "vec_id long, label string, valid boolean, digest binary, vector binary")


def encode(unit: np.ndarray, bits: int, n_groups: int) -> dict[str, np.ndarray]:
    """Codes of unit vectors (one per row): group keys, first code, factor, 8-bit numbers."""
    dim = unit.shape[1]
    n_rotations = -(-bits * n_groups // dim)
    turned = [unit @ rotation(dim, i).T for i in range(n_rotations)]
    signs = np.concatenate([t > 0 for t in turned], axis=1)[:, : bits * n_groups]
    places = 1 << np.arange(bits, dtype=np.int64)
    keys = signs.reshape(len(unit), n_groups, bits) @ places
    first = turned[0]
    factor = np.abs(first).sum(axis=1) / math.sqrt(dim)
    scale = np.maximum(np.abs(first).max(axis=1), 1e-300) / 127
    small = np.rint(first / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(first - small * scale[:, None], axis=1)
    return {"keys": keys, "code": first > 0, "factor": factor, "small": small, "scale": scale, "error": error}


def may_reach(one: dict, two: dict, threshold: float) -> np.ndarray:
    """For all rows of `one` against all of `two`: no confidence bound excludes the threshold."""
    dim = one["code"].shape[1]
    possible = np.ones((len(one["code"]), len(two["code"])), bool)
    for vector, code, turn in ((one, two, False), (two, one, True)):
        sign = np.where(code["code"], 1.0, -1.0) / math.sqrt(dim)
        product = (vector["small"].astype(float) * vector["scale"][:, None]) @ sign.T
        factor = code["factor"][None, :]
        spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(dim - 1, 1))
        upper = (product + vector["error"][:, None]) / factor + CONFIDENCE * spread
        possible &= (upper >= threshold).T if turn else upper >= threshold
    return possible


def _candidates(own: DataFrame, bits: int, n_groups: int, threshold: float) -> DataFrame:
    """Pairs (a < b) that meet in a group and that no bound excludes, each once."""

    def coded(batches):
        for batch in batches:
            data = batch["vector"].to_pylist()
            sizes = np.array([len(d) for d in data], np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                matrix = np.frombuffer(b"".join(data[i] for i in at)).reshape(len(at), -1)
                largest = np.abs(matrix).max(axis=1, keepdims=True)
                unit = matrix / largest
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                found = encode(unit, bits, n_groups)
                yield pa.RecordBatch.from_pydict(
                    {
                        "node": batch["node"].take(pa.array(at)),
                        "label": batch["label"].take(pa.array(at)),
                        "dim": pa.array(np.full(len(at), size // 8, np.int32)),
                        "keys": pa.array(list(found["keys"]), pa.list_(pa.int64())),
                        "code": pa.array([np.packbits(c).tobytes() for c in found["code"]], pa.binary()),
                        "small": pa.array([s.tobytes() for s in found["small"]], pa.binary()),
                        "factor": found["factor"],
                        "scale": found["scale"],
                        "error": found["error"],
                    }
                )

    schema = (
        "node long, label string, dim int, keys array<long>, code binary, small binary, "
        "factor double, scale double, error double"
    )
    codes = own.mapInArrow(coded, schema)
    group = ["label", "dim", "number", "key"]
    placed = codes.select("*", F.posexplode("keys").alias("number", "key"))
    sizes = placed.groupBy(*group).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    blocked = (
        placed.join(sizes, group)
        .withColumn("n_blocks", n_blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("size", "n_blocks", "other")
    )

    def side(table: pa.Table, at: np.ndarray) -> dict:
        part = table.take(pa.array(at))
        dim = part["dim"][0].as_py()
        code = np.frombuffer(b"".join(part["code"].to_pylist()), np.uint8).reshape(len(at), -1)
        return {
            "node": part["node"].to_numpy(),
            "keys": np.array(part["keys"].to_pylist(), np.int64),
            "code": np.unpackbits(code, axis=1)[:, :dim].astype(bool),
            "small": np.frombuffer(b"".join(part["small"].to_pylist()), np.int8).reshape(len(at), dim),
            **{c: part[c].to_numpy() for c in ("factor", "scale", "error")},
        }

    def compare(table: pa.Table) -> pa.Table:
        block = table["block"].to_numpy()
        low, high, number = (table[c][0].as_py() for c in ("low", "high", "number"))
        rows, columns = np.flatnonzero(block == low), np.flatnonzero(block == high)
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)
        if len(rows) and len(columns):
            one, two = side(table, rows), side(table, columns)
            i, j = np.nonzero(may_reach(one, two, threshold))
            ordered = (one["node"][i] < two["node"][j]) if low == high else one["node"][i] != two["node"][j]
            i, j = i[ordered], j[ordered]
            earlier = (one["keys"][i, :number] == two["keys"][j, :number]).any(axis=1)
            i, j = i[~earlier], j[~earlier]
            a = np.minimum(one["node"][i], two["node"][j])
            b = np.maximum(one["node"][i], two["node"][j])
        return pa.table({"a": a, "b": b})

    return blocked.groupBy(*group, "low", "high").applyInArrow(compare, "a long, b long")


def _exact(pairs: DataFrame, own: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose cosine in double precision reaches the threshold."""

    def check(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch["x"].to_pylist(), batch["y"].to_pylist(), strict=True)):
                one, two = np.frombuffer(x), np.frombuffer(y)
                one, two = one / np.abs(one).max(), two / np.abs(two).max()
                if one @ two / math.sqrt((one @ one) * (two @ two)) >= threshold:
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    joined = pairs.join(own.toDF("a", "x"), "a").join(own.toDF("b", "y"), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")
