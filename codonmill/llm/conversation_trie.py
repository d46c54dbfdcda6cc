"""Prefix trie of conversations, with totals of subtrees rolled up in bands of depth.

1. Turns are sorted once by range over the whole table, so that no task holds a whole
   conversation, and numbered within their conversation by a count per range and one
   total per range (`ordered_turns`).
2. A node is a sequence of first turns. Its digest is the exclusive or of 128-bit hashes
   of (place, role, text), a running value that is taken within blocks of turns and over
   the blocks. One aggregation by depth and digest gives nodes, members and smallest
   member; it is combined before its shuffle, so the root, a member of which every
   conversation is, is one row per task.
3. Totals of subtrees: depths are cut into bands of `BAND`. A node's values go to its
   ancestors within its band only; the chain of a conversation within a band is one array
   of at most `BAND` entries, along which the values are summed before they leave. The
   roots of bands then are a trie of their own, of depth 1/`BAND`, rolled up in the same
   way, and the totals of its nodes go to the band above them. So rounds grow with the
   logarithm of the depth, and no row becomes more than `BAND` rows.
4. The members that end at a node are listed in pieces of `PIECE` neighbouring ids. A node
   with several pieces has its digest fed piece by piece, in one sorted stream: a SHA-256
   is a chain by its nature, but needs no list in memory.

Every table that is used twice is written to the shared folder and read again.

Rows: rows without a conv_id belong to no conversation and are left out. A null role or
text is an empty one. Turns sort null first; turns of one number follow by role and text
in code point order, and repeated rows are turns of their own. Only the four columns are
read. An empty table has no nodes, not even the root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codonmill.operators.numbering import running_total
from codonmill.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
BAND = 16
#: Turns whose running digest one window takes.
BLOCK = 1024
#: Width of a piece of ids in bits.
PIECE = 12
#: Conversations by tens of ids share a head of so many turns less one at most.
FAMILY, HEADS = 20, 4

NODE = ["depth", "p1", "p2"]


class _Tables:
    """Tables of one run in the shared folder."""

    def __init__(self, df: DataFrame):
        self.spark, self.folder = df.sparkSession, shared_folder(df.sparkSession)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, t1, t2, words): turns by their place in the conversation, from 0.

    t1 and t2 are a digest of role and text.
    """
    tables = _Tables(conversations)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        # Copies of one row are told apart, so that many of them need not share a range.
        F.monotonically_increasing_id().alias("copy"),
    )
    by = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    in_order = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = tables.written(
        in_order.select(
            "conv_id",
            F.monotonically_increasing_id().alias("place"),
            F.spark_partition_id().alias("range"),
            F.xxhash64("role", "text").alias("t1"),
            F.xxhash64(F.lit(1), "text", "role").alias("t2"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        ),
        "turns",
    )
    return running_total(placed, "conv_id", F.lit(1), "at", ["place"], ["range"]).drop("place", "range")


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first of their family.

    A conversation c takes its first h turns, h = crc32(c) % `heads`, from conversation
    c - c % `family`, fewer if that one is shorter, and keeps its own after its first h.
    Returns the turns and (conv_id, length) of every conversation, also those without turns.
    """
    tables = _Tables(turns)
    turns = tables.written(turns, "numbered")
    own = F.crc32(F.col("conv_id").cast("string")) % heads
    plan = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"h": own, "first": F.col("conv_id") - F.col("conv_id") % family}
    )
    plan = tables.written(plan, "plan")
    firsts = plan.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    taken = F.least("h", F.coalesce("n_first", F.lit(0)))
    plan = plan.join(firsts, "first", "left").withColumn("m", taken)
    plan = tables.written(plan.select("conv_id", "n", "h", "first", "m"), "heads")

    tail = turns.join(plan.select("conv_id", "h", "m"), "conv_id").where("at >= h")
    tail = tail.withColumn("at", F.col("at") - F.col("h") + F.col("m")).drop("h", "m")
    asked = plan.where("m > 0").select(
        "conv_id", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("at")
    )
    lent = turns.where((F.col("at") < heads - 1) & (F.col("conv_id") % family == 0))
    head = asked.join(lent.withColumnRenamed("conv_id", "first"), ["first", "at"]).select(*tail.columns)
    lengths = plan.select("conv_id", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return tail.unionByName(head), lengths


def paths(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for every conversation and depth up to its length, the root included.

    (conv_id, depth, p1, p2, q1, q2, words, ends): digests of the node and its parent,
    words of the node's last turn, and whether the conversation ends there.
    """
    block = F.floor(F.col("at") / BLOCK)
    rows = turns.select(
        "conv_id",
        "at",
        "words",
        F.xxhash64("at", "t1", "t2").alias("g1"),
        F.xxhash64(F.lit(2), "t2", "at", "t1").alias("g2"),
        block.alias("block"),
    )
    totals = rows.groupBy("conv_id", "block").agg(F.bit_xor("g1").alias("b1"), F.bit_xor("g2").alias("b2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "conv_id",
        "block",
        *[F.coalesce(F.bit_xor(b).over(before), F.lit(0)).alias(b) for b in ("b1", "b2")],
    )
    within = Window.partitionBy("conv_id", "block").orderBy("at")
    running = rows.withColumns({f"r{i}": F.bit_xor(f"g{i}").over(within) for i in (1, 2)})
    joined = running.join(starts, ["conv_id", "block"]).join(lengths, "conv_id")
    p = {i: F.col(f"r{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)}
    below = joined.select(
        "conv_id",
        (F.col("at") + 1).alias("depth"),
        p[1].alias("p1"),
        p[2].alias("p2"),
        p[1].bitwiseXOR(F.col("g1")).alias("q1"),
        p[2].bitwiseXOR(F.col("g2")).alias("q2"),
        "words",
        (F.col("at") + 1 == F.col("length")).alias("ends"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = lengths.select(
        "conv_id",
        zero.alias("depth"),
        zero.alias("p1"),
        zero.alias("p2"),
        none.alias("q1"),
        none.alias("q2"),
        zero.alias("words"),
        (F.col("length") == 0).alias("ends"),
    )
    return below.unionByName(roots)


def trie(turns: DataFrame, lengths: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node, see the module; `turns` as of `ordered_turns` or `rebuilt`.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, p1, p2): the node is named by its smallest member and depth, or by digest.
    """
    tables = _Tables(turns)
    every = tables.written(paths(turns, lengths), "paths")
    nodes = tables.written(
        every.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            *[F.max(c).alias(c) for c in ("q1", "q2", "words")],
        ),
        "nodes",
    )
    parents = (F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")
    children = nodes.where("depth > 0").groupBy(*parents).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = tables.written(
        nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "family"
    )
    valued = nodes.select(
        "conv_id",
        *NODE,
        "q1",
        "q2",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    totals = subtree_totals(valued, every.select("conv_id", *NODE), ["n_leaves", "saved_tokens"], band)
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("p1").alias("q1"),
        F.col("p2").alias("q2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return (
        nodes.join(totals, NODE)
        .join(_end_digests(every.where("ends").select(*NODE, "conv_id")), NODE, "left")
        .join(above, ["depth", "q1", "q2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
            "p1",
            "p2",
        )
    )


def subtree_totals(nodes: DataFrame, lineage: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """NODE columns and, for each of `values`, its sum over the node's subtree, itself included.

    `nodes` are (conv_id, depth, p1, p2, q1, q2, values…) with q1 and q2 of the parent, and
    `lineage` has the nodes (conv_id, depth, p1, p2) that a conversation runs through.
    """
    tables = _Tables(nodes)
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = _within_bands(nodes, lineage, values, band)
    if deepest < band:
        return sums
    sums = tables.written(sums, "sums")
    is_root = F.col("depth") % band == 0
    higher = (F.col("depth") / band).cast("long")
    roots = nodes.where(is_root).select("conv_id", *NODE, "q1", "q2").join(sums, NODE)
    # The parent of a band's root among the roots is the root of the band above it.
    tops = lineage.where(is_root).withColumn("depth", higher)
    known = subtree_totals(roots.withColumn("depth", higher), tops, values, band)
    whole = tables.written(known, "roots").withColumn("depth", F.col("depth") * band)
    handed = nodes.where(is_root & (F.col("depth") > 0)).select("conv_id", *NODE).join(whole, NODE)
    handed = handed.select("conv_id", (F.col("depth") - 1).alias("depth"), *values)
    received = _within_bands(handed, lineage, values, band)
    return sums.unionByName(received).groupBy(*NODE).agg(*[F.sum(v).alias(v) for v in values])


def _within_bands(nodes: DataFrame, lineage: DataFrame, values: list[str], band: int) -> DataFrame:
    """Sums over the descendants in the same band; `nodes` are (conv_id, depth, values…).

    A conversation's nodes of one band are at most `band`, and so are their ancestors there.
    """
    number = F.floor(F.col("depth") / band).alias("band")
    chains = lineage.groupBy("conv_id", number).agg(F.collect_list(F.struct(*NODE)).alias("chain"))
    given = nodes.groupBy("conv_id", number).agg(F.collect_list(F.struct("depth", *values)).alias("given"))

    def below(value: str, entry):
        deeper = F.filter("given", lambda g: g["depth"] >= entry["depth"])
        start = F.lit(0).cast("long")
        return F.aggregate(deeper, start, lambda total, g: total + g[value]).alias(value)

    entry = F.col("entry")
    spread = given.join(chains, ["conv_id", "band"]).select("given", F.explode("chain").alias("entry"))
    summed = spread.where(F.exists("given", lambda g: g["depth"] >= entry["depth"])).select(
        *[entry[c].alias(c) for c in NODE], *[below(v, entry) for v in values]
    )
    return summed.groupBy(*NODE).agg(*[F.sum(v).alias(v) for v in values])


def _end_digests(ends: DataFrame) -> DataFrame:
    """NODE columns and the SHA-256 of the conv_ids, ascending and joined by commas."""
    tables = _Tables(ends)
    piece = F.shiftright("conv_id", PIECE).alias("piece")
    ids = F.sort_array(F.collect_list("conv_id"))
    listed = ends.groupBy(*NODE, piece).agg(F.array_join(ids.cast("array<string>"), ",").alias("ids"))
    listed = tables.written(listed, "ends")
    counted = listed.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n"), F.min("ids").alias("ids"))
    single = counted.where("n = 1").select(*NODE, F.sha2("ids", 256).alias("ends_sha256"))
    several = listed.join(counted.where("n > 1").select(*NODE), NODE)
    schema = "depth long, p1 long, p2 long, ends_sha256 string"
    streamed = several.repartition(*NODE).sortWithinPartitions(*NODE, "piece").mapInArrow(_streamed, schema)
    return single.unionByName(streamed)


def _streamed(batches):
    """A digest per node from pieces that come sorted by node and piece."""
    node, digest = None, None
    done: list[tuple] = []
    for batch in batches:
        for *key, ids in zip(*[batch[c].to_pylist() for c in (*NODE, "ids")], strict=True):
            if key == node:
                digest.update(b",")
            else:
                done += [(*node, digest.hexdigest())] if node else []
                node, digest = key, hashlib.sha256()
            digest.update(ids.encode())
        yield _digests(done)
        done = []
    yield _digests([(*node, digest.hexdigest())] if node else [])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    names = [*NODE, "ends_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )
