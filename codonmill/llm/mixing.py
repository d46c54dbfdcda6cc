"""Mixing of sources to target weights, by fixed-length blocks.

1. Sources in code point order (null last) get the weights in turn. They share the budget
   in proportion, but none above `MOST` times its size; the rest is shared on.
2. The documents of a source, laid end to end, are cut into blocks of `BLOCK` words. A
   document's place is a running total, taken within buckets of documents and over the
   buckets, so that no task sees a whole source.
3. A source gets as many slots as its target needs. Every slot draws its output shard by
   a hash, so the source counts of the shards are multinomial, given the totals. What the
   documents give to the mix is summed from what the shards draw.
4. Slots run through the source's blocks in the order of a pseudorandom permutation of
   their numbers, again and again, so every block is taken equally often, up to one. The
   last round, if it is not a whole one, takes one stretch of neighbouring blocks, in a
   permutation of its own. Documents lie in the order of a hash, so the stretch is a draw
   of documents, and all but those at its two ends are taken a whole number of times. Slots
   and blocks are joined by source and number.

All draws are hashes of a seed, the source and a number: reruns agree. Everything is a
built-in expression; the text is read once, for its number of words.

Rows: null and empty texts have size 0 and nothing taken. Documents without a source are
a source of their own, the last. Repeated rows are laid out one by one. An empty table
gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codonmill.operators.numbering import running_total
from codonmill.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2
BLOCK = 64
SHARD_SLOTS = 4096
SLOTS_AT_ONCE = 10_000
#: Ranges of slots that a task lists, on average.
TASK_RANGES = 4
SEED = 20

#: Primes for permutations; one that does not divide the number of blocks is taken.
PRIMES = (999_999_937, 1_000_000_007, 1_000_000_009, 1_000_000_021, 1_000_000_033, 2_147_483_647)


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, tag, size) of every row; `tag` is a hash of the text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.xxhash64(whole).alias("tag"),
        F.regexp_count(whole, F.lit(WORD)).cast("long").alias("size"),
    )


def _key(source: Column | None = None) -> Column:
    """A key that is never null: sources keep their order, null comes last and apart."""
    source = F.col("source") if source is None else source
    return F.when(source.isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), source))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """(key, source_size, target) per source.

    A source is at its limit if the shared level times its weight is above the limit.
    Sources are looked at by limit per weight; the level that is left after the first of
    them are at their limit is the answer where it no longer exceeds the next one's.
    The windows are over one row per source.
    """
    per_source = sized.groupBy(_key().alias("key")).agg(F.sum("size").alias("source_size"))
    ranked = per_source.withColumn("_rank", F.row_number().over(Window.orderBy("key")) - 1)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("_rank") % len(weights))
    limited = ranked.withColumn("_weight", weight).withColumn("_limit", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("_limit") / F.col("_weight"), "key")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = limited.withColumns(
        {
            "_left": budget * F.sum("source_size").over(everything)
            - F.coalesce(F.sum("_limit").over(before), F.lit(0)),
            "_open": F.sum("_weight").over(everything)
            - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)),
        }
    ).withColumn("_level", F.col("_left") / F.col("_open"))
    fits = F.col("_level") * F.col("_weight") <= F.col("_limit")
    place = (-F.row_number().over(by_ratio)).alias("place")
    fitting = levels.withColumn("_fit", F.when(fits, F.struct(place, F.col("_level").alias("level"))))
    chosen = fitting.withColumn("_chosen", F.max("_fit").over(everything)["level"])
    return chosen.select(
        "key",
        "source_size",
        F.least(F.col("_limit").cast("double"), F.col("_chosen") * F.col("_weight")).alias("target"),
    )


def laid_out(sized: DataFrame) -> DataFrame:
    """`sized` with `key` and `start`, the words of the source before the document."""
    # As many buckets as rows in each, so that neither step of the running total is long.
    n_buckets = max(1, math.isqrt(sized.count()))
    bucket = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "tag"), F.lit(n_buckets))
    keyed = sized.withColumns({"key": _key(), "_bucket": bucket})
    placed = running_total(keyed, "key", F.col("size"), "start", ["doc_id", "tag"], ["_bucket"])
    return placed.drop("_bucket")


def block_pieces(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, index, start, doc_id, tag, from_word, words): the parts of documents in each block."""
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    spread = placed.where("size > 0").withColumn(
        "index", F.explode(F.sequence(F.floor(F.col("start") / block), last))
    )
    low = F.greatest(F.col("start"), F.col("index") * block)
    high = F.least(F.col("start") + F.col("size"), (F.col("index") + 1) * block)
    return spread.select(
        "key", "index", "start", "doc_id", "tag", (low - F.col("start")).alias("from_word"), (high - low).alias("words")
    )


def slots(plan: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(shard, key, slot, index) for every slot of the mix, given the sources' targets."""
    n_blocks = F.ceil(F.col("source_size") / block)
    n_slots = F.round(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)) * F.col("n_blocks"))
    sources = plan.where("source_size > 0").withColumn("n_blocks", n_blocks).withColumn("n_slots", n_slots.cast("long"))
    total = sources.agg(F.sum("n_slots")).first()[0] or 0
    n_shards = max(1, -(-total // SHARD_SLOTS))
    part = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_slots") - 1) / SLOTS_AT_ONCE))
    ranges = sources.where("n_slots > 0").select("key", "n_blocks", "n_slots", F.explode(part).alias("part"))
    first = F.col("part") * SLOTS_AT_ONCE
    # A stated number of partitions: the rows here are few, and are many only once they are listed.
    n_tasks = max(1, math.ceil(total / (TASK_RANGES * SLOTS_AT_ONCE)))
    listed = ranges.repartition(n_tasks, F.col("key"), F.col("part")).select(
        "key",
        "n_blocks",
        "n_slots",
        F.explode(
            F.sequence(first, F.least(first + SLOTS_AT_ONCE, F.col("n_slots")) - 1)
        ).alias("slot"),
    )
    over = F.col("n_slots") % F.col("n_blocks")
    stretch = F.when(F.col("slot") >= F.col("n_slots") - over, over).otherwise(F.col("n_blocks"))
    begin = F.pmod(F.xxhash64(F.lit(seed), F.lit("begin"), "key"), F.col("n_blocks"))
    place = _permuted(F.col("slot") % F.col("n_blocks"), stretch, seed)
    return listed.select(
        F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "key", "slot"), F.lit(n_shards)).alias("shard"),
        "key",
        "slot",
        ((begin + place) % F.col("n_blocks")).alias("index"),
    )


def _permuted(i: Column, n: Column, seed: int) -> Column:
    """A pseudorandom permutation of 0 … n - 1, drawn for each source: i * stride + shift.

    A stride is a prime that does not divide n. Products take up to 38 digits.
    """
    wide = lambda c: c.cast("decimal(19,0)")
    drawn = lambda what: F.xxhash64(F.lit(seed), F.lit(what), "key")
    usable = F.filter(F.array(*[F.lit(p) for p in PRIMES]), lambda p: n % p != 0)
    stride = F.get(usable, F.pmod(drawn("stride"), F.size(usable)).cast("int")) % n
    return ((wide(i) * wide(stride) + wide(F.pmod(drawn("shift"), n))) % wide(n)).cast("long")


def mix(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as slots and block pieces, and per row of `docs` what it gives to the mix.

    slots: (shard, key, slot, index), pieces: (key, index, start, doc_id, tag, from_word,
    words), taken: (doc_id, tag, key, size, source_size, target, taken).
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    sizes(docs).write.parquet(f"{folder}/sizes")
    sized = spark.read.parquet(f"{folder}/sizes")
    targets(sized).write.parquet(f"{folder}/targets")
    plan = spark.read.parquet(f"{folder}/targets")
    laid_out(sized).write.parquet(f"{folder}/placed")
    placed = spark.read.parquet(f"{folder}/placed")

    drawn, pieces = slots(plan, block, seed), block_pieces(placed, block)
    # What each shard has drawn of a source's blocks. The planner takes the slots for as few as
    # the sources they are made of, and would broadcast these counts; they are as many as the blocks.
    times = drawn.groupBy("shard", "key", "index").agg(F.count(F.lit(1)).alias("times")).hint("merge")
    # A place in its source tells documents with words apart; those without take nothing.
    by_place = (
        pieces.join(times, ["key", "index"])
        .groupBy("key", "start")
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    taken = (
        placed.join(by_place, ["key", "start"], "left")
        .join(plan, "key")
        .select(
            "doc_id",
            "tag",
            "key",
            "size",
            "source_size",
            "target",
            F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long").alias("taken"),
        )
    )
    return drawn, pieces, taken


def shard_counts(drawn: DataFrame) -> DataFrame:
    """(shard, key, slots): the multinomial counts of the sources in every shard."""
    return drawn.groupBy("shard", "key").agg(F.count(F.lit(1)).alias("slots"))


def mixed_blocks(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The mix itself: (shard, source, slot, text) with the words of a block for every slot.

    Words stand as in the texts, joined by one space; a block at the end of its source may be
    shorter. Its pieces, at most `block`, are brought together once, however often it is drawn.
    """
    drawn, pieces, _ = mix(docs, block, seed)
    whole = F.coalesce(F.col("text"), F.lit(""))
    # Rows alike in id and text have the same words.
    texts = docs.groupBy(F.col("doc_id").alias("_id"), F.xxhash64(whole).alias("_tag")).agg(F.first(whole).alias("text"))
    same = pieces["doc_id"].eqNullSafe(texts["_id"]) & (pieces["tag"] == texts["_tag"])
    words = F.regexp_extract_all("text", F.lit(WORD), 0)
    part = F.array_join(F.slice(words, (F.col("from_word") + 1).cast("int"), F.col("words").cast("int")), " ")
    listed = F.array_sort(F.collect_list(F.struct("start", part.alias("part"))))
    blocks = (
        pieces.join(texts, same)
        .groupBy("key", "index")
        .agg(F.array_join(F.transform(listed, lambda p: p["part"]), " ").alias("text"))
    )
    source = F.when(F.col("key") != "2", F.substr("key", F.lit(2)))
    return drawn.join(blocks, ["key", "index"]).select("shard", source.alias("source"), "slot", "text")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Whole documents in the numbers of the mix: each as often as it is taken, rounded.

    Only documents at the two ends of a source's last round are taken a broken number of
    times, so a source's words miss its target by about one document at most. Rows alike in
    id, text and source share what they are taken; a hash of row and position deals out what
    does not come to all of them.
    """
    _, _, taken = mix(docs)
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0)
    wanted = (
        taken.groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), F.col("key").alias("_key"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.sum(times).cast("long").alias("_times"))
        .where("_times > 0")
    )
    tag = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    same = docs["doc_id"].eqNullSafe(wanted["_id"]) & (tag == wanted["_tag"])
    keyed = docs.withColumn("_position", F.monotonically_increasing_id())
    joined = keyed.join(wanted, same & (_key(docs["source"].cast("string")) == wanted["_key"]))
    drawn = F.pmod(F.xxhash64(F.lit(SEED), F.lit("copy"), "_tag", "_position"), F.col("_rows"))
    more = (drawn < F.col("_times") % F.col("_rows")).cast("long")
    copies = F.floor(F.col("_times") / F.col("_rows")) + more
    repeated = joined.withColumn("_copies", copies).where("_copies > 0")
    repeated = repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return repeated.select(*[docs[c] for c in docs.columns])
