"""Quality rules: one table of thresholds compiled into one projection.

Every measure is a built-in expression over the row at hand, so the whole operator is a
narrow projection over the scan: no shuffle, no user function, no state between rows.
A document of any length is measured whole; the repeated windows are found by sorting
one array of numbers per document, so the work for n words is n log n.

Null and empty texts have no words: all counts are 0, and they fail the base rule.
Repeated rows are judged one by one. Columns of the input that share a name with a
measure are left out of the measured frame by `measure`, and kept as they are by `keep`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space, characters counted as symbols, common short words.
WHITE = " \t\n\x0b\x0c\r"
BETWEEN_WORDS = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
STOP_WORDS = {
    "en": "the of and to in is was for that this with by on as it be are from an or not at a",
    "de": "der die das und in zu den dem des mit von ist nicht ein eine auf im sich als auch",
    "fr": "le la les de des du et en un une est que qui dans pour par sur au aux pas avec",
    "es": "el la los las de del y en un una es que por con para su se no al lo",
}


@dataclass(frozen=True)
class Rule:
    """A document passes if `low <= measure <= high`."""

    name: str
    low: float | None = None
    high: float | None = None


#: Measures are defined in `measure`; shares are of words, of lines or of characters.
RULES = (
    Rule("n_words", low=50),
    Rule("mean_word_chars", low=2.0, high=12.0),
    Rule("symbol_share", high=0.1),
    Rule("stop_word_share", low=0.06),
    Rule("dup_line_share", high=0.3),
    Rule("repeat_word_share", high=0.5),
)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns and one column per measure, in one chain of projections."""
    names = [
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        "n_stop_words", "mean_word_chars", "symbol_share", "stop_word_share",
        "dup_line_share", "repeat_word_share",
    ]
    own = [c for c in docs.columns if c not in names]
    whole = F.coalesce(F.col(text), F.lit(""))
    stop_words = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    trimmed = F.btrim(whole, F.lit(WHITE))
    split = docs.select(
        *own,
        F.when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, BETWEEN_WORDS))
        .alias("_words"),
        F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD_CHARACTER)).alias("_lines"),
        F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    windows = split.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(stop_words))).cast("long"),
            "_windows": _window_hashes("_words"),
        }
    ).drop("_words", "_lines")
    counted = _repeated_words(windows)
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    shares = {
        "mean_word_chars": F.col("word_chars") / per_word,
        "symbol_share": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "stop_word_share": F.col("n_stop_words") / per_word,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_word_share": F.col("n_repeat_words") / per_word,
    }
    measured = [shares[c].alias(c) if c in shares else F.col(c) for c in names]
    # A row's measures are generated as one row of values. A filter on them then stays above,
    # as a filter on generated values does; below, it would repeat every measure it mentions.
    return counted.select(*own, F.inline(F.array(F.struct(*measured))))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules as one Boolean expression over the measures."""
    passed = F.lit(True)
    for rule in rules:
        if rule.low is not None:
            passed = passed & (F.col(rule.name) >= rule.low)
        if rule.high is not None:
            passed = passed & (F.col(rule.name) <= rule.high)
    return passed


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Each document with its measures, the base rule and the verdict."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measure(docs.drop("base_failed", "kept"), text).withColumns(
        {"base_failed": failed, "kept": ~failed & verdict(rules)}
    )


def keep(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with the input's columns as they were."""
    packed = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text"))
    return judge(packed, "_text", rules).where("kept").select("_row.*")


def _window_hashes(words: str, width: int = 3) -> Column:
    """A 64-bit hash for each run of `width` words; none if two runs do not fit."""
    n = F.size(words)
    hashes = F.transform(
        F.sequence(F.lit(0), n - width),
        lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(width)]),
    )
    return F.when(n > width, hashes).otherwise(F.array().cast("array<long>"))


def _repeated_words(df: DataFrame, width: int = 3) -> DataFrame:
    """Number of words in runs that occur twice or more; needs `_windows`, drops it.

    A hash and its position share one long: as many low bits as the position needs, and
    the rest from the hash. Sorting brings equal runs together without a comparator.
    """
    none = F.array().cast("array<long>")
    bits = F.length(F.bin(F.size("_windows").cast("long")))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    sized = df.withColumns({"_bits": bits, "_repeats": repeats})
    placed = F.transform("_windows", lambda h, i: F.call_function("shiftleft", h, F.col("_bits")).bitwiseOR(i.cast("long")))
    ordered = sized.withColumn("_sorted", F.when(F.col("_repeats"), F.sort_array(placed)).otherwise(none)).drop("_windows")
    run = lambda x: F.call_function("shiftright", x, F.col("_bits"))

    def twin(x: Column, i: Column) -> Column:
        before = run(x) == run(F.get(F.col("_sorted"), i - 1))
        after = run(x) == run(F.get(F.col("_sorted"), i + 1))
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    low = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1
    starts = F.sort_array(F.transform(F.filter("_sorted", twin), lambda x: x.bitwiseAND(low)))
    covered = F.aggregate(
        F.when(F.col("_repeats"), starts).otherwise(none),
        F.struct(F.lit(-width).cast("long").alias("last"), F.lit(0).cast("long").alias("words")),
        lambda so_far, at: F.struct(
            at.alias("last"),
            (so_far["words"] + F.least(at - so_far["last"], F.lit(width).cast("long"))).alias("words"),
        ),
        lambda so_far: so_far["words"],
    )
    return ordered.withColumn("n_repeat_words", covered).drop("_sorted", "_bits", "_repeats")
