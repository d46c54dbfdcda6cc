"""Secrets in texts: patterns, and character Markov models for random strings.

The base patterns find assignments, access ids and long hexadecimal runs. Beside them,
what base spans leave of every long run of key characters is scored by two first-order
Markov models over characters, one of random strings and one of ordinary identifiers.
Stretches are sought in which the logarithm of their likelihood ratio adds up to more than
`MARGIN`: a stretch ends where the sum is down to zero or `DROP` below its best, or at a
`=`. It is reported up to the next `/` or `=` on both sides, so that a secret stays whole
and the name or path beside it is left alone.

The models are trained from labelled samples, on documents of a bounded number drawn by
the hash of their text (`SAMPLE`). Random strings are digests of the sampled texts in
several alphabets, random by construction. Ordinary identifiers are the sampled words that
mix no digits into letters, and names, paths and capitals put together from neighbouring
words. Only the
bigram counts, at most two per pair of characters, come to the driver.

Everything is a built-in expression. Scanning is a narrow projection without a shuffle;
positions come from the lengths of matches and of what lies between them.

Rows: null and empty texts have no spans. Repeated rows are scanned one by one. Columns of
the input with clashing names stay out of `scan` and are kept as they are by `redact`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in their order, patterns, group that has to reach a length.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
SAMPLE = 2000
MARGIN = 12.0
DROP = 10.0
SMOOTHING = 1000.0
LEAST = 16
MASK = "[SECRET]"

SPANS = "array<struct<start:int,end:int>>"


def _spans(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Start and end of every match whose `group` has `least` characters, in code points."""
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )

    def step(so_far: Column, part: Column) -> Column:
        start = so_far["at"] + F.length(part["between"])
        end = start + F.length(part["found"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        valid = part["found"].isNotNull() & (F.length(part["value"]) >= least)
        return F.struct(
            end.alias("at"), F.when(valid, F.concat(so_far["spans"], span)).otherwise(so_far["spans"]).alias("spans")
        )

    none = F.array().cast(SPANS)
    found = F.aggregate(
        zipped, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda so_far: so_far["spans"]
    )
    return F.when(text.rlike(pattern), found).otherwise(none)


def _kind(char: str) -> str:
    """Upper-case and lower-case letters, digits; every other character is a kind of its own."""
    return "A" if char.isupper() else "a" if char.islower() else "0" if char.isdigit() else char


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> dict[tuple[str, str], float]:
    """Log-likelihood ratio of each pair of neighbouring characters, random over ordinary."""
    n_docs = docs.count()
    drawn = docs.where(F.pmod(F.xxhash64(text), F.lit(max(1, n_docs))) < sample).select(
        F.col(text).alias("text")
    )
    digest = F.unhex(F.sha2("text", 256))
    encoded = F.base64(digest)
    random = F.array(
        F.md5("text"),
        F.upper(F.sha1("text")),
        encoded,
        F.base64(F.unhex(F.sha2(F.reverse("text"), 256))),
        F.translate(encoded, "+/=", "-_"),
    )
    words = F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=-]{3,}"), F.lit(0))
    plain = F.filter(words, lambda w: ~w.rlike(r"[0-9][A-Za-z]+[0-9]|[A-Za-z][0-9]+[A-Za-z]|[0-9a-f]{16}"))
    listed = drawn.select(random.alias("random"), plain.alias("plain"))
    def pairs(join) -> Column:
        return F.zip_with("plain", F.slice("plain", 2, 2**30), join)

    names = [
        pairs(lambda a, b: F.concat_ws("_", a, b)),
        pairs(lambda a, b: F.concat_ws("-", a, b)),
        pairs(lambda a, b: F.concat_ws("/", a, b)),
        pairs(lambda a, b: F.concat(a, F.initcap(b))),
        pairs(lambda a, b: F.upper(F.concat_ws("_", a, b))),
    ]

    def marked(runs: Column, label: int) -> Column:
        return F.transform(runs, lambda run: F.struct(run.alias("run"), F.lit(label).alias("label")))

    both = F.concat(marked(F.col("random"), 1), marked(F.concat("plain", *names), 0))
    labelled = listed.select(F.inline(both))
    counts = (
        labelled.where(F.length("run") > 1)
        .select("label", "run", F.explode(F.sequence(F.lit(1), F.length("run") - 1)).alias("i"))
        .select("label", F.expr("substring(run, i, 2)").alias("pair"))
        .groupBy("label", "pair")
        .count()
        .where(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$"))
        .collect()
    )
    found = {(r["label"], r["pair"]): r["count"] for r in counts}
    starts = {
        (label, a): sum(found.get((label, a + b), 0) for b in ALPHABET) for label in (0, 1) for a in ALPHABET
    }

    # Pairs are smoothed towards those of their kinds of character, so that an unseen pair of
    # letters in a name is no more of a surprise than any other such pair.
    kinds: dict[tuple[int, str, str], int] = {}
    for (label, pair), n in found.items():
        at = (label, _kind(pair[0]), _kind(pair[1]))
        kinds[at] = kinds.get(at, 0) + n
    n_kind = {k: sum(_kind(c) == k for c in ALPHABET) for k in map(_kind, ALPHABET)}
    n_from = {(label, k): sum(kinds.get((label, k, m), 0) for m in n_kind) for label in (0, 1) for k in n_kind}

    def chance(label: int, a: str, b: str) -> float:
        k, m = _kind(a), _kind(b)
        expected = (kinds.get((label, k, m), 0) + 1) / (n_from[label, k] + len(n_kind)) / n_kind[m]
        return math.log((found.get((label, a + b), 0) + SMOOTHING * expected) / (starts[label, a] + SMOOTHING))

    return {(a, b): chance(1, a, b) - chance(0, a, b) for a in ALPHABET for b in ALPHABET}


def _table(ratios: dict[tuple[str, str], float]) -> Column:
    """The ratios as one constant array, found by the codes of the two characters."""
    flat = ["0"] * (128 * 128)
    for (a, b), ratio in ratios.items():
        flat[ord(a) * 128 + ord(b)] = f"{ratio:.6f}"
    return F.split(F.lit(",".join(flat)), ",").cast("array<double>")


def stretches(run: Column, ratios: dict[tuple[str, str], float], margin: float = MARGIN) -> Column:
    """Start and end of the random stretches of `run`, which has ALPHABET only.

    One pass over its characters. The state has the code of the last one, its place, where
    the present part of the run (between `/` and `=`) began, where the stretch and the part
    it is in began, its sum, the best sum and where that was reached.
    """
    table = _table(ratios)
    span = lambda start, end: F.array(F.struct(start.alias("start"), end.alias("end")))

    def ended(st: Column) -> Column:
        """The spans with the present stretch, if it is one; stretches in one part are merged."""
        rest = F.regexp_extract(F.substring(run, st["to"] + 1, F.length(run)), r"^[^/=]*", 0)
        end = st["to"] + F.length(rest)
        last = F.element_at(st["spans"], -1)
        merged = F.concat(F.slice(st["spans"], 1, F.size(st["spans"]) - 1), span(last["start"], end))
        found = F.when((F.size(st["spans"]) > 0) & (last["end"] > st["origin"]), merged)
        found = found.otherwise(F.concat(st["spans"], span(st["origin"], end)))
        valid = (st["best"] > margin) & (st["to"] - st["start"] >= LEAST)
        return F.when(valid, found).otherwise(st["spans"])

    def state(code, at, part, start, origin, total, best, to, spans) -> Column:
        fields = dict(
            code=code, at=at, part=part, start=start, origin=origin, sum=total, best=best, to=to, spans=spans
        )
        return F.struct(*[c.alias(n) for n, c in fields.items()])

    def step(st: Column, char: Column) -> Column:
        def with_sum(now: Column) -> Column:
            code, total, at = now["code"], now["sum"], st["at"]
            cuts = code == ord("=")
            part = F.when(cuts | (code == ord("/")), at + 1).otherwise(st["part"])
            is_over = cuts | (total <= 0) | (st["best"] - total > DROP)
            # The next stretch begins with this character, or behind it if that is a `=`.
            begin = F.when(cuts, at + 1).otherwise(at)
            fresh = state(code, at + 1, part, begin, part, F.lit(0.0), F.lit(0.0), begin, ended(st))
            better = total > st["best"]
            more = state(
                code, at + 1, part, st["start"], st["origin"], total,
                F.greatest(total, st["best"]), F.when(better, at + 1).otherwise(st["to"]), st["spans"],
            )
            return F.when(is_over, fresh).otherwise(more)

        code = F.ascii(char)
        total = st["sum"] + F.get(table, st["code"] * 128 + code)
        # Bound by a lambda, so that the sum is computed once.
        return F.get(F.transform(F.array(F.struct(code.alias("code"), total.alias("sum"))), with_sum), F.lit(0))

    zero, none = F.lit(0), F.array().cast(SPANS)
    first = state(zero, zero, zero, zero, zero, F.lit(0.0), F.lit(0.0), zero, none)
    return F.aggregate(F.split(run, ""), first, step, ended)


def _free(run: Column, base: Column) -> Column:
    """What spans leave of `run`, as spans; `base` are those that touch it, by start."""

    def step(so_far: Column, span: Column) -> Column:
        left = F.array(F.struct(so_far["at"].alias("start"), span["start"].alias("end")))
        return F.struct(
            F.greatest(so_far["at"], span["end"]).alias("at"),
            F.when(span["start"] > so_far["at"], F.concat(so_far["left"], left)).otherwise(so_far["left"]).alias("left"),
        )

    def behind(so_far: Column) -> Column:
        return F.concat(so_far["left"], F.array(F.struct(so_far["at"].alias("start"), run["end"].alias("end"))))

    first = F.struct(run["start"].alias("at"), F.array().cast(SPANS).alias("left"))
    return F.aggregate(base, first, step, behind)


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", margin: float = MARGIN, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, assign, access, hex, markov): spans of each kind; and the columns `keep`."""
    ratios = train(docs, text)
    whole = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(
        F.col(doc_id).alias("doc_id"),
        *[F.col(c) for c in keep],
        whole.alias("_text"),
        _spans(whole, ASSIGN, 2, ASSIGN_VALUE).alias("assign"),
        _spans(whole, ACCESS).alias("access"),
        _spans(whole, HEX).alias("hex"),
        _spans(whole, RUN).alias("_runs"),
    ).withColumn("_base", F.sort_array(F.concat("assign", "access", "hex")))

    def of_run(run: Column) -> Column:
        touching = F.filter("_base", lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
        left = F.filter(_free(run, touching), lambda p: p["end"] - p["start"] >= LEAST)
        return F.flatten(F.transform(left, of_piece))

    def of_piece(piece: Column) -> Column:
        string = F.substr(F.col("_text"), piece["start"] + 1, piece["end"] - piece["start"])
        moved = lambda s: F.struct(
            (s["start"] + piece["start"]).alias("start"), (s["end"] + piece["start"]).alias("end")
        )
        # Bound by a lambda, so that the string is taken from the text once.
        found = F.get(F.transform(F.array(string), lambda x: stretches(x, ratios, margin)), F.lit(0))
        return F.transform(found, moved)

    markov = F.flatten(F.transform("_runs", of_run))
    return found.select("doc_id", *keep, "assign", "access", "hex", markov.alias("markov"))


def _written(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans, by start and then in the order of kinds, joined by commas."""

    def with_rank(rank: int, kind: str) -> Column:
        return F.transform(
            kind, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("kind"), s["end"].alias("end"))
        )

    ranked = F.concat(*[with_rank(rank, kind) for rank, kind in enumerate(kinds)])
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(
            F.sort_array(ranked), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document: number of base spans by kind, digest of the base, all spans as text."""
    return scan(docs).select(
        "doc_id",
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        F.sha2(_written(KINDS[:3]), 256).alias("base_sha256"),
        _written(KINDS).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", mask: str = MASK) -> DataFrame:
    """The documents with every span masked; `n_chars`, if there, follows the new text."""
    rows = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_whole"))
    found = scan(rows.withColumn("_id", F.lit(None)), "_id", "_whole", keep=("_row", "_whole"))
    spans = F.sort_array(F.concat(*KINDS))

    def step(so_far: Column, span: Column) -> Column:
        between = F.substr(F.col("_whole"), so_far["at"] + 1, F.greatest(span["start"] - so_far["at"], F.lit(0)))
        new = F.when(span["start"] >= so_far["at"], F.concat(so_far["out"], between, F.lit(mask)))
        return F.struct(
            F.greatest(so_far["at"], span["end"]).alias("at"), new.otherwise(so_far["out"]).alias("out")
        )

    masked = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda so_far: F.concat(so_far["out"], F.substr(F.col("_whole"), so_far["at"] + 1, F.length("_whole"))),
    )
    changed = F.size(spans) > 0
    clean = found.select("_row", F.when(changed, masked).otherwise(F.col("_whole")).alias("_clean"), changed.alias("_changed"))

    def column(name: str) -> Column:
        if name == text:
            return F.col("_clean").alias(name)
        own = F.col("_row").getField(name)
        if name == n_chars:
            length = F.length("_clean").cast(docs.schema[name].dataType)
            return F.when(F.col("_changed"), length).otherwise(own).alias(name)
        return own.alias(name)

    return clean.select(*[column(c) for c in docs.columns])
