"""Chromosome and position text of the gene list and of the summary records.

A position reads `chromosome:from..to`, or `chromosome:complement(from..to)`
for the reverse strand.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.functions import text

COMPLEMENT = "complement"


def chr_start(position: Column) -> Column:
    """The number after `..`: the larger end on both strands."""
    return _span_end(position, 2)


def chr_stop(position: Column) -> Column:
    """The number before `..`."""
    return _span_end(position, 1)


def complement_flag(position: Column) -> Column:
    return F.coalesce(position.contains(COMPLEMENT).cast("int"), F.lit(0))


def _span_end(position: Column, side: int) -> Column:
    reverse = F.replace(text.second(position, "("), F.lit(")"), F.lit(""))
    span = F.when(position.contains(COMPLEMENT), reverse).otherwise(text.second(position, ":"))
    end = text.before(span, "..") if side == 1 else text.second(span, "..")
    return F.coalesce(_whole_number(end), F.lit(0))


def _whole_number(digits: Column) -> Column:
    # Underscores between digits group them, as in 12_000.
    grouped = digits.contains("_") & digits.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)+\s*$")
    plain = F.when(grouped, F.replace(digits, F.lit("_"), F.lit(""))).otherwise(digits)
    return plain.try_cast("int")


def list_chromosome(position: Column) -> Column:
    """Chromosome of a gene-list position; the first rule that applies wins."""
    arm = lambda mark: text.before(position, mark)
    return (
        F.when(position.isNull(), fv.UNKNOWN)
        .when(position.contains("MT"), "MT")
        .when(position.contains("q"), arm("q"))
        .when(position.contains("p") & ~position.contains(COMPLEMENT), arm("p"))
        .when(position == "X; Y", "X;Y")
        .when(position.isin("nan", "Un", ""), fv.UNKNOWN)
        .when(position == "13cen", "13")
        .otherwise(arm(":"))
    )


def bar_chromosome(raw: Column) -> Column:
    """Chromosome or map location whose alternatives are separated by `|`."""
    return (
        F.when(raw.isin(fv.DASH, "Un"), fv.UNKNOWN)
        .when(raw.isin("X|Y", "XY"), "X;Y")
        .otherwise(F.replace(raw, F.lit("|"), F.lit(";")))
    )


def comma_chromosome(raw: Column) -> Column:
    """Chromosome whose alternatives are separated by `, `; no value means unknown."""
    known = F.replace(raw, F.lit(", "), F.lit(";"))
    return F.when(raw.isNull() | raw.isin("", "Un"), fv.UNKNOWN).otherwise(known)


def genomic_info(records: Column, field: str) -> Column:
    """Field of the first genomic-info record, NULL when there is none.

    Struct fields resolve without regard to case.
    """
    return F.get(records, F.lit(0)).getField(field)


def start_or_zero(start: Column) -> Column:
    """Missing and unset starts become 0."""
    return F.when(start == fv.UNSET_POSITION, 0).otherwise(F.coalesce(start, F.lit(0)))


def organism_tax_id(organism: Column) -> Column:
    return organism.getField("TaxID")
