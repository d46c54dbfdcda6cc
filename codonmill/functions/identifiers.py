"""Rewrites that give all sources the same identifier spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.functions import text


def rewrite(col: Column, pairs: list[tuple[str, str]]) -> Column:
    """Replace every occurrence of each literal text, pair after pair."""
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def prefixed(prefix: str, col: Column) -> Column:
    return F.concat(F.lit(prefix), col.cast("string"))


def pathway_class(pathway_id: Column) -> Column:
    """Kind of pathway map, from the leading digits of a `P…` identifier."""
    digits = F.regexp_replace(pathway_id, "^P", "")
    label = F.when(digits.isNull(), F.lit(None).cast("string"))
    for lead, name in fv.PATHWAY_CLASSES.items():
        label = label.when(digits.startswith(lead), name)
    return label.otherwise(fv.PATHWAY_CLASS_DEFAULT)


def variant_id(raw_id: Column) -> Column:
    """`V` + the text before the last `v`; NULL where there is no `v`."""
    return F.concat(F.lit(fv.VARIANT_PREFIX), text.before_last(raw_id, "v"))


def variant_version(raw_id: Column) -> Column:
    """Text after the last `v`; NULL where there is no `v`."""
    return F.when(raw_id.contains("v"), text.after_last(raw_id, "v"))
