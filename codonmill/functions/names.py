"""Names, symbols and other text that packs several values into one field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.functions import text


# --- gene list: "SYM1, SYM2; full name" ------------------------------------


def gene_name(packed: Column) -> Column:
    """Second `;` part, untrimmed; the whole text where there is no `;`."""
    return F.coalesce(text.second(packed, ";"), packed)


def gene_symbols(packed: Column) -> Column:
    """Symbols before the first `;`; a fixed marker where there is no `;`."""
    named = text.parts(text.before(packed, ";"), ", ")
    return F.when(packed.contains(";"), named).when(
        packed.isNotNull(), F.array(F.lit(fv.NO_SYMBOL))
    )


def disease_names(packed: Column) -> Column:
    return text.parts(packed, "; ")


def module_names(packed: Column) -> Column:
    """Names in a module title: the part after the last comma is dropped and
    bracketed names count as names of their own."""
    title = F.coalesce(text.before_last(packed, ","), packed)
    opened = F.replace(title, F.lit(" ("), F.lit(","))
    closed = F.replace(opened, F.lit(")"), F.lit(""))
    return F.coalesce(text.parts(closed, ","), F.array(F.lit(None).cast("string")))


# --- gene annotation: "a|b|c", "db:id", "category:feature" -----------------


def bar_values(packed: Column) -> Column:
    """Values of a `|` list; a lone dash stands for none."""
    return text.parts(F.when(packed == fv.DASH, fv.DASH_PLACEHOLDER).otherwise(packed), "|")


def feature_name(item: Column) -> Column:
    return text.second(item, ":")


def gene_type(raw: Column) -> Column:
    label = raw
    for word, standard in fv.GENE_TYPES.items():
        label = F.when(raw == word, standard).otherwise(label)
    return label


def flag(raw: Column, yes: str) -> Column:
    return F.coalesce((raw == yes).cast("int"), F.lit(0))


def approved_symbol(authority: Column, symbol: Column) -> Column:
    """Symbol of the naming authority, else the plain one, else NULL."""
    return unless(F.when(authority == fv.DASH, symbol).otherwise(authority), fv.DASH)


def unless(raw: Column, sentinel: str) -> Column:
    """NULL in place of the sentinel.

    Not `nullif`: each use of that gets a generated name in the plan, and two
    otherwise equal exchanges are then not recognised as one.
    """
    return F.when(raw != sentinel, raw)


# --- summary records -------------------------------------------------------


def comma_space_values(packed: Column) -> Column:
    return text.parts(packed, ", ")


def is_other_name(name: Column, symbol: Column) -> Column:
    """True where the record's name is not its official symbol, mitochondrial
    `MT-` marks aside. A missing symbol decides nothing, a missing name differs."""
    plain = F.replace(symbol, F.lit("MT-"), F.lit(""))
    return symbol.isNotNull() & ~name.eqNullSafe(plain)


def comma_values(packed: Column) -> Column:
    return text.parts(packed, ",")


def literal_gene_ids(literal: Column) -> Column:
    """Gene ids of a list of records written as Python literals.

    Bare words of that language, outside quotes, become those of JSON.
    """
    spelled = literal
    for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
        until = (
            r"""\G((?:[^'"\w]|'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+"|\b(?!WORD\b)\w++)*+)\bWORD\b"""
        ).replace("WORD", word)
        spelled = F.when(
            literal.contains(word), F.regexp_replace(spelled, until, f"$1{json_word}")
        ).otherwise(spelled)
    records = F.from_json(
        spelled,
        "array<struct<NAME:string,GENE_ID:string>>",
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"},
    )
    return F.transform(records, lambda record: record["GENE_ID"])


def keyed_value(packed: Column, key: str) -> Column:
    """Value of the last `key=value` item of a `|` list, up to a further `=`.

    NULL where the key is absent or its last item has no `=`.
    """
    framed = F.concat(F.lit("|"), packed, F.lit("|"))
    item = f"|{key}="
    rest = text.after_last(framed, item)
    found = framed.contains(item) & ~rest.contains(f"|{key}|")
    return F.when(found, text.before(text.before(rest, "|"), "="))
