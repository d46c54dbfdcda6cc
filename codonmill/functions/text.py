"""Parts of a text around a literal mark.

`split_part` and `split` by a pattern build an array of all parts, or compile the
pattern, for every row. These do neither where they can.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RARE = "\u0001"


def before(text: Column, mark: str) -> Column:
    """Text before the first mark; all of it where there is no mark."""
    return F.substring_index(text, mark, 1)


def after_last(text: Column, mark: str) -> Column:
    """Text after the last mark; all of it where there is no mark."""
    return F.substring_index(text, mark, -1)


def before_last(text: Column, mark: str) -> Column:
    """Text before the last mark; NULL where there is no mark."""
    tail = F.length(after_last(text, mark)) + len(mark)
    return F.when(text.contains(mark), F.substr(text, F.lit(1), F.length(text) - tail))


def second(text: Column, mark: str) -> Column:
    """Text between the first mark and the next, or the end; NULL where there is no mark."""
    rest = F.substr(text, F.instr(text, mark) + len(mark))
    return F.when(text.contains(mark), before(rest, mark))


def parts(text: Column, mark: str) -> Column:
    """All parts. A mark of several characters is first made a single one, which
    splits without a pattern; a text that has that character already is not."""
    if len(mark) == 1:
        return F.split(text, "\\" + mark if mark in "|.$^()[]{}?*+" else mark)
    single = F.split(F.replace(text, F.lit(mark), F.lit(_RARE)), _RARE)
    return F.when(text.contains(_RARE), F.split(text, rf"\Q{mark}\E")).otherwise(single)
