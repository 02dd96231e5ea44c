"""Text expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once. A plain expression inside a lambda would be computed
    anew for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(c: Column) -> Column:
    """A-Z to lower case, every other character as it is. ``lower`` is the quick way for text
    without any other characters; elsewhere it would change more than A-Z."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower())
    )


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def hash_pair(c: Column) -> Column:
    """128 bits of a string as two independent 64-bit hashes."""
    return F.struct(F.xxhash64(c).alias("h1"), F.xxhash64(F.lit(7), c).alias("h2"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until ``df`` has no column like it: for helper columns beside the user's."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out
