"""Where a pattern matches, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:bigint,end:bigint,found:string,value:string>>"


def spans(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches of ``pattern``: start and end in code points (end
    exclusive), the match, and one group of it. Text between the matches and the matches
    themselves alternate, so positions are running sums of their lengths."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    parts = F.arrays_zip(between.alias("b"), found.alias("f"), value.alias("v"))

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["b"])
        end = start + F.length(part["f"])
        one = F.struct(start.alias("start"), end.alias("end"), part["f"].alias("found"), part["v"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))
    walked = F.aggregate(parts, start, step, lambda done: done["out"])
    return F.when(text.rlike(pattern), walked).otherwise(none)
