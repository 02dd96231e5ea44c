"""Column expressions used by more than one operator. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_flag(code: Column, value: str) -> Column:
    """1 where the stock code equals ``value``, else 0; a null code gives 0."""
    return F.when(code == value, 1).otherwise(0)


def year_month(ts: Column) -> Column:
    """``"2011_3"``: year and unpadded month, free of the session time zone."""
    return F.concat_ws("_", F.year(ts), F.month(ts))


def days_to_reference(ts: Column, ref) -> Column:
    """Absolute calendar days between a timestamp and the reference date (a midnight)."""
    return F.abs(F.datediff(F.to_date(ts), ref if isinstance(ref, Column) else F.lit(ref)))


def elapsed_days(ts: Column, first: Column) -> Column:
    """Completed 24-hour periods from ``first`` to ``ts``."""
    return F.extract(F.lit("DAY"), ts - first)


def mean_gap(latency: Column, recency: Column, frequency: Column) -> Column:
    """Mean time between purchases; values whose whole part is 0 become 0."""
    gap = F.try_divide((latency - recency).cast("double"), frequency)
    return F.when(F.abs(gap) < 1, F.lit(0.0)).otherwise(gap)


def standardised(col: Column, mean: float, std: float) -> Column:
    """(x - mean) / std, and 0 for a constant column."""
    if not std:
        return F.when(col.isNotNull(), F.lit(0.0))
    return (col.cast("double") - F.lit(mean)) / F.lit(std)


def draw_key(seed: int, *ids: str) -> Column:
    """A reproducible pseudo-random text key per row: md5 of ``seed:id``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]))


def draw_uniform(seed: int, *ids: str) -> Column:
    """A reproducible uniform number in [0, 1) per row, from the first 8 hex digits of the key."""
    return F.conv(F.substring(draw_key(seed, *ids), 1, 8), 16, 10).cast("double") / F.lit(float(16**8))


def bin_number(col: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin 0..bins-1 over [lo, hi]; the last bin is closed."""
    x = col.cast("double")
    if hi == lo:
        return F.when(x.isNotNull(), F.lit(0))
    raw = F.floor((x - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)).cast("int")
    return F.least(raw, F.lit(bins - 1))


# Up to this length arithmetic over an array is written out term by term, which compiles into one
# generated loop body; longer arrays use a higher-order function, whose plan stays small.
UNROLLED_DIMS = 16


def _fold(vec: Column, point: Sequence[float], term: Callable[[Column, Column], Column]) -> Column:
    if len(point) <= UNROLLED_DIMS:
        return reduce(add, [term(vec[i], F.lit(float(p))) for i, p in enumerate(point)])
    terms = F.zip_with(vec, F.lit([float(p) for p in point]), term)
    return F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)


def squared_distance(vec: Column, point: Sequence[float]) -> Column:
    """Squared Euclidean distance from an array column to a fixed point."""
    return _fold(vec, point, lambda x, p: (x - p) * (x - p))


def manhattan_distance(vec: Column, point: Sequence[float]) -> Column:
    return _fold(vec, point, lambda x, p: F.abs(x - p))


def dot(vec: Column, weights: Sequence[float]) -> Column:
    return _fold(vec, weights, lambda x, w: x * w)


def squared_norm(vec: Column) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda total, x: total + x * x)


def majority(votes: Column) -> Column:
    """The most frequent element of an array column; a tie goes to the smallest."""
    tally = F.transform(
        F.array_distinct(votes),
        lambda v: F.struct(F.size(F.filter(votes, lambda o: o == v)).alias("n"), (-v).alias("low")),
    )
    return -F.array_max(tally)["low"]
