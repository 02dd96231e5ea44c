"""Exact interpolated quantiles without a global sort.

The built-in ``percentile`` keeps every distinct value of a column in one aggregation buffer,
which cannot grow to a large table. Here one pass builds a KLL sketch per column, whose rank bounds
enclose each wanted quantile; a second pass counts the values below each bracket and keeps those inside, as
distinct values with their counts. The exact rank is then found among what was kept: by sorting it if it is
small, else by histograms of the kept table, which narrow the bracket round by round. The input is read twice.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.materialize import stored

SKETCH_K = 2_000
#: Several times the rank error of a sketch of that size, as a share of the rows.
RANK_MARGIN = 0.005
BINS = 4_096
#: Distinct values that are sorted on the driver.
SORTED_VALUES = 100_000


@dataclass
class _Target:
    """One quantile: the ranks of its two neighbours among the values from ``lo`` to ``hi``."""

    column: str
    p: float
    low: int
    high: int
    share: float
    lo: float
    hi: float

    def value(self, low: float, high: float) -> float:
        return low if low == high else low + (high - low) * self.share


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], margin: float = RANK_MARGIN, bins: int = BINS, sorted_values: int = SORTED_VALUES
) -> dict[tuple[str, float], float | None]:
    """``{(column, p): value}`` with linear interpolation between neighbouring order statistics.

    Nulls and NaN are left out; a column without other values gives None.
    """
    columns = list(wanted)
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    targets, result = _brackets(values, wanted, margin)
    if targets:
        kept = _kept(values, targets)
        found = _found(kept, targets, bins, sorted_values)
        missed = [t for i, t in enumerate(targets) if found[i] is None]
        if missed:  # a sketch beyond its error bound: take the whole range
            ends = values.agg(*[f(t.column).alias(f"{k}{i}") for i, t in enumerate(missed) for k, f in (("lo", F.min), ("hi", F.max))]).first()
            for i, t in enumerate(missed):
                t.lo, t.hi = ends[f"lo{i}"], ends[f"hi{i}"]
            again = _found(_kept(values, missed), missed, bins, sorted_values)
            found.update({targets.index(t): again[i] for i, t in enumerate(missed)})
        result |= {(t.column, t.p): found[i] for i, t in enumerate(targets)}
    return result


def _brackets(values: DataFrame, wanted: Mapping[str, Sequence[float]], margin: float) -> tuple[list[_Target], dict]:
    """The first pass: a range of values for every quantile; those that are decided by it go to the result."""
    parts = []
    for i, c in enumerate(wanted):
        parts += [F.count(c).alias(f"n_{i}"), F.min(c).alias(f"lo_{i}"), F.max(c).alias(f"hi_{i}"), F.kll_sketch_agg_double(c, SKETCH_K).alias(f"s_{i}")]
    ends = values.agg(*parts)
    bounds = []
    for i, c in enumerate(wanted):
        for j, p in enumerate(wanted[c]):
            for side, rank in (("b", p - margin), ("t", p + margin)):
                if 0 < rank < 1:
                    bounds.append(F.when(F.col(f"n_{i}") > 0, F.kll_sketch_get_quantile_double(f"s_{i}", F.lit(float(rank)))).alias(f"{side}_{i}_{j}"))
    row = ends.select(*[f"{k}_{i}" for i in range(len(wanted)) for k in ("n", "lo", "hi")], *bounds).first().asDict()
    targets, result = [], {}
    for i, c in enumerate(wanted):
        n, lo, hi = row[f"n_{i}"], row[f"lo_{i}"], row[f"hi_{i}"]
        for j, p in enumerate(wanted[c]):
            if not n or lo == hi:
                result[c, p] = lo if n else None
                continue
            at = (n - 1) * p
            targets.append(_Target(c, p, floor(at), ceil(at), at - floor(at), row.get(f"b_{i}_{j}", lo), row.get(f"t_{i}_{j}", hi)))
    return targets, result


def _kept(values: DataFrame, targets: list[_Target]) -> DataFrame:
    """The second pass: ``target, x, n`` for the distinct values inside each bracket; a null ``x`` counts those below it."""
    entries = []
    for i, t in enumerate(targets):
        x = F.col(t.column)
        inside = F.when(x >= F.lit(t.lo), x)
        entries.append(F.when(x <= F.lit(t.hi), F.struct(F.lit(i).alias("target"), inside.alias("x"))))
    rows = values.select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    return stored(rows.groupBy("target", "x").agg(F.count(F.lit(1)).alias("n")), "bracket")


def _found(kept: DataFrame, targets: list[_Target], bins: int, sorted_values: int) -> dict[int, float | None]:
    """The quantiles from what the brackets kept; None where a bracket does not hold its ranks."""
    sums = kept.groupBy("target").agg(
        F.coalesce(F.sum(F.when(F.col("x").isNull(), F.col("n"))), F.lit(0)).alias("below"),
        F.coalesce(F.sum(F.when(F.col("x").isNotNull(), F.col("n"))), F.lit(0)).alias("inside"), F.count("x").alias("distinct"),
    ).collect()  # one row per target
    sizes = {r["target"]: r for r in sums}
    out: dict[int, float | None] = {}
    small, large = [], []
    for i, t in enumerate(targets):
        r = sizes.get(i)
        if r is None or t.low < r["below"] or t.high >= r["below"] + r["inside"]:
            out[i] = None
            continue
        t.low, t.high = t.low - r["below"], t.high - r["below"]
        (small if r["distinct"] <= sorted_values // len(targets) else large).append(i)
    while large:
        large = [i for i in large if (got := _narrowed(kept, targets[i], i, bins)) is None or out.update({i: got})]
    if small:
        rows: dict[int, list] = {i: [] for i in small}
        for r in kept.where(F.col("target").isin(small) & F.col("x").isNotNull()).collect():  # bounded by sorted_values
            rows[r["target"]].append((r["x"], r["n"]))
        for i, own in rows.items():
            own.sort()
            upto = list(accumulate(n for _, n in own))
            low, high = (own[bisect_right(upto, rank)][0] for rank in (targets[i].low, targets[i].high))
            out[i] = targets[i].value(low, high)
    return out


def _bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """The number of the bin, rising with ``x``; infinite values have bins of their own."""
    inside = F.floor((x / 2 - F.lit(lo) / 2) / (F.lit(hi) / 2 - F.lit(lo) / 2) * bins)
    return (
        F.when(x == F.lit(float("-inf")), F.lit(-1)).when(x == F.lit(float("inf")), F.lit(bins))
        .otherwise(F.least(inside, F.lit(bins - 1))).cast("int")
    )


def _narrowed(kept: DataFrame, t: _Target, number: int, bins: int) -> float | None:
    """One histogram round over the kept values of a target: the quantile if the ranks fall into bins of one value or
    into different bins, else a narrower range for the next round. Both ends of a range are in different
    bins, so every round leaves a smaller range and the search always ends."""
    if t.lo == t.hi:
        return t.lo
    x = F.col("x")
    # Infinite ends say nothing about the width of a bin.
    low_end, high_end = max(t.lo, -1.7e308), min(t.hi, 1.7e308)
    inside = kept.where((F.col("target") == number) & x.between(F.lit(t.lo), F.lit(t.hi)))
    counted = inside.groupBy(_bin(x, low_end, high_end, bins).alias("bin")).agg(F.sum("n").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    counted = counted.withColumn("before", F.sum("n").over(Window.orderBy("bin")) - F.col("n"))  # at most bins + 2 rows
    hit = lambda rank: (F.col("before") <= rank) & (F.col("before") + F.col("n") > rank)
    rows = sorted(counted.where(hit(t.low) | hit(t.high)).collect(), key=lambda r: r["bin"])
    if len(rows) == 2:
        return t.value(rows[0]["hi"], rows[1]["lo"])
    only = rows[0]
    if only["lo"] == only["hi"]:
        return only["lo"]
    t.low, t.high, t.lo, t.hi = t.low - only["before"], t.high - only["before"], only["lo"], only["hi"]
    return None
