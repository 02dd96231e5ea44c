"""Descriptive statistics of lines, baskets and customers."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import bin_number
from basketry.materialize import checkpointed
from basketry.operators.baskets import KEY, total
from basketry.operators.ordered import running_total
from basketry.operators.quantiles import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def rows_of(df: DataFrame, entries: list[Column]) -> DataFrame:
    """Turn a one-row aggregate into one row per struct in ``entries``."""
    return df.select(F.inline(F.array(*entries)))


def null_counts(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return rows_of(
        counts, [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max; one row per column."""
    quartiles = exact_quantiles(df, {c: QUARTILES for c in columns})
    parts, entries = [], []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        measures = {"count": F.count(x), "mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x)}
        parts += [m.alias(f"{k}_{i}") for k, m in measures.items()]
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                *[F.col(f"{k}_{i}").alias(k) for k in ("count", "mean", "std", "min")],
                *[F.lit(quartiles[c, q]).cast("double").alias(f"p{round(q * 100)}") for q in QUARTILES],
                F.col(f"max_{i}").alias("max"),
            )
        )
    return rows_of(df.agg(*parts), entries)


def quantile_table(df: DataFrame, columns: list[str], p: float = 0.99) -> DataFrame:
    """One row per column with its exact quantile."""
    found = exact_quantiles(df, {c: [p] for c in columns})
    return rows_of(
        df.sparkSession.range(1),
        [
            F.struct(F.lit(c).alias("column"), F.lit(found[c, p]).cast("double").alias("quantile"))
            for c in columns
        ],
    )


def basket_sums(lines: DataFrame, measure: str) -> DataFrame:
    return lines.groupBy(*KEY).agg(total(measure).alias(measure))


def revenue_by_month(lines: DataFrame) -> DataFrame:
    months = lines.groupBy("Year_Month").agg(total("Amount").alias("Amount"))
    part = F.split("Year_Month", "_")
    return months.withColumns({"Year": part[0].cast("int"), "Month": part[1].cast("int")}).orderBy(
        "Year", "Month"
    )


def revenue_total(lines: DataFrame) -> DataFrame:
    return lines.agg(total("Amount").alias("Revenue"))


def revenue_share(lines: DataFrame, by: str = "Country") -> DataFrame:
    """Revenue per group and its share of the total in percent (one decimal), largest first."""
    groups = checkpointed(lines.groupBy(by).agg(total("Amount").alias("Amount")))
    whole = groups.agg(F.sum("Amount").alias("all")).scalar()
    share = F.round(F.try_divide("Amount", whole), 3) * 100
    return groups.withColumn("Share", share).orderBy(F.desc("Amount"), by)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values, null counting as one."""
    has_null = F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))
    return df.agg((F.count_distinct(column) + has_null).alias("n"))


def ranges(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest value of each column, in one pass; all-null columns are left out."""
    found = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(c).cast("double")).alias(f"hi_{i}") for i, c in enumerate(columns)],
    ).first()
    return {
        c: (found[f"lo_{i}"], found[f"hi_{i}"])
        for i, c in enumerate(columns)
        if found[f"lo_{i}"] is not None
    }


def histogram(df: DataFrame, bins: dict[str, int]) -> DataFrame:
    """Equal-width bin counts (``column``, ``bin``, ``n``) of several columns; empty bins have no row."""
    spans = ranges(df, list(bins))
    entries = [
        F.struct(F.lit(c).alias("column"), bin_number(F.col(c), *spans[c], bins[c]).alias("bin"))
        for c in spans
    ]
    return (
        df.select(F.inline(F.array(*entries)))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair (``a``, ``b``, ``r``), each over the rows where both are
    present; a constant column gives null.

    Five sums per pair are products of the matrix of values, its squares and its mask of present values: one product per batch, one
    small array per task, whatever the number of rows. Values are taken from their column's mean, which keeps the sums
    exact enough to be subtracted.
    """
    d = len(columns)
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    centre = rows.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in rows.columns]).first()
    shift = np.array([centre[c] if np.isfinite(centre[c]) else 0.0 for c in rows.columns])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros((4, d, d))
        with np.errstate(invalid="ignore", over="ignore"):
            for batch in batches:
                there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], 1).astype(float)
                x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns], 1) - shift
                x[there == 0] = 0.0
                whole += np.stack([there.T @ there, x.T @ there, (x**2).T @ there, x.T @ x])
        yield pa.RecordBatch.from_arrays([pa.array([whole.ravel()], pa.list_(pa.float64()))], ["sums"])

    found = rows.mapInArrow(sums, "sums array<double>").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")).first()["sums"]
    table = []
    n, first, square, product = np.array(found if found else [0.0] * (4 * d * d)).reshape(4, d, d)
    for i, j in combinations(range(d), 2):
        table.append((columns[i], columns[j], _pearson(n[i, j], first[i, j], first[j, i], square[i, j], square[j, i], product[i, j])))
    return df.sparkSession.createDataFrame(table, "a string, b string, r double")


def _pearson(n: float, x: float, y: float, xx: float, yy: float, xy: float) -> float | None:
    """From sums over the rows of a pair. A spread that rounding alone could make counts as none."""
    if n < 2 or not np.isfinite([x, y, xx, yy, xy]).all():
        return None
    vx, vy = xx - x * x / n, yy - y * y / n
    if vx <= 1e-13 * xx or vy <= 1e-13 * yy:
        return None
    return float((xy - x * y / n) / np.sqrt(vx * vy))


def pair_density(df: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """Two-dimensional bin counts of every column pair (the diagonal is the plain histogram)."""
    spans = ranges(df, columns)
    binned = df.select(*[bin_number(F.col(c), *spans[c], bins).alias(c) for c in spans])
    entries = [
        F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("bin_a"), F.col(b).alias("bin_b")
        )
        for a, b in combinations_with_replacement(list(spans), 2)
    ]
    return (
        binned.groupBy(*spans)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_n", F.inline(F.array(*entries)))
        .groupBy("a", "b", "bin_a", "bin_b")
        .agg(F.sum("_n").alias("n"))
    )


def pareto(lines: DataFrame, key: str) -> DataFrame:
    """Concentration curve: keys by revenue, largest first, with the cumulated share of keys and
    of revenue in percent (one decimal)."""
    revenue = lines.groupBy(key).agg(total("Amount").alias("Amount"))
    ranked = running_total(revenue, [F.desc("Amount"), F.asc(key)], "Amount")
    ends = ranked.agg(
        F.struct(F.max("position").alias("last"), F.sum("Amount").alias("revenue")).alias("e")
    ).scalar()
    return ranked.select(
        key,
        "Amount",
        F.round(F.coalesce(F.try_divide(F.col("position"), ends["last"]), F.lit(0.0)) * 100, 1).alias("Keys_pct"),
        F.round(F.try_divide("running", ends["revenue"]) * 100, 1).alias("Revenue_pct"),
    )


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def special_codes(lines: DataFrame, n: int = 7) -> DataFrame:
    """The last distinct (stock code, description) pairs in code order: the fee codes."""
    return (
        lines.select("StockCode", "Description")
        .distinct()
        .orderBy(F.desc("StockCode"), F.desc("Description"))
        .limit(n)
    )
