"""Baskets: one row per (customer, purchase timestamp), the grain everything later is built on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import elapsed_days
from basketry.schema import FLAGS

KEY = ["CustomerID", "InvoiceDate"]


def total(column: str) -> Column:
    """Sum that is 0, not null, over no values."""
    return F.coalesce(F.sum(column), F.lit(0))


def baskets(lines: DataFrame, with_products: bool = False) -> DataFrame:
    """Clean lines to baskets, with min / max / mean / sum of the measures and the flag sums.

    One hash aggregate with map-side combine on (CustomerID, InvoiceDate): a customer with very
    many lines is spread over the whole cluster. ``with_products`` adds the number of distinct
    descriptions (null counts as one), which Spark runs as a two-phase distinct aggregate; it is
    off by default because it shuffles the descriptions.

    A basket is a home-country basket if any of its lines is.
    """
    stats = []
    for m in ("UnitPrice", "Amount", "Quantity"):
        if m != "UnitPrice":
            stats.append(total(m).cast("double").alias(f"{m}Sum"))
        stats += [
            F.min(m).cast("double").alias(f"{m}Min"),
            F.max(m).cast("double").alias(f"{m}Max"),
            F.avg(m).alias(f"{m}Mean"),
        ]
    if with_products:
        stats.append(
            (
                F.count_distinct("Description")
                + F.coalesce(F.max(F.col("Description").isNull().cast("int")), F.lit(0))
            ).alias("Product_nb")
        )
    return lines.groupBy(*KEY).agg(
        *stats, *[total(f).alias(f) for f in FLAGS], F.max("Is_UK").alias("Is_UK")
    )


def distinct_baskets(lines: DataFrame) -> DataFrame:
    return lines.select(*KEY).distinct()


def basket_timeline(baskets_: DataFrame) -> DataFrame:
    """Add ``Occurence`` (1, 2, … in time order), ``First`` (the customer's first timestamp) and
    ``Dist_first_trans`` (completed 24-hour periods since then) to every basket.

    A customer's baskets are never brought together in one task. They are counted per calendar
    day, the window over a customer sees one row per day, and its result is joined back on
    (customer, day); the rank inside a day is a window over that day only.
    """
    dated = baskets_.withColumn("Day", F.to_date("InvoiceDate"))
    days = dated.groupBy("CustomerID", "Day").agg(
        F.count(F.lit(1)).alias("_n"), F.min("InvoiceDate").alias("_first")
    )
    customer = Window.partitionBy("CustomerID")
    earlier = customer.orderBy("Day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(
        "CustomerID",
        "Day",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.first("_first").over(customer.orderBy("Day").rowsBetween(Window.unboundedPreceding, 0)).alias("First"),
    )
    within = Window.partitionBy("CustomerID", "Day").orderBy("InvoiceDate")
    return (
        dated.join(days, ["CustomerID", "Day"])
        .withColumn("Occurence", F.col("_before") + F.row_number().over(within))
        .withColumn("Dist_first_trans", elapsed_days(F.col("InvoiceDate"), F.col("First")))
        .drop("_before", "Day")
    )


def prepare_lines(lines: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """Lines with ``Occurence`` and ``Dist_first_trans`` of their basket; with ``segments``, those of the
    listed customers with their ``Label``, which the baskets carry, so that the lines are shuffled once."""
    marks = basket_timeline(distinct_baskets(lines)).select(*KEY, "Occurence", "Dist_first_trans")
    if segments is not None:
        marks = marks.join(segments.select("CustomerID", "Label"), "CustomerID")
    return lines.join(marks, KEY)


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in ``order``; reduced to one row per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
