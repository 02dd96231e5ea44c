"""Customer features: the first basket, and what happened within a number of days after it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import days_to_reference, elapsed_days
from basketry.operators.baskets import KEY, baskets, total
from basketry.schema import FIRST_BASKET_COLUMNS, HORIZON_COLUMNS


def attach_labels(lines: DataFrame, segments: DataFrame) -> DataFrame:
    """Left lookup of the segment by customer; null where the customer has none.

    No broadcast hint: segments have one row per customer, so the optimizer broadcasts them only
    when their measured size allows it.
    """
    return lines.join(segments.select("CustomerID", "Label"), "CustomerID", "left")


def labelled_only(lines: DataFrame, segments: DataFrame) -> DataFrame:
    return lines.join(segments.select("CustomerID", "Label"), "CustomerID")


def extract_customers(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """All lines of the listed customers."""
    return lines.join(customers.select("CustomerID").distinct(), "CustomerID", "left_semi")


def first_products(lines: DataFrame) -> DataFrame:
    """Number of distinct descriptions (null counts as one) in each customer's first basket.

    A description is in the first basket if the customer first bought it on the customer's first date, so
    three aggregates with map-side combine do: no distinct count over all baskets, no join of lines.
    """
    since = lines.groupBy("CustomerID", "Description").agg(F.min("InvoiceDate").alias("since"))
    per_date = since.groupBy("CustomerID", "since").agg(F.count(F.lit(1)).alias("n"))
    return per_date.groupBy("CustomerID").agg(F.min_by("n", "since").alias("Product_nb"))


#: Pieces of a customer's baskets, so that no task sees all of a customer with very many.
PIECES = 8
_FIRST = [c for c in FIRST_BASKET_COLUMNS if c != "Product_nb"]


def first_basket_features(lines: DataFrame) -> DataFrame:
    """One row per customer: Month, Is_UK, Product_nb and the measures of the earliest basket."""
    first = baskets(lines).groupBy("CustomerID").agg(
        F.month(F.min("InvoiceDate")).alias("Month"), *[F.min_by(c, "InvoiceDate").alias(c) for c in _FIRST]
    )
    return first.join(first_products(lines), "CustomerID").select("CustomerID", "Month", *FIRST_BASKET_COLUMNS)


def horizon_features(lines: DataFrame, horizons: Sequence[int], ref) -> DataFrame:
    """Features of every customer at every horizon, key (``horizon``, ``CustomerID``), in one pass.

    A basket goes to the first horizon that contains it, one aggregate sums up
    each (customer, first horizon), and the horizons of a customer are running totals over those few
    rows. The width of the aggregates does not depend on the number of horizons. Only amounts travel to a customer's first date,
    in ``PIECES`` pieces of a customer; the other measures are summed up over the lines of the earliest baskets only.
    """
    steps = sorted(set(horizons))
    first_date = F.min("InvoiceDate")
    # The first date is not known where a line has none: such a customer reaches no horizon.
    since = lines.groupBy("CustomerID").agg(
        first_date.alias("_first"), F.when(F.count_if(F.col("InvoiceDate").isNull()) == 0, first_date).alias("_origin")
    )
    lines = lines.where(F.col("InvoiceDate").isNotNull())
    earliest = lines.join(since.select("CustomerID", F.col("_first").alias("InvoiceDate")), KEY, "left_semi")
    first = baskets(earliest, with_products=True).select("CustomerID", *FIRST_BASKET_COLUMNS)
    amounts = lines.groupBy(*KEY).agg(total("Amount").cast("double").alias("amount"))
    piece = F.pmod(F.hash("InvoiceDate"), F.lit(PIECES))
    dated = amounts.withColumn("piece", piece).join(
        since.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1)))), ["CustomerID", "piece"]
    )
    past = reduce(add, [(elapsed_days(F.col("InvoiceDate"), F.col("_origin")) >= h).cast("int") for h in steps])
    by_piece = dated.groupBy("CustomerID", "piece", past.alias("step")).agg(
        F.min("_first").alias("_first"), F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.max("InvoiceDate").alias("last")
    )
    # At most PIECES rows per horizon of a customer from here on.
    by_step = by_piece.repartition("CustomerID").groupBy("CustomerID", "step").agg(
        F.min("_first").alias("_first"), F.sum("n").alias("n"), F.sum("amount").alias("amount"), F.max("last").alias("last")
    )
    per_customer = by_step.groupBy("CustomerID").agg(
        F.min("_first").alias("_first"),
        F.sort_array(F.collect_list(F.struct("step", "n", "amount", "last"))).alias("_steps"),  # at most one per horizon
    ).join(first, "CustomerID")
    latency = days_to_reference(F.col("_first"), ref)

    def upto(h: Column) -> Column:
        reached = F.filter("_steps", lambda s: s["step"] <= h["i"])
        upto_h = lambda name, zero: F.aggregate(reached, F.lit(zero).cast("bigint" if name == "n" else "double"), lambda sum_, s: sum_ + s[name])
        return F.struct(
            h["h"].alias("horizon"), upto_h("n", 0).alias("Frequency"), upto_h("amount", 0.0).alias("TotalAmount"),
            F.array_max(F.transform(reached, lambda s: s["last"])).alias("_last"),
        )

    wanted = F.array(*[F.struct(F.lit(h).alias("h"), F.lit(steps.index(h)).alias("i")) for h in horizons])
    rows = per_customer.select(
        "CustomerID", F.month("_first").alias("Month"), *FIRST_BASKET_COLUMNS, latency.alias("_latency"), F.inline(F.transform(wanted, upto))
    ).withColumn("Periode", F.col("_latency") - days_to_reference(F.col("_last"), ref))
    return rows.select("horizon", "CustomerID", "Month", *HORIZON_COLUMNS)


def assemble_features(features: DataFrame, customers: DataFrame) -> DataFrame:
    """Features of the listed customers, with their Label when the list carries it."""
    return features.join(customers, "CustomerID")


def unmatched_customers(features: DataFrame, customers: DataFrame) -> DataFrame:
    """Listed customers without any feature row (the error case of a strict lookup)."""
    return customers.join(features.select("CustomerID"), "CustomerID", "left_anti")


def customer_label(lines: DataFrame) -> DataFrame:
    """The segment of each customer, from labelled lines (constant per customer)."""
    return lines.groupBy("CustomerID").agg(F.max("Label").cast("int").alias("Label"))
