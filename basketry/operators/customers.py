"""The customer table: recency, latency, frequency, monetary value and basket means."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import days_to_reference, mean_gap
from basketry.operators.baskets import total
from basketry.schema import BASKET_MEANS, CUSTOMER_NUMERIC, FLAGS


def reference_date(lines: DataFrame):
    """Default reference: the day of the last line, as a scalar subquery column."""
    return lines.agg(F.to_date(F.max("InvoiceDate")).alias("ref")).scalar()


def customer_table(baskets_: DataFrame, ref) -> DataFrame:
    """One row per customer from one hash aggregate over the baskets.

    Every aggregate has a fixed-width buffer (first and last values come from ``min_by`` /
    ``max_by`` on the timestamp), so there is map-side combine and no sort.
    """
    last, first = F.max("InvoiceDate"), F.min("InvoiceDate")
    per_customer = baskets_.groupBy("CustomerID").agg(
        last.alias("InvoiceDate"),
        first.alias("_first"),
        F.max_by("Is_UK", "InvoiceDate").alias("Is_UK"),
        total("AmountSum").alias("Amount"),
        F.min_by("AmountSum", "InvoiceDate").alias("Amount_first"),
        F.count(F.lit(1)).alias("Frequency"),
        *[F.avg(c).alias(c) for c in BASKET_MEANS],
        *[total(f).alias(f) for f in FLAGS],
    )
    dated = per_customer.withColumns(
        {
            "Recency": days_to_reference(F.col("InvoiceDate"), ref),
            "Latency": days_to_reference(F.col("_first"), ref),
        }
    )
    return dated.withColumns(
        {
            "MTBT": mean_gap(F.col("Latency"), F.col("Recency"), F.col("Frequency")),
            "Amount_mean": F.try_divide("Amount", "Frequency"),
        }
    ).select("CustomerID", "InvoiceDate", *CUSTOMER_NUMERIC)
