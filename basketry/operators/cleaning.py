"""Line cleaning: filters, recoding, derived columns and the 99th-percentile trim.

Everything here is narrow (no shuffle), so the filters and the column pruning reach the scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import code_flag, year_month
from basketry.operators.quantiles import exact_quantiles
from basketry.schema import MEASURES

HOME_COUNTRY = "United Kingdom"


def known_customers(lines: DataFrame) -> DataFrame:
    return lines.na.drop(subset=["CustomerID"])


def rescue_discounts(lines: DataFrame) -> DataFrame:
    """Mark the credits of discount lines (code exactly ``D``) with D instead of C, so that
    dropping cancellations keeps them. Runs before the codes are upper-cased."""
    return lines.withColumn(
        "InvoiceNo",
        F.when(F.col("StockCode") == "D", F.replace("InvoiceNo", F.lit("C"), F.lit("D"))).otherwise(
            F.col("InvoiceNo")
        ),
    )


def drop_cancelled(lines: DataFrame) -> DataFrame:
    """Drop invoices that start with c or C; a null invoice number is not a cancellation."""
    return lines.where(~F.coalesce(F.lower("InvoiceNo").startswith("c"), F.lit(False)))


def upper_codes(lines: DataFrame) -> DataFrame:
    return lines.withColumn("StockCode", F.upper(F.col("StockCode").cast("string")))


def cast_integers(lines: DataFrame) -> DataFrame:
    return lines.withColumns(
        {"Quantity": F.col("Quantity").try_cast("int"), "CustomerID": F.col("CustomerID").try_cast("bigint")}
    )


def add_amount(lines: DataFrame) -> DataFrame:
    return lines.withColumn("Amount", F.col("Quantity") * F.col("UnitPrice"))


def add_line_flags(lines: DataFrame) -> DataFrame:
    code = F.col("StockCode")
    return lines.withColumns(
        {"Discount": code_flag(code, "D"), "POST": code_flag(code, "POST"), "Manual": code_flag(code, "M")}
    )


def add_home_flag(lines: DataFrame, home: str = HOME_COUNTRY) -> DataFrame:
    return lines.withColumn("Is_UK", F.when(F.col("Country") == home, 1).otherwise(0))


def add_year_month(lines: DataFrame) -> DataFrame:
    return lines.withColumn("Year_Month", year_month(F.col("InvoiceDate")))


def clean(lines: DataFrame, home: str = HOME_COUNTRY) -> DataFrame:
    """Raw lines to clean lines (``schema.CLEAN_LINES``), before the percentile trim."""
    steps = (known_customers, rescue_discounts, drop_cancelled, upper_codes, cast_integers,
             add_amount, add_line_flags)
    for step in steps:
        lines = step(lines)
    return add_year_month(add_home_flag(lines, home))


def percentile_limits(df: DataFrame, columns: list[str], p: float = 0.99) -> dict[str, float | None]:
    """Exact limits of several columns, all from the same untrimmed rows."""
    found = exact_quantiles(df, {c: [p] for c in columns})
    return {c: found[c, p] for c in columns}


def below_limits(df: DataFrame, limits: Mapping[str, float | None]) -> DataFrame:
    """Rows strictly below every limit. No limit (an all-null column) keeps no row."""
    for column, limit in limits.items():
        df = df.where(F.col(column) < F.lit(limit).cast("double"))
    return df


def trim_lines(lines: DataFrame, p: float = 0.99) -> DataFrame:
    return below_limits(lines, percentile_limits(lines, MEASURES, p))


def trim_customers(customers: DataFrame, p: float = 0.99) -> DataFrame:
    return below_limits(customers, percentile_limits(customers, ["Frequency", "Amount"], p))


def positive_quantities(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("Quantity") > 0)
