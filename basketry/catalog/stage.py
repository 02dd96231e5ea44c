"""The tables most registered queries start from, built on demand for one data folder."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.materialize import stored
from basketry.operators.baskets import baskets
from basketry.operators.cleaning import clean, trim_customers, trim_lines
from basketry.operators.customers import customer_table, reference_date
from basketry.schema import CLEAN_LINES, MEASURES, SEED
from basketry.sources.retail import labelled_vectors, retail_lines

HOME = "NATION_7"


class Stage:
    """Lazily derived tables; each is built at most once per query."""

    def __init__(self, spark: SparkSession, folder: str, columns: Sequence[str] = ()):
        """``columns``: what the query uses of the clean lines (all of them if empty)."""
        self.spark, self.folder, self.seed = spark, folder, SEED
        self.columns = list(dict.fromkeys([*columns, *MEASURES])) if columns else [f.name for f in CLEAN_LINES.fields]

    @cached_property
    def raw(self) -> DataFrame:
        return retail_lines(self.spark, self.folder)

    @cached_property
    def ref(self):
        return reference_date(self.raw)

    @cached_property
    def cleaned(self) -> DataFrame:
        return clean(self.raw, HOME)

    def stored_lines(self, *columns: str) -> DataFrame:
        """Some columns of the untrimmed clean lines, stored once, in files of even size."""
        return stored(self.cleaned.select(*columns).hint("rebalance"), "clean-lines")

    @cached_property
    def lines(self) -> DataFrame:
        """Limits, baskets and features read the stored columns, not the joins behind them."""
        return trim_lines(self.stored_lines(*self.columns))

    @cached_property
    def baskets(self) -> DataFrame:
        return baskets(self.lines)

    @cached_property
    def all_customers(self) -> DataFrame:
        return customer_table(self.baskets, self.ref)

    @cached_property
    def stored_customers(self) -> DataFrame:
        return stored(self.all_customers, "customers")

    @cached_property
    def customers(self) -> DataFrame:
        return trim_customers(self.stored_customers)

    @cached_property
    def segments(self) -> DataFrame:
        """Customers with the rule label used where a check must not depend on a fitted model."""
        return self.customers.withColumn("Label", (F.col("CustomerID") % 5).cast("int"))

    @cached_property
    def vectors(self) -> DataFrame:
        return labelled_vectors(self.spark, self.folder)


def tidy(df: DataFrame, digits: int = 4, **by_column: int) -> DataFrame:
    """Round double columns for comparison between engines. The small shift moves exact ties away
    from the rounding edge, where the last bit of a sum would decide."""
    rounded = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DoubleType):
            d = by_column.get(field.name, digits)
            shifted = F.col(field.name) + F.lit(10.0 ** -(d + 3))
            rounded[field.name] = F.rint(shifted * F.lit(10.0**d)) / F.lit(10.0**d) + F.lit(0.0)
    return df.withColumns(rounded) if rounded else df
