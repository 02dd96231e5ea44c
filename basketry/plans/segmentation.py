"""Raw lines to clean lines and labelled customers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from basketry.materialize import checkpointed, stored
from basketry.operators.baskets import baskets
from basketry.operators.cleaning import HOME_COUNTRY, clean, trim_customers, trim_lines
from basketry.operators.clustering import Segmentation, segment
from basketry.operators.customers import customer_table, reference_date
from basketry.schema import SEED


@dataclass
class SegmentedCustomers:
    lines: DataFrame
    segmentation: Segmentation

    @property
    def customers(self) -> DataFrame:
        return self.segmentation.customers


def kept_customers(lines: DataFrame, ref) -> DataFrame:
    """The customer table below its own limits. It is stored once, because the limits, the
    clustering and the profiles all read it."""
    return trim_customers(checkpointed(customer_table(baskets(lines), ref)))


def segment_customers(
    raw: DataFrame, ref=None, home: str = HOME_COUNTRY, k: int = 5, restarts: int = 300,
    seed: int = SEED, max_iter: int = 100,
) -> SegmentedCustomers:
    """Clean, trim, build the customer table and cluster it. ``ref`` defaults to the last day of
    the raw lines. The clean lines are stored once: limits, baskets and sinks read them from there."""
    lines = trim_lines(stored(clean(raw, home).hint("rebalance"), "clean-lines"))
    customers = kept_customers(lines, reference_date(raw) if ref is None else ref)
    return SegmentedCustomers(lines, segment(customers, k=k, restarts=restarts, seed=seed, max_iter=max_iter))
