"""Exact ranks and running totals over large groups, in two steps.

A window that orders a whole table (or a group holding a large share of it) runs in one task.
Both helpers cut the order into pieces, total the pieces, and add what came before each piece to
a window that only sees one piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import draw_key
from basketry.materialize import checkpointed


def bucketed_row_number(
    df: DataFrame, group: list[str], bucket: Column, order: list, name: str = "rank"
) -> DataFrame:
    """``row_number() over (partition by group order by order)`` for a ``bucket`` expression that
    is monotone in the order. The window over a group sees one row per bucket."""
    cut = df.withColumn("_bucket", bucket)
    keys = [*group, "_bucket"]
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        cut.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy(*keys).orderBy(*order)
    return (
        cut.join(before, keys)
        .withColumn(name, F.col("_before") + F.row_number().over(within))
        .drop("_bucket", "_before")
    )


def random_rank(df: DataFrame, id_col: str, seed: int, group: list[str] | None = None) -> DataFrame:
    """Add ``rank``: the position of each row in a reproducible random order of its group.

    The order is the md5 text of ``seed:id``; its first three hex digits cut every group into
    4,096 even buckets.
    """
    keyed = df.withColumn("_key", draw_key(seed, id_col))
    bucket = F.substring("_key", 1, 3)
    return bucketed_row_number(keyed, group or [], bucket, ["_key", id_col]).drop("_key")


def running_total(df: DataFrame, order: list[Column], value: str) -> DataFrame:
    """Add ``position`` (0-based) and ``running`` (sum of ``value`` up to and including the row)
    in a global order.

    The rows are range-partitioned on the full order, ties included, and stored once, so that the
    piece totals and the piece windows see the same pieces. The table joined back has one row per
    range partition.
    """
    spark = df.sparkSession
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpointed(
        df.repartitionByRange(pieces, *order).withColumn("_piece", F.spark_partition_id())
    )
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy("_piece")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_v"))
        .select(
            "_piece",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_v").over(earlier), F.lit(0.0)).alias("_value_before"),
        )
    )
    within = Window.partitionBy("_piece").orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(before), "_piece")
        .withColumn("position", F.col("_rows_before") + F.row_number().over(within) - 1)
        .withColumn("running", F.col("_value_before") + F.sum(value).over(upto))
        .drop("_piece", "_rows_before", "_value_before")
    )
