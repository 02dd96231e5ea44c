"""Invoice lines from the star-schema tables (lineitem, orders, part, customer, nation)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def retail_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The 8-column invoice-line view (``schema.LINES``) over the parquet tables in ``folder``.

    No join hints: the optimizer broadcasts a side only when its size statistics are under the
    broadcast threshold and sort-merges otherwise.
    """

    def table(name: str, *columns: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)

    items = table(
        "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    )
    orders = table("orders", "o_orderkey", "o_custkey", "o_orderdate")
    parts = table("part", "p_partkey", "p_name")
    customers = table("customer", "c_custkey", "c_nationkey")
    nations = table("nation", "n_nationkey", "n_name")
    joined = (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    returned = F.col("l_returnflag") == "R"
    order_text = F.col("o_orderkey").cast("string")
    minutes = (F.col("o_orderkey") % 1440).cast("int")
    return joined.select(
        F.when(returned, F.concat(F.lit("C"), order_text)).otherwise(order_text).alias("InvoiceNo"),
        F.when(F.col("l_discount") >= 0.095, "D")
        .when(F.col("l_tax") >= 0.075, "POST")
        .when(F.col("l_linenumber") == 7, "M")
        .otherwise(F.concat(F.lit("p"), F.col("p_partkey").cast("string")))
        .alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int").alias("Quantity"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)).alias("InvoiceDate"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("UnitPrice"),
        F.when(F.col("o_custkey") % 50 != 7, F.col("o_custkey")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


def labelled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """``id``, ``vec`` (array of double) and ``label`` from the embeddings table."""
    return spark.read.parquet(f"{folder}/embeddings.parquet").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("vec"),
        F.col("label").cast("int").alias("label"),
    )
