"""Table schemas and the column lists shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

LINES = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampNTZType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.LongType()),
        T.StructField("Country", T.StringType()),
    ]
)

CLEAN_LINES = T.StructType(
    LINES.fields
    + [
        T.StructField("Amount", T.DoubleType()),
        T.StructField("Discount", T.IntegerType()),
        T.StructField("POST", T.IntegerType()),
        T.StructField("Manual", T.IntegerType()),
        T.StructField("Is_UK", T.IntegerType()),
        T.StructField("Year_Month", T.StringType()),
    ]
)

PREPARED_LINES = T.StructType(
    CLEAN_LINES.fields
    + [
        T.StructField("Label", T.IntegerType()),
        T.StructField("Occurence", T.LongType()),
        T.StructField("Dist_first_trans", T.IntegerType()),
    ]
)

MEASURES = ["Amount", "Quantity", "UnitPrice"]
FLAGS = ["Discount", "POST", "Manual"]

# The column lists of the published analysis.
CLUSTER_COLUMNS = ["Frequency", "Amount", "Recency", "Latency", "Amount_first", "Is_UK"]
SUMMARY_COLUMNS = ["Frequency", "Amount", "Amount_first", "Recency", "Latency"]
CORE_COLUMNS = ["Recency", "Frequency", "Amount", "Latency", "Amount_first", "MTBT"]
PAIR_COLUMNS = ["Recency", "Frequency", "Amount", "Latency", "Amount_first"]
BASKET_MEANS = [f"{m}{s}" for m in ("Quantity", "UnitPrice", "Amount") for s in ("Min", "Max", "Mean")]
CUSTOMER_NUMERIC = [
    "Recency", "Is_UK", "Amount", "Amount_first", "Frequency", "Latency", "MTBT", "Amount_mean",
    *BASKET_MEANS,
    "Discount", "POST", "Manual",
]
CUSTOMERS = T.StructType(
    [T.StructField("CustomerID", T.LongType()), T.StructField("InvoiceDate", T.TimestampNTZType())]
    + [
        T.StructField(
            name,
            T.IntegerType() if name in ("Recency", "Is_UK", "Latency")
            else T.LongType() if name in ("Frequency", "Discount", "POST", "Manual")
            else T.DoubleType(),
        )
        for name in CUSTOMER_NUMERIC
    ]
    + [T.StructField("Label", T.IntegerType())]
)

FIRST_BASKET_COLUMNS = [
    "Is_UK", "Product_nb",
    "UnitPriceMin", "UnitPriceMax", "UnitPriceMean",
    "AmountSum", "AmountMin", "AmountMax", "AmountMean",
    "QuantitySum", "QuantityMin", "QuantityMax", "QuantityMean",
    "Discount", "Manual", "POST",
]
HORIZON_COLUMNS = [*FIRST_BASKET_COLUMNS, "Frequency", "Periode", "TotalAmount"]
MONTH_COLUMNS = [f"Month_{m}" for m in range(1, 13)]
HORIZONS = list(range(30, 361, 30))
SEED = 42
