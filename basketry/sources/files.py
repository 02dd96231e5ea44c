"""Reading and writing the line and customer tables as parquet or CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
CSV = {"header": True, "sep": ",", "encoding": "utf-8", "quote": '"', "escape": '"'}
BROKEN = "_broken_row"
INDEX_COLUMNS = ("Unnamed: 0", "")


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", allow_malformed: bool = False, multi_line: bool = False
) -> DataFrame:
    """Read with a declared schema; nothing is inferred.

    CSV columns are found by their names in the header, in any order; others, such as a saved row number, are left out.
    A missing column raises. So do, in one counting pass, rows with a wrong number of fields and values that do not fit their
    type, unless ``allow_malformed`` makes them null. Whole numbers may be written as ``17850.0``. ``multi_line`` reads
    line breaks inside quotes, at the price of files that cannot be split.
    """
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    options = CSV | {"multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*header, BROKEN]])
    # Every file must repeat the header, which cannot be checked where a column has no name.
    unnamed = any(c == f"_c{i}" for i, c in enumerate(header))
    rows = spark.read.schema(text).options(**options, enforceSchema=unnamed, columnNameOfCorruptRecord=BROKEN).csv(path)
    if not allow_malformed:
        bad = [F.count_if(_value(f).isNull() & F.col(f.name).isNotNull()).alias(f.name) for f in schema.fields]
        counts = rows.agg(F.count_if(F.col(BROKEN).isNotNull()).alias("rows"), *bad).first().asDict()
        if any(counts.values()):
            raise ValueError(f"{path}: malformed {', '.join(f'{k}: {n}' for k, n in counts.items() if n)}")
    return rows.select(*[_value(f).alias(f.name) for f in schema.fields])


def _value(field: T.StructField) -> Column:
    """A text column in the type of ``field``; null where it does not fit."""
    x = F.col(field.name)
    if isinstance(field.dataType, T.IntegralType):
        number = x.try_cast("double")
        x = F.coalesce(x.try_cast("bigint"), F.when((number == F.floor(number)) & (F.abs(number) < 2.0**53), number.try_cast("bigint")))
    return x.try_cast(field.dataType)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> None:
    """Write a table. With ``partition_by`` rows are first rebalanced on that column, so that a
    large month is spread over several tasks and a small one does not leave tiny files."""
    if partition_by is not None:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV, timestampNTZFormat=TIMESTAMP_TEXT)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.save(path)


def parse_timestamps(df: DataFrame, column: str) -> DataFrame:
    """Turn a text column in ``2011-12-09 12:50:00`` form into a timestamp without time zone."""
    return df.withColumn(column, F.to_timestamp_ntz(F.col(column), F.lit(TIMESTAMP_TEXT)))


def drop_index_column(df: DataFrame) -> DataFrame:
    """Drop a saved row-number column, if there is one."""
    return df.drop(*[c for c in INDEX_COLUMNS if c in df.columns])
