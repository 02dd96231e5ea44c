"""Standardisation with population deviation, and one-hot months."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import standardised
from basketry.sources.files import read_table, write_table

STATS_SCHEMA = "column string, mean double, std double"


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column: a few numbers, applied as literals."""

    stats: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> Scaler:
        row = df.agg(
            *[F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{i}") for i, c in enumerate(columns)],
        ).first()
        return cls({c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(columns)})

    @classmethod
    def fit_groups(cls, df: DataFrame, group: str, columns: list[str]) -> dict:
        """One scaler per value of a low-cardinality column, from one aggregate."""
        rows = df.groupBy(group).agg(
            *[F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{i}") for i, c in enumerate(columns)],
        ).collect()
        return {
            r[group]: cls({c: (r[f"m_{i}"], r[f"s_{i}"]) for i, c in enumerate(columns)}) for r in rows
        }

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: standardised(F.col(c), m, s) for c, (m, s) in self.stats.items()})

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(c, m, s) for c, (m, s) in self.stats.items()], STATS_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        write_table(self.to_frame(spark).coalesce(1), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Scaler:
        from pyspark.sql.types import StructType

        rows = read_table(spark, path, StructType.fromDDL(STATS_SCHEMA)).collect()
        return cls({r["column"]: (r["mean"], r["std"]) for r in rows})


def one_hot_month(df: DataFrame) -> DataFrame:
    """Replace Month by twelve fixed 0/1 columns, so training and scoring always agree."""
    months = {f"Month_{m}": F.when(F.col("Month") == m, 1).otherwise(0) for m in range(1, 13)}
    return df.withColumns(months).drop("Month")
