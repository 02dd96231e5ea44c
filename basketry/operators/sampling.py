"""Reproducible splits, folds, samples and the random baseline classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import draw_uniform
from basketry.operators.ordered import random_rank
from basketry.schema import SEED


def stratified_split(
    df: DataFrame, id_col: str, label: str = "Label", test_size: float = 0.3, seed: int = SEED, by: Sequence[str] = ()
) -> DataFrame:
    """Add ``is_test``: exactly ``round(test_size * n)`` random rows of every class (of every part ``by``)."""
    group = [*by, label]
    sizes = df.groupBy(*group).agg(F.round(F.count(F.lit(1)) * F.lit(test_size)).alias("_tests"))
    ranked = random_rank(df, id_col, seed, group)
    return ranked.join(sizes, group).withColumn("is_test", F.col("rank") <= F.col("_tests")).drop(
        "rank", "_tests"
    )


def stratified_folds(
    df: DataFrame, id_col: str, label: str = "Label", folds: int = 5, seed: int = SEED, by: Sequence[str] = ()
) -> DataFrame:
    """Add ``fold`` 0..folds-1, dealt out in random order within every class (of every part ``by``)."""
    ranked = random_rank(df, id_col, seed, [*by, label])
    return ranked.withColumn("fold", (F.col("rank") % folds).cast("int")).drop("rank")


def sample_rows(df: DataFrame, id_col: str, n: int, seed: int = SEED) -> DataFrame:
    """``n`` random rows without replacement; no task has to hold all ``n``."""
    return random_rank(df, id_col, seed).where(F.col("rank") <= n).drop("rank")


def class_shares(df: DataFrame, label: str = "Label") -> list[tuple[int, float]]:
    """(class, cumulated share) in class order; one entry per class."""
    counts = sorted((r[0], r[1]) for r in df.groupBy(label).count().collect())
    whole = sum(n for _, n in counts)
    shares, seen = [], 0
    for value, n in counts:
        seen += n
        shares.append((value, seen / whole))
    return shares


def dummy_predict(df: DataFrame, shares: list[tuple[int, float]], id_col: str, seed: int = SEED) -> DataFrame:
    """Draw a class for every row from the training shares (the stratified baseline)."""
    u = draw_uniform(seed, id_col)
    prediction = F.lit(shares[-1][0])
    for value, upto in reversed(shares[:-1]):
        prediction = F.when(u < F.lit(upto), F.lit(value)).otherwise(prediction)
    return df.withColumn("prediction", prediction)
