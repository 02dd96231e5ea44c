"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import fresh, whole_text, word_count
from basketry.materialize import stored

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
ROWS_PER_RANGE = 20_000
SALT = "mix"


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = MOST_EPOCHS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources in code point order, null last, take the weights in turn and share the total. A share
    stops at ``cap`` times its source, and what is above goes to the others by weight. Written as
    a level: sources are full in rising order of ``cap * size / weight``, so the level is the
    first at which the next source is not full. One row per source goes through one task here,
    never rows of documents.
    """
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (turn + 1).cast("int"))
    room = F.lit(int(cap)).cast("long") * F.col("source_size")
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    filled = (
        sizes.withColumn("weight", weight)
        .withColumn("room", room)
        .withColumn("ratio", F.col("room") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("used", F.coalesce(F.sum("room").over(earlier), F.lit(0)))
        .withColumn("open", F.sum("weight").over(later))
        .withColumn("place", F.row_number().over(order))
        .withColumn("level", (F.col("total") - F.col("used")) / F.col("open"))
        .withColumn("level", F.min_by("level", F.when(F.col("level") <= F.col("ratio"), F.col("place"))).over(every))
    )
    target = F.when(F.col("ratio") <= F.col("level"), F.col("room").cast("double")).otherwise(
        F.col("level") * F.col("weight")
    )
    return filled.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    cap: int = MOST_EPOCHS,
    salt: str = SALT,
    size: Column | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, taken``: how many words of each row the mix takes.

    Every row gets a hash-random key. Rows of a source are cut into key ranges (their number follows
    the row count), the ranges are added up, prefix sums over ranges find the one that holds the
    source's budget, and only that range is sorted row by row. Whole epochs come first; the rest of
    the budget takes rows in key order, the last one in part. A hot source is many ranges, so no
    task sees all of it. The same input and salt give the same mix.

    Null text counts 0 words; a null source is a source of its own, sorted last. Rows with one key
    (repeated rows) share a cut in proportion to their sizes, rounded down. Empty input gives an
    empty result. Columns of ``docs`` named like a new one are replaced.
    """
    new = ["size", "source_size", "target", "taken"]
    kept = docs.drop(*new)
    words = word_count(whole_text()) if size is None else size
    key = F.md5(F.concat_ws("|", F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = stored(docs.select("doc_id", "source", words.alias("size"), key.alias("key")), "sized")
    n = sized.count()
    ranges = max(16, -(-n // rows_per_range))
    place = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(ranges) / F.lit(2**32))
    ranged = sized.withColumn("range", place)
    by_range = stored(ranged.groupBy("source", "range").agg(F.sum("size").alias("n")), "ranges")
    targets = source_targets(by_range.groupBy("source").agg(F.sum("n").alias("source_size")), weights, cap)
    budget = F.round("target").cast("long")
    budgets = (
        targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0))
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
        .withColumnRenamed("source", "src")
    )
    budgets = stored(budgets, "budgets")
    before = F.sum("n").over(Window.partitionBy("source").orderBy("range")) - F.col("n")
    at = (F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("n"))
    cut_ranges = (
        by_range.withColumn("before", before)
        .join(budgets, F.col("source").eqNullSafe(F.col("src")))
        .where(at)
        .select("src", F.col("range").alias("cut_range"), F.col("before").alias("below"), "rest")
    )
    in_cut = (
        ranged.join(stored(cut_ranges, "cuts"), F.col("source").eqNullSafe(F.col("src")) & (F.col("range") == F.col("cut_range")))
        .groupBy("src", "key", "below", "rest")
        .agg(F.sum("size").alias("n"))
        .withColumn("before", F.col("below") + F.sum("n").over(Window.partitionBy("src").orderBy("key")) - F.col("n"))
        .where(at)
        .select(
            F.col("src").alias("cut_src"), F.col("key").alias("cut_key"),
            (F.col("rest") - F.col("before")).alias("part"), F.col("n").alias("key_size"),
        )
    )
    plan = stored(
        budgets.join(in_cut, F.col("src").eqNullSafe(F.col("cut_src")), "left").drop("cut_src"), "plan"
    )
    named = dict(zip(plan.columns, fresh(docs, *[f"mix_{c}" for c in plan.columns]), strict=True))
    plan = plan.withColumnsRenamed(named)
    of = {c: F.col(n) for c, n in named.items()}
    rest = (
        F.when(key < of["cut_key"], words)
        .when(key == of["cut_key"], F.floor(of["part"] * words / of["key_size"]))
        .otherwise(0)
    )
    return kept.join(plan, F.col("source").eqNullSafe(of["src"]), "left").select(
        *[F.col(c) for c in kept.columns],
        words.alias("size"),
        of["source_size"].alias("source_size"),
        of["target"].alias("target"),
        (of["epochs"] * words + rest).cast("long").alias("taken"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows: each row as often as the mix takes it, a part counting as once, with ``copy`` from 0."""
    times = F.ceil(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    mixed = mix_sources(docs, **options).where("taken > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(0), times - 1)))
