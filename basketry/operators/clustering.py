"""Customer segments by k-means, scores of a clustering, and descriptions of the segments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import dot, manhattan_distance, squared_distance, squared_norm, standardised
from basketry.materialize import checkpointed
from basketry.operators.kmeans import best_runs, clustering_scores, pack_rows
from basketry.operators.scaling import Scaler
from basketry.schema import CLUSTER_COLUMNS, SEED


@dataclass
class Segmentation:
    customers: DataFrame
    cost: float
    centres: list[list[float]]
    scaler: Scaler


def scaled_columns(columns: Sequence[str], scaler: Scaler) -> list[Column]:
    return [standardised(F.col(c), *scaler.stats[c]) for c in columns]


def segment(
    customers: DataFrame,
    columns: Sequence[str] = CLUSTER_COLUMNS,
    k: int = 5,
    restarts: int = 300,
    seed: int = SEED,
    rank_by: str = "Amount",
    max_iter: int = 100,
) -> Segmentation:
    """Add ``Label``: k-means on standardised columns, the cheapest of ``restarts`` runs, which share their passes over the
    rows. Labels are numbered by falling mean of ``rank_by``, so that they keep their meaning between runs."""
    scaler = Scaler.fit(customers, list(columns))
    vectors = customers.withColumn("_vec", F.array(*scaled_columns(columns, scaler)))
    run = best_runs(pack_rows(vectors, "_vec"), [k], restarts, seed, max_iter)[k]
    assigned = assign_nearest(vectors, "_vec", dict(enumerate(run.centres.tolist())), name="_cluster")
    means = assigned.groupBy("_cluster").agg(F.avg(rank_by).alias("m")).collect()
    ordered = [r["_cluster"] for r in sorted(means, key=lambda r: (-r["m"], r["_cluster"]))]
    ordered += [c for c in range(len(run.centres)) if c not in ordered]
    number = F.array(*[F.lit(ordered.index(c)) for c in range(len(ordered))])
    labelled = assigned.withColumn("Label", number[F.col("_cluster")]).drop("_vec", "_cluster")
    return Segmentation(labelled, run.cost, [list(map(float, run.centres[c])) for c in ordered], scaler)


def cluster_moments(df: DataFrame, vec: str, label: str) -> DataFrame:
    """One row per cluster: ``n``, ``sums`` (array) and ``squares`` (sum of squared norms)."""
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        vector_to_array(Summarizer.sum(array_to_vector(vec))).alias("sums"),
        F.sum(squared_norm(F.col(vec))).alias("squares"),
    )


def calinski_harabasz(df: DataFrame, vec: str, label: str) -> DataFrame:
    """[B / (k - 1)] / [W / (n - k)] from one pass over the rows."""
    per_cluster = cluster_moments(df, vec, label).withColumn(
        "explained", squared_norm(F.col("sums")) / F.col("n")
    )
    whole = per_cluster.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("squares") - F.col("explained")).alias("within"),
        F.sum("explained").alias("explained"),
        vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("grand"),
    )
    between = F.col("explained") - squared_norm(F.col("grand")) / F.col("n")
    return whole.select(
        F.try_divide(
            F.try_divide(between, F.col("k") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("k"))
        ).alias("score")
    )


def silhouette(df: DataFrame, vec: str, label: str) -> DataFrame:
    """Mean silhouette with squared Euclidean distance, linear in the rows.

    The mean squared distance from a row to a cluster follows from the cluster's size, sum and
    squared norm, so only k small rows are needed besides one pass. Rows alone in their cluster
    score 0.
    """
    v = F.col(vec)
    stats = cluster_moments(df, vec, label).collect()
    to_clusters = F.array(
        *[
            F.struct(
                F.lit(r[label]).alias("c"),
                F.lit(r["n"]).alias("n"),
                (
                    F.col("_norm") + F.lit(r["squares"] / r["n"]) - 2.0 * dot(v, [x / r["n"] for x in r["sums"]])
                ).alias("d"),
            )
            for r in stats
        ]
    )
    means = df.select(label, vec, squared_norm(v).alias("_norm")).select(label, to_clusters.alias("m"))
    own = F.filter("m", lambda x: x["c"] == F.col(label))[0]
    others = F.array_min(F.transform(F.filter("m", lambda x: x["c"] != F.col(label)), lambda x: x["d"]))
    scored = means.select(own.alias("own"), others.alias("b"))
    n = F.col("own")["n"]
    a = F.try_divide(F.col("own")["d"] * n, n - 1)
    score = F.when(n == 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - a, F.greatest(a, F.col("b"))), F.lit(0.0))
    )
    return scored.agg(F.avg(score).alias("score"))


#: Bytes of vectors in a partition of blocks; a task of the quadratic silhouette holds one such partition and goes through another.
PAIRED_BYTES = 16 << 20


def _far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``x`` and ``y`` by one matrix product; those so near that rounding would tell are taken by differences."""
    origin = y.mean(0)
    v, w = x - origin, y - origin
    own, other = (v**2).sum(1), (w**2).sum(1)
    squares = v @ (-2 * w).T
    squares += own[:, None]
    squares += other
    if squares.size and squares.min() <= 1e-5 * (own.max() + other.max()):
        i, j = np.nonzero(squares <= 1e-5 * (own[:, None] + other))
        for lo in range(0, len(i), 16_384):
            at = i[lo : lo + 16_384], j[lo : lo + 16_384]
            squares[at] = ((x[at[0]] - y[at[1]]) ** 2).sum(1)
    return np.sqrt(squares, out=squares)


def _paired_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """``b, x, l``: up to ``block_rows`` rows of ``v, l`` each, stored in partitions of bounded size."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = len(batch.column("v")[0]) if len(batch) else 0
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            own = batch.column("l").to_numpy().astype(np.int32)
            cuts = [slice(lo, lo + block_rows) for lo in range(0, len(x), block_rows)]
            columns = [[a[i].tobytes() for i in cuts] for a in (x, own)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["x", "l"])

    blocks = checkpointed(rows.mapInArrow(pack, "x binary, l binary").withColumn("b", F.monotonically_increasing_id()))
    held = blocks.agg(F.sum(F.length("x"))).first()[0] or 0
    return blocks.repartition(max(1, -(-held // PAIRED_BYTES)), "b")


def euclidean_silhouette(df: DataFrame, vec: str, label: str, most_rows: int | None = None, block_rows: int = 1_024) -> DataFrame:
    """Mean silhouette with plain Euclidean distance, exact.

    The mean distance from a row to a cluster has no short form, so every row meets every other one, once: stored
    partitions of blocks are read beside each other, and a task returns one sum per row and cluster, never a pair
    of rows. The work is quadratic, what a task holds and sends is not; a table of more than ``most_rows`` rows is refused where that is given.
    Rows alone in their cluster score 0.
    """
    sizes = dict(sorted((r[0], r[1]) for r in df.groupBy(label).agg(F.count(F.lit(1))).collect()))  # one row per cluster
    n = sum(sizes.values())
    if most_rows is not None and n > most_rows:
        raise ValueError(f"{n} rows; the quadratic silhouette takes at most {most_rows}")
    number = F.create_map(*[F.lit(x) for i, c in enumerate(sizes) for x in (c, i)])[F.col(label)] if sizes else F.lit(0)
    blocks = _paired_blocks(df.select(F.col(vec).cast("array<double>").alias("v"), number.cast("int").alias("l")), block_rows)
    k, n_of = len(sizes), np.array([*sizes.values()], float)
    left, right = (blocks.select(*[F.col(c).alias(f"{c}{i}") for c in ("b", "x", "l")]) for i in (0, 1))
    # Of two blocks each comes first as often as the other.
    even = F.pmod(F.col("b0") + F.col("b1"), F.lit(2)) == 0
    once = (F.col("b0") == F.col("b1")) | (even == (F.col("b0") < F.col("b1"))) & (F.col("b0") != F.col("b1"))

    def read(x, own) -> tuple[np.ndarray, np.ndarray]:
        own = np.frombuffer(own, np.int32)
        return np.frombuffer(x).reshape(len(own), -1), own

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(len(batch)):
                r = {name: batch.column(name)[i] for name in batch.schema.names}
                b, c = r["b0"].as_py(), r["b1"].as_py()
                (x, own), (y, other) = read(r["x0"].as_buffer(), r["l0"].as_buffer()), read(r["x1"].as_buffer(), r["l1"].as_buffer())
                of_x, of_y = ((a[:, None] == np.arange(k)).astype(float) for a in (own, other))
                for at, rows in ((b, x), (c, y)):
                    if at not in found:
                        found[at] = np.zeros((len(rows), k))
                for lo in range(0, len(x), 256):
                    far = _far(x[lo : lo + 256], y)
                    found[b][lo : lo + 256] += far @ of_y
                    if b != c:
                        found[c] += far.T @ of_x[lo : lo + 256]
        for at, total in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total.ravel()], pa.list_(pa.float64()))], ["b", "sums"])

    met = left.hint("shuffle_replicate_nl").crossJoin(right).where(once).mapInArrow(sums, "b long, sums array<double>")
    whole = met.groupBy("b").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own, far = np.frombuffer(r["l"], np.int32), np.array(r["sums"]).reshape(-1, k)
                at = np.arange(len(own))
                a = far[at, own] / np.maximum(n_of[own] - 1, 1)
                others = far / n_of
                others[at, own] = np.inf
                b = others.min(1)
                top = np.maximum(a, b)
                s = np.where((n_of[own] == 1) | ~np.isfinite(b) | (top <= 0), 0.0, (b - a) / np.where(top > 0, top, 1))
                yield pa.RecordBatch.from_arrays([pa.array([s.sum()], pa.float64()), pa.array([len(s)], pa.int64())], ["s", "n"])

    scored = whole.join(blocks.select("b", "l"), "b").select("l", "sums").mapInArrow(scores, "s double, n long")
    return scored.agg(F.try_divide(F.sum("s"), F.sum("n")).alias("score"))


def k_sweep(
    customers: DataFrame,
    ks: Sequence[int] = range(2, 25),
    columns: Sequence[str] = CLUSTER_COLUMNS,
    restarts: int = 20,
    seed: int = SEED,
    max_iter: int = 100,
) -> DataFrame:
    """``k``, ``silhouette`` and ``calinski_harabasz`` of the best clustering for every k; all runs share their passes."""
    scaler = Scaler.fit(customers, list(columns))
    blocks = pack_rows(customers.select(F.array(*scaled_columns(columns, scaler)).alias("vec")))
    best = best_runs(blocks, list(ks), restarts, seed, max_iter)
    scores = clustering_scores(blocks, {k: r.centres for k, r in best.items()})
    rows = [(k, *scores.get(k, (None, None))) for k in ks]
    return customers.sparkSession.createDataFrame(rows, "k int, silhouette double, calinski_harabasz double")


def assign_nearest(
    df: DataFrame, vec: str, centres: dict[int, Sequence[float]], p: int = 2, name: str = "centre"
) -> DataFrame:
    """The nearest of a fixed set of centres for every row; a tie goes to the smallest number."""
    measure = squared_distance if p == 2 else manhattan_distance
    v = F.col(vec)
    options = [F.struct(measure(v, point).alias("d"), F.lit(c).alias("c")) for c, point in sorted(centres.items())]
    return df.withColumn(name, F.array_min(F.array(*options))["c"])


def group_means(df: DataFrame, vec: str, by: str) -> DataFrame:
    """Mean vector per group: the centre update of k-means."""
    return df.groupBy(by).agg(vector_to_array(Summarizer.mean(array_to_vector(vec))).alias("mean"))


def explain_segments(
    customers: DataFrame, columns: Sequence[str] = CLUSTER_COLUMNS, max_depth: int = 3
) -> tuple[DecisionTreeClassificationModel, DataFrame]:
    """A shallow gini tree on the unscaled columns, and its rules as rows (``line``, ``depth``, ``rule``)."""
    data = VectorAssembler(inputCols=list(columns), outputCol="features").transform(
        customers.select(*[F.col(c).cast("double").alias(c) for c in columns], F.col("Label").cast("double"))
    )
    model = DecisionTreeClassifier(
        labelCol="Label", featuresCol="features", maxDepth=max_depth, impurity="gini", maxBins=256
    ).fit(data)
    rows = []
    for line in model.toDebugString.splitlines()[1:]:
        text = line.strip()
        for i, c in enumerate(columns):
            text = text.replace(f"(feature {i} ", f"({c} ")
        if text:
            rows.append((len(rows), (len(line) - len(line.lstrip())) - 2, text))
    return model, customers.sparkSession.createDataFrame(rows, "line int, depth int, rule string")


def segment_population(customers: DataFrame) -> DataFrame:
    return customers.groupBy("Label").agg(F.count(F.lit(1)).alias("customers"))


def segment_sums(customers: DataFrame, columns: Sequence[str]) -> DataFrame:
    return customers.groupBy("Label").agg(*[F.sum(c).alias(c) for c in columns])


def segment_means(customers: DataFrame, columns: Sequence[str]) -> DataFrame:
    return customers.groupBy("Label").agg(*[F.avg(c).alias(c) for c in columns])
