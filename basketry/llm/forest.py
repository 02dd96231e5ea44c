"""Embedding near-dedup with a forest of random-projection trees."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.components import connected_components
from basketry.materialize import stored

LEAST_COSINE = 0.95
TREES = 8
LEAF = 1_000
#: Half the width of the overlap around a split, in the scale of unit vectors.
SPILL = 0.02
#: Share of a node that the overlap may at most add to each side, so that every split makes progress.
MOST_SPILL = 0.1
SEED = 20


def _directions(dim: int, tree: int, levels: int) -> np.ndarray:
    drawn = np.random.default_rng([SEED, dim, tree]).standard_normal((dim, levels))
    return drawn / np.linalg.norm(drawn, axis=0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    scaled = m / np.abs(m).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _projected(trees: int, levels: int):
    """For every vector and tree its place along the direction of each level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                units = _unit(_matrix(part.column("vec")))
                for tree in range(trees):
                    at = (units @ _directions(int(dim), tree, levels)).astype(np.float32)
                    lists = pa.ListArray.from_arrays(np.arange(0, at.size + 1, levels, dtype=np.int32), pa.array(at.ravel(), pa.float32()))
                    n = len(part.column("rep"))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("rep"), pa.array([tree] * n, pa.int32()), pa.array([f"{dim}:"] * n), lists], ["rep", "tree", "node", "at"]
                    )

    return run


def _leaf_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The first place reachable from each of ``n`` places over the pairs ``i, j``, given in both directions."""
    first = np.arange(n)
    while True:
        before = first.copy()
        np.minimum.at(first, i, before[j])
        first = first[first]
        if (first == before).all():
            return first


def _linked(least: float):
    """The pairs of a leaf that link, and (``link`` false) every member with the first one of its component in
    the leaf: what components need, in no more rows than members."""

    def run(leaf: pa.Table) -> pa.Table:
        ids = leaf.column("rep").to_numpy()
        units = _unit(_matrix(leaf.column("vec").combine_chunks()))
        rows, columns = [], []
        for lo in range(0, len(ids), 256):
            i, j = np.nonzero(units[lo : lo + 256] @ units.T >= least)
            rows.append(i + lo), columns.append(j)
        i, j = np.concatenate(rows), np.concatenate(columns)
        first = _leaf_components(len(ids), np.r_[i, j], np.r_[j, i])
        pair, member = ids[i] < ids[j], first != np.arange(len(ids))
        return pa.table(
            {
                "a": np.r_[ids[i[pair]], ids[member]],
                "b": np.r_[ids[j[pair]], ids[first[member]]],
                "link": np.repeat([True, False], [pair.sum(), member.sum()]),
            }
        )

    return run


def forest_leaves(vectors: DataFrame, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL) -> DataFrame:
    """``tree, node, rep``: the leaves of every tree over ``rep, dim, vec``.

    Every level splits the nodes with more than ``leaf`` vectors at the median of a random
    projection; vectors near the border go to both sides. The medians of all nodes of a level are one
    distributed aggregation, whatever the number of rows. A side gets at most
    ``0.5 + MOST_SPILL`` of its node, which bounds the number of levels.
    """
    n = vectors.count()
    levels = max(1, ceil(log(max(n / leaf, 1)) / -log(0.5 + MOST_SPILL)) + 8)
    open_ = stored(vectors.mapInArrow(_projected(trees, levels), "rep long, tree int, node string, at array<float>"), "nodes")
    leaves: DataFrame | None = None
    for level in range(levels + 1):
        sizes = open_.groupBy("tree", "node").agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx(F.col("at")[min(level, levels - 1)], F.array(F.lit(0.5 - MOST_SPILL), F.lit(0.5), F.lit(0.5 + MOST_SPILL)), F.lit(1000)).alias("cut"),
        )
        sizes = stored(sizes, "splits")
        placed = open_.join(sizes, ["tree", "node"])
        small = F.lit(True) if level == levels else F.col("n") <= leaf
        ready = placed.where(small).select("tree", "node", "rep")
        leaves = ready if leaves is None else leaves.unionByName(ready)
        if level == levels or sizes.where(F.col("n") > leaf).isEmpty():
            return leaves
        x = F.col("at")[level]
        low = x <= F.least(F.col("cut")[1] + spill, F.col("cut")[2])
        high = x > F.greatest(F.col("cut")[1] - spill, F.col("cut")[0])
        sides = F.array_compact(F.array(F.when(low, F.concat("node", F.lit("0"))), F.when(high, F.concat("node", F.lit("1")))))
        split = placed.where(~small).select("rep", "tree", F.explode(sides).alias("node"), "at")
        open_ = stored(split, "nodes")


def near_vectors(
    vectors: DataFrame, least: float = LEAST_COSINE, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding``.

    Equal vectors are one class, which stands in the forest once; classes that share a leaf of any
    tree are compared exactly, in double precision, and link at a cosine of ``least`` or more. A
    vector's links are the members of its own and of the linked classes. ``component_id`` is the
    smallest vec_id reachable; ``kept`` marks it.

    A null or zero vector, or one with null or non-finite parts, links with nothing, and vectors of different
    length never link. A row without vec_id links with nothing, has a null component and is kept.
    Repeated rows are vectors of their own. Empty input gives an empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0) & F.col("vec_id").isNotNull()
    plain = F.transform("vec", lambda x: x + F.lit(0.0))  # minus zero is zero
    marked = stored(
        rows.withColumn("vec", F.when(F.coalesce(good, F.lit(False)), plain))
        .withColumns({"h1": F.when(F.col("vec").isNotNull(), F.xxhash64("vec")), "h2": F.when(F.col("vec").isNotNull(), F.xxhash64(F.lit(7), "vec"))}),
        "vectors",
    )
    classes = stored(
        marked.where("vec IS NOT NULL").groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("members"), F.first("vec").alias("vec")),
        "classes",
    ).withColumn("dim", F.size("vec"))
    leaves = forest_leaves(classes.select("rep", "dim", "vec"), trees, leaf, spill)
    edges = stored(
        leaves.join(classes.select("rep", "vec"), "rep")
        .select("tree", "node", "rep", "vec").groupBy("tree", "node").applyInArrow(_linked(least), "a long, b long, link boolean").distinct(),
        "links",
    )
    links = edges.where("link").select("a", "b")
    labels = connected_components(edges.where("NOT link"))
    sizes = classes.select("rep", "members")
    others = (
        links.union(links.select("b", "a")).join(sizes, F.col("b") == F.col("rep")).groupBy("a").agg(F.sum("members").alias("others"))
    )
    known = (
        classes.select("h1", "h2", "rep", "members")
        .join(others, F.col("rep") == F.col("a"), "left")
        .join(labels, F.col("rep") == F.col("node"), "left")
        .select("h1", "h2", (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    component = F.coalesce("component_id", "vec_id")
    return marked.join(known, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
