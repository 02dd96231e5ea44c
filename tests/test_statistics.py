"""Quantiles, ranks, running totals, histograms and correlations against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import explore as ex
from basketry.operators import ordered as od
from basketry.operators import sampling as sm
from basketry.operators.quantiles import exact_quantiles
from basketry.operators.scaling import Scaler


@pytest.fixture(scope="module")
def values():
    rng = random.Random(3)
    # a third of all rows share one value
    return [(i, 7.0 if i % 3 == 0 else rng.gauss(0, 50), rng.randint(0, 4)) for i in range(3000)]


@pytest.fixture(scope="module")
def frame(spark, values):
    return spark.createDataFrame(values, "id bigint, x double, g int").repartition(6)


@pytest.mark.parametrize("margin,bins,most", [(0.005, 4_096, 100_000), (0.2, 10, 0), (0.9, 2, 0), (1e-9, 4_096, 100_000)])
def test_quantiles_are_exact(frame, values, margin, bins, most):
    """By sorting what the brackets kept, by histograms of it, and when a bracket misses its ranks."""
    ps = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = exact_quantiles(frame, {"x": ps, "g": [0.99]}, margin, bins, most)
    xs = [v[1] for v in values]
    for p in ps:
        assert got["x", p] == pytest.approx(np.quantile(xs, p), abs=1e-9)
    assert got["g", 0.99] == 4


@pytest.mark.parametrize("most", [100_000, 0])
def test_quantiles_end_on_every_column(spark, most):
    half = [(float(i % 2), float(49 + (i >= 500)), 2.0 ** (i - 500), 1e-300 * i, float("nan") if i % 3 else 1.0 * i, None, 5.0) for i in range(1000)]
    df = spark.createDataFrame(half, "half double, border double, wide double, tiny double, some double, none double, same double")
    ps = [0.0, 0.4995, 0.5, 0.99, 1.0]
    got = exact_quantiles(df, {c: ps for c in df.columns}, bins=10, sorted_values=most)
    for i, c in enumerate(df.columns):
        xs = [r[i] for r in half if r[i] is not None and r[i] == r[i]]
        for p in ps:
            assert got[c, p] == (pytest.approx(np.quantile(xs, p), rel=1e-9) if xs else None)
    ends = spark.createDataFrame([(float("-inf"),), (1.0,), (2.0,), (3.0,), (float("inf"),)], "x double")
    assert [exact_quantiles(ends, {"x": [p]}, sorted_values=most)["x", p] for p in (0.0, 0.25, 0.5, 0.75, 1.0)] == [float("-inf"), 1, 2, 3, float("inf")]


def test_quantile_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(empty, {"x": [0.5]}) == {("x", 0.5): None}


def test_bucketed_row_number_is_row_number(frame):
    ranked = od.bucketed_row_number(frame, ["g"], F.floor(F.col("x") / 10), ["x", "id"]).collect()
    for g in range(5):
        rows = sorted((r.x, r.id, r["rank"]) for r in ranked if r.g == g)
        assert [r[2] for r in rows] == list(range(1, len(rows) + 1))


def test_running_total_splits_ties(frame, values):
    got = od.running_total(frame, [F.desc("x"), F.asc("id")], "x").orderBy("position").collect()
    want = sorted(values, key=lambda v: (-v[1], v[0]))
    assert [r.id for r in got] == [v[0] for v in want]
    assert np.allclose([r.running for r in got], np.cumsum([v[1] for v in want]))


def test_split_keeps_class_shares(frame, values):
    split = sm.stratified_split(frame, "id", "g").collect()
    assert len(split) == len(values)
    for g in range(5):
        rows = [r for r in split if r.g == g]
        assert abs(sum(r.is_test for r in rows) - 0.3 * len(rows)) <= 1
    folds = sm.stratified_folds(frame, "id", "g").groupBy("g", "fold").count().collect()
    assert max(r["count"] for r in folds if r.g == 0) - min(r["count"] for r in folds if r.g == 0) <= 1


def test_sample_is_exact_and_repeatable(frame):
    one = {r.id for r in sm.sample_rows(frame, "id", 100).collect()}
    two = {r.id for r in sm.sample_rows(frame.repartition(3), "id", 100).collect()}
    assert len(one) == 100 and one == two


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    rows = {r.bin: r.n for r in ex.histogram(df, {"x": 10}).collect()}
    assert rows[9] == 2 and sum(rows.values()) == 11
    assert set(rows) == set(range(10))


def test_constant_columns_do_not_fail(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 5.0), (1.0, 9.0)], "a double, b double")
    assert ex.correlations(df, ["a", "b"]).first().r is None
    scaler = Scaler.fit(df, ["a", "b"])
    rows = scaler.apply(df).collect()
    assert [r.a for r in rows] == [0.0, 0.0, 0.0]
    assert sum(r.b**2 for r in rows) / 3 == pytest.approx(1.0)
    assert ex.histogram(df, {"a": 5}).collect()[0].n == 3


def test_correlation_matches_numpy(frame, values):
    r = ex.correlations(frame, ["x", "g"]).first().r
    assert r == pytest.approx(np.corrcoef([v[1] for v in values], [v[2] for v in values])[0, 1])


def test_correlations_keep_apart_far_from_zero(spark):
    rng = random.Random(9)
    rows = [(1e9 + rng.random(), 1e9 + rng.random(), None if i % 4 else 1e9, float("nan") if i == 7 else 1.0 * i) for i in range(400)]
    got = {(r.a, r.b): r.r for r in ex.correlations(spark.createDataFrame(rows, "x double, y double, z double, n double"), ["x", "y", "z", "n"]).collect()}
    x, y = np.array([r[0] for r in rows]) - 1e9, np.array([r[1] for r in rows]) - 1e9
    assert got["x", "y"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-6)
    assert got["x", "z"] is None and got["x", "n"] is None


def test_distinct_counts_null_once(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",)], "c string")
    assert ex.distinct_values(df, "c").first().n == 3


def test_correlations_are_pairwise(spark):
    from basketry.operators.explore import correlations

    rows = [(1.0, 2.0, None), (2.0, 1.0, 5.0), (3.0, 4.0, 7.0), (4.0, 3.0, 6.0)]
    got = {(r.a, r.b): r.r for r in correlations(spark.createDataFrame([(*r, 1.0) for r in rows], "x double, y double, z double, c double"), ["x", "y", "z", "c"]).collect()}
    assert got["x", "y"] == pytest.approx(np.corrcoef([r[0] for r in rows], [r[1] for r in rows])[0, 1])
    assert got["x", "z"] == pytest.approx(np.corrcoef([2, 3, 4], [5, 7, 6])[0, 1])
    assert got["x", "c"] is None
