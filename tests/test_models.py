"""Neighbours, clustering, votes, scores, persistence."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from basketry.operators import classifiers as cf
from basketry.operators import clustering as ct
from basketry.operators import evaluation as ev
from basketry.operators import kmeans as km
from basketry.operators import neighbours as nb


@pytest.fixture(scope="module")
def points():
    rng = random.Random(5)
    rows = []
    for i in range(400):
        label = i % 3
        # a third of the rows are copies of one point
        vec = [1.0, 1.0, 1.0] if label == 0 else [rng.gauss(4 * label, 1), rng.gauss(-3 * label, 1), rng.gauss(0, 1)]
        rows.append((i, label, vec))
    return rows


@pytest.fixture(scope="module")
def frame(spark, points):
    return spark.createDataFrame(points, "id bigint, label int, vec array<double>").repartition(4).cache()


@pytest.mark.parametrize("p,chunk,pivots", [(2, 4096, None), (1, 16, 7)])
def test_neighbours_match_brute_force(spark, frame, points, p, chunk, pivots):
    queries = [(1000 + i, [float(i % 9), -float(i % 7), 0.1 * i]) for i in range(40)] + [(2000, [1.0, 1.0, 1.0])]
    q = spark.createDataFrame(queries, "id bigint, vec array<double>")
    got = nb.nearest(frame, q, 6, p, chunk, pivots).collect()
    x = np.array([r[2] for r in points])
    for qid, vec in queries:
        diff = np.abs(x - np.array(vec))
        d = diff.sum(1) if p == 1 else np.sqrt((diff**2).sum(1))
        want = sorted(range(len(points)), key=lambda i: (d[i], i))[:6]
        rows = sorted((r.rank, r.id) for r in got if r.query_id == qid)
        assert [i for _, i in rows] == want


def test_training_rows_go_only_to_cells_that_can_need_them(spark):
    rng = np.random.default_rng(4)
    centres = rng.uniform(-100, 100, (12, 3))
    rows = [(i, i % 3, [*map(float, centres[i % 12] + rng.standard_normal(3))]) for i in range(1200)]
    train = spark.createDataFrame(rows, "id bigint, label int, vec array<double>")
    queries = spark.createDataFrame([(5000 + i, v) for i, _, v in rows[:600]], "id bigint, vec array<double>")
    plan, _, _ = nb.cell_plan(train, queries, 5, chunk_rows=50, pivots=24)
    pairs = sum(len(own) for own in plan.meets.values())
    assert sum(n for n, _ in plan.rows.values()) == 1200 and sum(n for n, _ in plan.queries.values()) == 600
    assert pairs < 0.5 * len(plan.rows) * len(plan.queries)
    # Every query chunk would get every row without the bounds of the cells.
    assert plan.sent_rows == sum(plan.rows[t][0] * plan.query_parts(q) for q, own in plan.meets.items() for t in own)
    assert plan.sent_rows < 0.5 * 1200 * 600 / 50
    got = nb.nearest(train, queries, 5, chunk_rows=50, pivots=24).collect()
    x = np.array([v for _, _, v in rows])
    for q in range(0, 600, 37):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = sorted(range(1200), key=lambda i: (d[i], i))[:5]
        assert [i for _, i in sorted((r.rank, r.id) for r in got if r.query_id == 5000 + q)] == want


@pytest.mark.parametrize("p", [1, 2])
def test_neighbours_are_found_without_shuffled_copies(spark, monkeypatch, p):
    monkeypatch.setattr(nb, "HELD_BYTES", 4_096, raising=False)
    monkeypatch.setattr(nb, "PIECE_ROWS", 40, raising=False)
    rng = np.random.default_rng(9)
    x = np.round(rng.standard_normal((700, 3)), 1)  # many ties
    train = spark.createDataFrame([(i, i % 3, v) for i, v in enumerate(x[:500].tolist())], "id bigint, label int, vec array<double>").repartition(3)
    queries = spark.createDataFrame([(i + 500, v) for i, v in enumerate(x[500:].tolist())], "id bigint, vec array<double>")
    found = nb.nearest(train, queries, 7, p, chunk_rows=30)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "CartesianProduct" in plan
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.label, r.distance))
    for q in range(200):
        diff = np.abs(x[:500] - x[500 + q])
        d = diff.sum(1) if p == 1 else np.sqrt((diff**2).sum(1))
        want = sorted(range(500), key=lambda i: (d[i], i))[:7]
        assert [(i, c) for _, i, c, _ in sorted(got[500 + q])] == [(i, i % 3) for i in want]
        assert np.allclose([v for *_, v in sorted(got[500 + q])], d[want])
    monkeypatch.setattr(nb, "HELD_BYTES", 1 << 20)  # one partition of training rows: ranked as found
    assert {tuple(r) for r in nb.nearest(train, queries, 7, p, chunk_rows=30).collect()} == {tuple(r) for r in found.collect()}
    twice = nb.nearest(train, queries.union(queries.limit(3)), 7, p, chunk_rows=30)
    assert twice.count() == 1400 and twice.where("rank > 7").count() == 0  # queries of one id share their neighbours
    assert nb.nearest(train.limit(4), queries.limit(2), 7, p).count() == 8  # fewer rows than wanted


def test_a_neighbour_at_distance_zero_decides(spark):
    train = spark.createDataFrame([(1, 2, [0.0]), (2, 1, [0.1]), (3, 1, [0.1])], "id bigint, label int, vec array<double>")
    q = spark.createDataFrame([(9, [0.0])], "id bigint, vec array<double>")
    assert nb.knn_classify(train, q, 3, "distance").first().prediction == 2
    assert nb.knn_classify(train, q, 3, "uniform").first().prediction == 1


def test_vote_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([(4, 2, 0), (4, 4, 0), (1, 3, 3)], "a int, b int, c int")
    assert [r.prediction for r in cf.hard_vote(df, ["a", "b", "c"]).collect()] == [0, 4, 3]


def test_class_never_predicted_scores_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (2, 0)], "Label int, prediction int")
    confusion = ev.confusion_matrix(df, [0, 1, 2])
    assert confusion.count() == 9
    m = {r["class"]: r for r in ev.class_metrics(confusion).collect()}
    assert m[1].precision == 0 and m[1].recall == 0 and m[1].f1 == 0
    assert m[2].recall == 0.5 and m[2].precision == 1.0
    cross = MulticlassClassificationEvaluator(metricName="recallByLabel", metricLabel=2.0, labelCol="Label")
    assert cross.evaluate(df.selectExpr("cast(Label as double) Label", "cast(prediction as double) prediction")) == 0.5
    assert ev.metrics_table(ev.class_metrics(confusion), [0, 1, 2]).count() == 3


def test_silhouette_matches_the_built_in(frame):
    built_in = ClusteringEvaluator(predictionCol="label").evaluate(frame.withColumn("features", array_to_vector("vec")))
    assert ct.silhouette(frame, "vec", "label").first().score == pytest.approx(built_in)


def test_euclidean_silhouette_matches_all_pairs(spark, frame, points):
    x, y = np.array([p[2] for p in points]), np.array([p[1] for p in points])
    d = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    score = []
    for i in range(len(x)):
        a = d[i, y == y[i]].sum() / ((y == y[i]).sum() - 1)
        b = min(d[i, y == c].mean() for c in set(y.tolist()) - {int(y[i])})
        score.append((b - a) / max(a, b))
    assert ct.euclidean_silhouette(frame, "vec", "label", block_rows=64).first().score == pytest.approx(np.mean(score))
    with pytest.raises(ValueError):
        ct.euclidean_silhouette(frame, "vec", "label", most_rows=399)
    alone = spark.createDataFrame([(0, [0.0]), (0, [1.0]), (1, [9.0])], "label int, vec array<double>")
    assert ct.euclidean_silhouette(alone, "vec", "label").first().score == pytest.approx((8 / 9 + 7 / 8) / 3)
    assert ct.euclidean_silhouette(alone.limit(0), "vec", "label").first().score is None


def test_euclidean_silhouette_takes_any_number_of_rows_and_copies_no_blocks(spark, monkeypatch):
    n = 200_001  # the blocks are not worked off here, only planned
    many = spark.range(n).select(F.array(F.col("id").cast("double")).alias("vec"), (F.col("id") % 2).cast("int").alias("label"))
    plan = ct.euclidean_silhouette(many, "vec", "label", block_rows=4_096)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in text  # partitions are read beside each other, not shuffled in copies
    monkeypatch.setattr(ct, "PAIRED_BYTES", 1_024, raising=False)
    few = spark.range(300).select(F.array(F.sin("id"), F.cos(F.col("id") * 3)).alias("vec"), (F.col("id") % 3).cast("int").alias("label"))
    x, y = np.array([[np.sin(i), np.cos(3 * i)] for i in range(300)]), np.arange(300) % 3
    d = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    means = np.stack([d[:, y == c].sum(1) / ((y == c).sum() - (y == c)) for c in range(3)], 1)
    a, b = means[np.arange(300), y], np.where(np.arange(3) == y[:, None], np.inf, means).min(1)
    got = ct.euclidean_silhouette(few, "vec", "label", block_rows=16).first().score
    assert got == pytest.approx(((b - a) / np.maximum(a, b)).mean())


def test_runs_side_by_side_equal_single_runs(spark, frame, points):
    x = np.array([p[2] for p in points])
    blocks = km.pack_rows(frame)
    starts = km.start_centres(blocks, [2, 3, 5, 5], [1, 1, 1, 2])
    assert [len(s) for s in starts] == [2, 3, 5, 5] and not np.array_equal(starts[2], starts[3])
    together = km.run_kmeans(blocks, starts)
    for start, run in zip(starts, together, strict=True):
        alone = km.run_kmeans(blocks, [start])[0]
        assert np.allclose(alone.centres, run.centres) and alone.cost == pytest.approx(run.cost) and alone.passes == run.passes
        centres, moved = start.copy(), 1.0
        while moved > km.TOLERANCE:
            own = ((x[:, None] - centres) ** 2).sum(2).argmin(1)
            new = np.array([x[own == c].mean(0) if (own == c).any() else centres[c] for c in range(len(centres))])
            moved, centres = np.sqrt(((new - centres) ** 2).sum(1)).max(), new
        assert np.allclose(centres, run.centres) and run.cost == pytest.approx(((x[:, None] - centres) ** 2).sum(2).min(1).sum())
    scores = km.clustering_scores(blocks, {i: r.centres for i, r in enumerate(together)})
    for i, r in enumerate(together):
        labelled = ct.assign_nearest(frame, "vec", dict(enumerate(r.centres.tolist())))
        assert scores[i][0] == pytest.approx(ct.silhouette(labelled, "vec", "centre").first().score)
        assert scores[i][1] == pytest.approx(ct.calinski_harabasz(labelled, "vec", "centre").first().score)
    few = km.pack_rows(spark.createDataFrame([([1.0],), ([1.0],), ([2.0],)], "vec array<double>"))
    assert len(km.best_runs(few, [5], 2)[5].centres) == 2 and km.best_runs(few, [5], 2)[5].cost == 0


def test_segments_are_numbered_by_falling_amount(spark):
    rng = random.Random(1)
    rows = [(i, float(10 * (i % 4) + rng.random()), float(rng.random())) for i in range(200)]
    df = spark.createDataFrame(rows, "CustomerID bigint, Amount double, Recency double")
    done = ct.segment(df, ["Amount", "Recency"], k=4, restarts=4)
    means = [r[0] for r in done.customers.groupBy("Label").agg(F.avg("Amount")).orderBy("Label").select("avg(Amount)").collect()]
    assert len(means) == 4 and means == sorted(means, reverse=True)
    assert done.cost <= ct.segment(df, ["Amount", "Recency"], k=4, restarts=1).cost + 1e-9
    tree, rules = ct.explain_segments(done.customers, ["Amount", "Recency"])
    assert tree.depth <= 3 and rules.where(F.col("rule").contains("Amount")).count() > 0


def test_vote_beats_chance(spark, frame):
    data = frame.withColumn("label", F.col("label").cast("double"))
    grids = {
        "gbt": [{"learning_rate": 0.1, "n_estimators": 3, "max_depth": 2}],
        "lr": [{"C": c, "penalty": "l2"} for c in (0.01, 1.0)],
        "svm": [{"C": 1.0}],
    }
    vote, scores = cf.fit_vote(data, grids, folds=3)
    assert scores.count() == 2
    out = vote.transform(data)
    members = ["pred_gbt", "pred_lr", "pred_svm"]
    assert out.where(~F.col("prediction").isin(*[F.col(m) for m in members])).count() == 0
    assert ev.accuracy(out, "label").first().accuracy > 0.9


def test_assignment_holds_few_distances_at_a_time():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(3)
    x = rng.standard_normal((2048, 6))
    x[:64] = 0.0
    centres = {i: rng.standard_normal((5, 6)) for i in range(500)}
    centres[7] = np.vstack([np.ones(6), -np.ones(6), rng.standard_normal((3, 6)) + 9])  # the rows at 0 lie between the first two
    block = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([2048], pa.int32()), pa.array([x.tobytes()])], ["id", "n", "x"])
    tracemalloc.start()
    got = {r["run"]: np.array(r["sums"]) for b in km._assigned(centres)(iter([block])) for r in b.to_pylist()}
    near = km._least(x, centres)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for i in (0, 7, 499):
        d = ((x[:, None] - centres[i]) ** 2).sum(2)
        own = d.argmin(1)
        assert np.allclose(near[:, i], d.min(1)) and got[i][0] == pytest.approx(d.min(1).sum())
        moments = got[i][1:].reshape(5, -1)
        assert moments[:, 0].tolist() == np.bincount(own, minlength=5).tolist()
        assert np.allclose(moments[:, 1:-1], [x[own == c].sum(0) for c in range(5)])
    assert peak < 40e6  # all distances of the block would be 41 MB in one copy, and two were held


@pytest.mark.parametrize("p", [1, 2])
def test_closest_rows_are_those_of_all_differences(p, monkeypatch):
    rng = np.random.default_rng(6)
    a, b = rng.standard_normal((60, 8)), rng.standard_normal((900, 8))
    b[100:160] = b[7]  # more equal rows than are picked beyond those wanted
    b[200:260] = np.round(b[200:260])
    a[3], a[4] = b[7], b[7] + 1e-9
    d = np.abs(a[:, None] - b).sum(2) if p == 1 else np.sqrt(((a[:, None] - b) ** 2).sum(2))
    want = d.argsort(1, kind="stable")[:, :5]
    compared, plain = [], nb._distances
    monkeypatch.setattr(nb, "_distances", lambda x, y, q: compared.append(len(x) * len(y)) or plain(x, y, q))
    best, distance = nb._closest(a, b, 5, p)
    assert np.array_equal(best, want) and np.array_equal(distance, np.take_along_axis(d, want, 1))
    assert p == 1 or sum(compared) < 0.2 * a.shape[0] * b.shape[0]  # by differences only where rounding could tell


def test_distances_by_products_keep_near_rows():
    rng = np.random.default_rng(8)
    x, y = rng.standard_normal((300, 16)) + 50, rng.standard_normal((200, 16)) + 50
    y[:20], y[20:30] = x[:20], x[20:30] + 1e-9
    assert np.allclose(ct._far(x, y), np.sqrt(((x[:, None] - y) ** 2).sum(2)), rtol=1e-9, atol=0)
