"""Classifiers, grid search, the majority vote and its storage."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import majority
from basketry.materialize import checkpointed
from basketry.operators.boosting import BoostedModel, search_boosted
from basketry.operators.linear import LinearModel, search_linear
from basketry.operators.neighbours import knn_votes, nearest
from basketry.operators.sampling import stratified_folds
from basketry.operators.scaling import Scaler
from basketry.schema import SEED
from basketry.sources.files import write_table


def _log_space(lo: float, hi: float, n: int) -> list[float]:
    return [10 ** (lo + (hi - lo) * i / (n - 1)) for i in range(n)]


# The published search grids.
KNN_GRID = [{"k": k, "weights": w, "p": p} for k in range(5, 71, 5) for w in ("uniform", "distance") for p in (1, 2)]
LOGISTIC_GRID = [{"C": c, "penalty": q} for c in _log_space(-3, 1, 10) for q in ("l1", "l2")]
SVM_GRID = [{"C": c, "penalty": q} for c in _log_space(-3, 1, 8) for q in ("l1", "l2")]
BOOSTED_GRID = [
    {"learning_rate": r, "n_estimators": n, "max_depth": d}
    for r in _log_space(-3, 0, 4)
    for n in (10, 100, 300)
    for d in (2, 3)
]
# The voters, in the order of the vote. Nearest neighbours are compared but do not vote.
GRIDS = {"gbt": BOOSTED_GRID, "lr": LOGISTIC_GRID, "svm": SVM_GRID}
VOTERS = tuple(GRIDS)


def search_voter(name: str, data: DataFrame, grid: Sequence[dict], folds: int) -> dict:
    """The search of one voter over every part of ``data`` (``part, label, fold, vec``): boosted trees on the deviance of
    the softmax, logistic regression, or a linear support vector classifier with squared hinge loss."""
    if name == "gbt":
        return search_boosted(data, grid, folds)
    return search_linear(data, {"lr": "logistic", "svm": "squared_hinge"}[name], grid, folds)


def model_input(df: DataFrame, columns: Sequence[str], id_col: str = "CustomerID", label: str = "Label") -> DataFrame:
    """``id``, ``label`` (double), ``vec`` (array) and ``features`` (vector), plus carried flags."""
    carried = [c for c in ("is_test", "fold", "part") if c in df.columns]
    vec = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(
        F.col(id_col).alias("id"), F.col(label).cast("double").alias("label"), vec.alias("vec"), *carried
    ).withColumn("features", array_to_vector("vec"))


def folded(train: DataFrame, folds: int, seed: int = SEED) -> DataFrame:
    """``part, label, fold, vec`` of the training rows, stored for many passes. Without a column ``part`` all rows are one
    part; without folds every row is in fold 0."""
    rows = train if "part" in train.columns else train.withColumn("part", F.lit(0))
    dealt = stratified_folds(rows, "id", "label", folds, seed, by=["part"]) if folds else rows.withColumn("fold", F.lit(0))
    return checkpointed(dealt.select(F.col("part").cast("int"), "label", "fold", "vec"))


def grid_search(name: str, train: DataFrame, grid: Sequence[dict], folds: int = 5, seed: int = SEED) -> tuple[dict, list[tuple[dict, float]]]:
    """Stratified cross-validation of every grid point of a voter by accuracy, over the rows of ``train`` (``id, label, vec``).

    Returns the best parameters (first of equals) and the mean score per grid point.
    """
    found = search_voter(name, folded(train, folds, seed), grid, folds)[0]
    return grid[found.best], list(zip(grid, found.scores, strict=True))


def knn_grid_search(
    train: DataFrame, grid: Sequence[dict] = tuple(KNN_GRID), folds: int = 5, seed: int = SEED
) -> tuple[dict, list[tuple[dict, float]]]:
    """Cross-validated nearest-neighbour grid: one neighbour search per (fold, metric) at the
    largest k answers every k and both weightings."""
    deepest = max(g["k"] for g in grid)
    folded = stratified_folds(train, "id", "label", folds, seed).select("id", "label", "vec", "fold")
    folded = folded.persist(StorageLevel.MEMORY_AND_DISK)
    totals: dict[tuple, list[float]] = {}
    try:
        for fold in range(folds):
            held, rest = folded.where(F.col("fold") == fold), folded.where(F.col("fold") != fold)
            truth = held.select(F.col("id").alias("query_id"), F.col("label").cast("int"))
            for p in sorted({g["p"] for g in grid}):
                near = nearest(rest, held, deepest, p).persist(StorageLevel.MEMORY_AND_DISK)
                for w in sorted({g["weights"] for g in grid}):
                    ks = sorted({g["k"] for g in grid if g["p"] == p and g["weights"] == w})
                    hits = (
                        knn_votes(near, ks, w).join(truth, "query_id").groupBy("k")
                        .agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("score"))
                    )
                    for r in hits.collect():
                        totals.setdefault((r["k"], w, p), []).append(r["score"])
                near.unpersist()
    finally:
        folded.unpersist()
    means = [sum(s) / len(s) for s in (totals[g["k"], g["weights"], g["p"]] for g in grid)]
    best = max(range(len(grid)), key=lambda i: (means[i], -i))
    return grid[best], list(zip(grid, means))


def grid_table(spark: SparkSession, model: str, scores: Sequence[tuple[dict, float]]) -> DataFrame:
    """Grid scores as rows: ``model``, ``params`` (JSON text), ``score``."""
    return spark.createDataFrame(
        [(model, json.dumps(p, sort_keys=True), float(s)) for p, s in scores],
        "model string, params string, score double",
    )


@dataclass
class VoteModel:
    """The fitted voters. All of them score the same row in one pass; no join is needed."""

    members: dict[str, LinearModel | BoostedModel]

    def transform(self, data: DataFrame) -> DataFrame:
        out = data
        for name, model in self.members.items():
            out = model.transform(out).withColumnRenamed("prediction", f"pred_{name}")
        return hard_vote(out, [f"pred_{name}" for name in self.members])


def hard_vote(predictions: DataFrame, members: Sequence[str]) -> DataFrame:
    """Add ``prediction``: the majority of the member columns of each row, ties to the smallest."""
    voted = predictions.withColumn("_votes", F.array(*members))
    return voted.withColumn("prediction", majority(F.col("_votes"))).drop("_votes")


def fit_votes(
    train: DataFrame, grids: dict[str, Sequence[dict]] | None = None, folds: int = 5, seed: int = SEED
) -> tuple[dict[int, VoteModel], DataFrame]:
    """A vote per part of ``train`` (``id, label, vec``, and ``part`` if there are several): each voter's grid is searched
    over all parts together and the best point of each part, fitted on all its rows, votes. Also the
    scores of all grid points. A grid of one point is fitted without a search. The voters are fitted side by side."""
    grids = grids or GRIDS
    members: dict[int, dict] = {}
    table = []
    folds_of = {name: folds if len(grids[name]) > 1 else 0 for name in VOTERS}
    rows = {n: folded(train, n, seed) for n in sorted(set(folds_of.values()))}
    search = inheritable_thread_target(train.sparkSession)(lambda name: search_voter(name, rows[folds_of[name]], grids[name], folds_of[name]))
    with ThreadPool(len(VOTERS)) as pool:
        done = pool.map(search, VOTERS, chunksize=1)
    for name, found in zip(VOTERS, done, strict=True):
        grid = grids[name]
        if folds_of[name]:
            table += [(p, name, json.dumps(g, sort_keys=True), float(x)) for p, s in found.items() for g, x in zip(grid, s.scores, strict=True)]
        for p, s in found.items():
            members.setdefault(p, {})[name] = s.models[s.best if s.scores else 0]
    scores = train.sparkSession.createDataFrame(table, "part int, model string, params string, score double")
    return {p: VoteModel(m) for p, m in members.items()}, scores


def fit_vote(
    train: DataFrame, grids: dict[str, Sequence[dict]] | None = None, folds: int = 5, seed: int = SEED
) -> tuple[VoteModel, DataFrame]:
    """``fit_votes`` for training rows that are one part."""
    votes, scores = fit_votes(train.drop("part"), grids, folds, seed)
    return votes[0], scores.drop("part")


_KINDS = {"linear": LinearModel, "boosted": BoostedModel}
_BUNDLE = "name string, sha256 string, payload string"


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def save_bundle(
    spark: SparkSession, path: str, horizon: int, scaler: Scaler, vote: VoteModel, columns: Sequence[str], scores: Sequence[tuple] = ()
) -> None:
    """Store what scoring at one horizon needs below ``path``: the scaler, the voters, the input columns in order and the grid
    scores, with a manifest of their content hashes."""
    parts = {"scaler": json.dumps(scaler.stats), "columns": json.dumps(list(columns)), "grid_scores": json.dumps([list(s) for s in scores])}
    parts |= {f"member:{name}": model.to_json() for name, model in vote.members.items()}
    manifest = json.dumps({"horizon": horizon, "members": list(vote.members), "sha256": {k: _digest(v) for k, v in parts.items()}})
    rows = [(k, _digest(v), v) for k, v in (parts | {"manifest": manifest}).items()]
    write_table(spark.createDataFrame(rows, _BUNDLE).coalesce(1), f"{path}/horizon={horizon}")


def load_bundle(spark: SparkSession, path: str, horizon: int, columns: Sequence[str]) -> tuple[Scaler, VoteModel]:
    """Scaler and vote as stored. Raises if a part is missing or not what the manifest says, or if the model was fitted on other
    columns, or the same in another order, than ``columns``."""
    parts = {r["name"]: r["payload"] for r in spark.read.parquet(f"{path}/horizon={horizon}").collect()}  # a few rows
    manifest = json.loads(parts["manifest"])
    wrong = [k for k, want in manifest["sha256"].items() if k not in parts or _digest(parts[k]) != want]
    if wrong or manifest["horizon"] != horizon:
        raise ValueError(f"stored model does not match its manifest: {wrong or manifest['horizon']}")
    if json.loads(parts["columns"]) != list(columns):
        raise ValueError("the model was fitted on other columns")
    members = {}
    for name in manifest["members"]:
        payload = parts[f"member:{name}"]
        members[name] = _KINDS[json.loads(payload)["kind"]].from_json(payload)
    return Scaler({c: (m, s) for c, (m, s) in json.loads(parts["scaler"]).items()}), VoteModel(members)
