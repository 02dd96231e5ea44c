"""Many k-means runs side by side, and the scores of their clusterings.

A sweep over the number of clusters with restarts is hundreds of runs over the same rows. The rows are
packed into blocks once; each pass assigns every row to the nearest centre of every run that is still
open and sums up the new centres of all of them. Runs stop one by one. What a pass returns has the size of the
centres, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.materialize import checkpointed
from basketry.schema import SEED

BLOCK_ROWS = 2_048
INIT_ROUNDS = 2
MAX_ITER = 100
TOLERANCE = 1e-4
#: Distances that are held at a time, so that memory does not grow with the runs.
HELD_DISTANCES = 524_288
_SUMS = "run int, sums array<double>"


@dataclass
class Run:
    """The centres of one run, the sum of squared distances to them, and the passes it took."""

    centres: np.ndarray
    cost: float = float("inf")
    passes: int = 0


def pack_rows(rows: DataFrame, vec: str = "vec") -> DataFrame:
    """``id, n, x``: up to ``BLOCK_ROWS`` vectors each, stored, so that every later pass sees the same blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            width = len(column[0]) if len(column) else 0
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            parts = [x[lo : lo + BLOCK_ROWS] for lo in range(0, len(x), BLOCK_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array([len(p) for p in parts], pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["n", "x"])

    blocks = rows.select(F.col(vec).cast("array<double>").alias("vec")).mapInArrow(run, "n int, x binary")
    return checkpointed(blocks.withColumn("id", F.monotonically_increasing_id()))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        for r in batch.to_pylist():
            yield r["id"], np.frombuffer(r["x"]).reshape(r["n"], -1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances; by differences, so that equal rows are at exactly 0."""
    out = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        out += (x[:, j, None] - centres[:, j]) ** 2
    return out


def _rows(found: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.list_(pa.float64()))], ["run", "sums"])


def _products(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Squared distances (centre, row) less the rows' squared norms, by one matrix product; the norms; and how far rounding can reach in
    every row. Both sides are moved next to the origin first, so that little is lost."""
    origin = centres.mean(0)
    v, c = x - origin, centres - origin
    norms, own = (v**2).sum(1), (c**2).sum(1)
    return own[:, None] - (2 * c) @ v.T, norms, 1e-12 * (norms + own.max())


def _owners(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which centre (of ``centre, run, number``) every row of every run goes to, as true and false, and the runs' costs. Where the products
    cannot tell two centres apart the differences decide."""
    k, runs, _ = centres.shape
    d, norms, slack = _products(x, centres.reshape(k * runs, -1))
    d = d.reshape(k, runs, len(x))
    least = d.min(0)
    near = d <= least + slack
    run, row = np.nonzero(near.sum(0, dtype=np.int32) > 1)
    if len(run):
        exact = ((x[row, None] - centres[:, run].transpose(1, 0, 2)) ** 2).sum(2).argmin(1)
        near[:, run, row] = False
        near[exact, run, row] = True
    return near, np.maximum(least + norms, 0.0).sum(1)


def _assigned(centres: dict[int, np.ndarray]):
    """Per run: the cost, and for every centre the number, the sum and the sum of squared norms of its rows. Runs with as
    many centres are worked off together, some rows at a time; two matrix products do most of it."""
    alike: dict[int, list[int]] = {}
    for i, c in centres.items():
        alike.setdefault(len(c), []).append(i)
    together = {k: np.stack([centres[i] for i in ids], 1) for k, ids in alike.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: (np.zeros(len(ids)), 0.0) for k, ids in alike.items()}
        seen = False
        for _, x in _vectors(batches):
            seen = True
            wide = np.c_[np.ones(len(x)), x, (x**2).sum(1)]
            for k, points in together.items():
                cost, moments = total[k]
                step = max(1, HELD_DISTANCES // max(1, k * points.shape[1]))
                for lo in range(0, len(x), step):
                    near, lost = _owners(x[lo : lo + step], points)
                    cost = cost + lost
                    moments = moments + near.reshape(-1, near.shape[2]).astype(float) @ wide[lo : lo + step]
                total[k] = cost, moments
        if seen:
            sums = {k: np.c_[cost, moments.reshape(k, len(cost), -1).transpose(1, 0, 2).reshape(len(cost), -1)] for k, (cost, moments) in total.items()}
            yield _rows({i: row for k, ids in alike.items() for i, row in zip(ids, sums[k], strict=True)})

    return run


def _least(x: np.ndarray, candidates: dict[int, np.ndarray]) -> np.ndarray:
    """Squared distance of every row to the nearest candidate of every run; 0 if no more than rounding."""
    starts = np.r_[0, np.cumsum([len(c) for c in candidates.values()])[:-1]]
    points = np.concatenate(list(candidates.values()))
    out = np.empty((len(x), len(starts)))
    step = max(1, HELD_DISTANCES // len(points))
    for lo in range(0, len(x), step):
        d, norms, slack = _products(x[lo : lo + step], points)
        least = np.minimum.reduceat(d, starts, axis=0) + norms
        out[lo : lo + step] = np.where(least <= slack, 0.0, least).T
    return out


def _summed(blocks: DataFrame, task) -> dict[int, np.ndarray]:
    found = blocks.mapInArrow(task, _SUMS).groupBy("run").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    return {r["run"]: np.array(r["sums"]) for r in found.collect()}  # one row per run


def run_kmeans(blocks: DataFrame, starts: Sequence[np.ndarray], max_iter: int = MAX_ITER, tolerance: float = TOLERANCE) -> list[Run]:
    """Lloyd's iteration of every run from its own start, all runs in the same passes. A run stops when no centre moves
    by more than ``tolerance``, or after ``max_iter`` moves; a centre without rows stays where it is. The cost is that of the
    centres returned."""
    runs = [Run(np.array(s, float)) for s in starts]
    still = dict.fromkeys(range(len(runs)), True)
    while still:
        sums = _summed(blocks, _assigned({i: runs[i].centres for i in still}))
        for i in list(still):
            if i not in sums:
                return runs
            run, k = runs[i], len(runs[i].centres)
            run.cost, run.passes = float(sums[i][0]), run.passes + 1
            parts = sums[i][1:].reshape(k, -1)
            n = parts[:, :1]
            new = np.where(n > 0, parts[:, 1:-1] / np.maximum(n, 1), run.centres)
            if not still[i] or run.passes > max_iter:
                del still[i]
                continue
            # Centres that have settled are measured once more, so that cost and centres belong together.
            still[i] = bool(np.sqrt(((new - run.centres) ** 2).sum(1)).max() > tolerance)
            run.centres = new
    return runs


def _picked(candidates: dict[int, np.ndarray], costs: dict[int, float], wanted: dict[int, int], seeds: dict[int, int], round_: int):
    """Rows drawn for each run with chances in proportion to their distance from the candidates so far. The draw
    follows from the run, the round and the block, so a task run again draws the same rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x in _vectors(batches):
            found = {}
            for i, near in zip(candidates, _least(x, candidates).T, strict=True):
                chance = 2 * wanted[i] * near / costs[i] if costs[i] > 0 else np.zeros(len(x))
                drawn = np.random.default_rng([seeds[i], round_, block]).random(len(x)) < chance
                if drawn.any():
                    found[i] = x[drawn].ravel()
            if found:
                yield _rows(found)

    return run


def _costs(candidates: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(candidates))
        for _, x in _vectors(batches):
            total += _least(x, candidates).sum(0)
        yield _rows({i: np.array([v]) for i, v in zip(candidates, total, strict=True)})

    return run


def _plus_plus(points: np.ndarray, weights: np.ndarray, k: int, rng) -> np.ndarray:
    """k-means++ on weighted points."""
    chosen = [int(rng.choice(len(points), p=weights / weights.sum()))]
    near = _distances(points, points[chosen]).min(1)
    while len(chosen) < min(k, len(points)):
        chance = weights * near
        nxt = int(rng.choice(len(points), p=chance / chance.sum())) if chance.sum() > 0 else int(np.setdiff1d(np.arange(len(points)), chosen)[0])
        chosen.append(nxt)
        near = np.minimum(near, _distances(points, points[[nxt]])[:, 0])
    return points[chosen]


def start_centres(blocks: DataFrame, ks: Sequence[int], seeds: Sequence[int]) -> list[np.ndarray]:
    """Starts of many runs by scalable k-means++ (k-means||): rounds that draw about 2k rows each, whose weighted k-means++
    gives the centres. One start per (k, seed), all in the same passes. The rows drawn are bounded by k and the rounds.
    With fewer different rows than k there are fewer centres."""
    first: dict[int, np.ndarray] = {}
    heads = blocks.select("id", "n").collect()  # one small row per block
    if not heads:
        return [np.zeros((0, 0)) for _ in ks]
    heads = sorted((r["id"], r["n"]) for r in heads)
    ends = np.cumsum([n for _, n in heads])
    rngs = [np.random.default_rng([SEED, k, seed]) for k, seed in zip(ks, seeds, strict=True)]
    spots: dict[int, list[tuple[int, int]]] = {}
    for i, rng in enumerate(rngs):
        at = int(rng.integers(ends[-1]))
        b = int(np.searchsorted(ends, at, side="right"))
        spots.setdefault(heads[b][0], []).append((i, at - int(ends[b] - heads[b][1])))

    def heads_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x in _vectors(batches):
            if block in spots:
                yield _rows({i: x[at] for i, at in spots[block]})

    for r in blocks.mapInArrow(heads_of, _SUMS).collect():  # one row per run
        first[r["run"]] = np.array(r["sums"])[None]
    candidates, wanted, own = first, dict(enumerate(ks)), dict(enumerate(seeds))
    for round_ in range(INIT_ROUNDS):
        costs = {i: float(s[0]) for i, s in _summed(blocks, _costs(candidates)).items()}
        for r in blocks.mapInArrow(_picked(candidates, costs, wanted, own, round_), _SUMS).orderBy("run", "sums").collect():  # about 2k rows per run
            width = candidates[r["run"]].shape[1]
            candidates[r["run"]] = np.r_[candidates[r["run"]], np.array(r["sums"]).reshape(-1, width)]
    candidates = {i: np.unique(c, axis=0) for i, c in candidates.items()}
    counted = _summed(blocks, _assigned(candidates))
    out = []
    for i, k in enumerate(ks):
        weights = counted[i][1:].reshape(len(candidates[i]), -1)[:, 0]
        out.append(_plus_plus(candidates[i], np.maximum(weights, 1e-12), k, rngs[i]))
    return out


def best_runs(blocks: DataFrame, ks: Sequence[int], restarts: int, seed: int = SEED, max_iter: int = MAX_ITER) -> dict[int, Run]:
    """The cheapest of ``restarts`` runs for every k (the first of equals)."""
    runs = [(k, seed + i) for k in ks for i in range(restarts)]
    done = run_kmeans(blocks, start_centres(blocks, [k for k, _ in runs], [s for _, s in runs]), max_iter)
    out: dict[int, Run] = {}
    for (k, _), run in zip(runs, done, strict=True):
        if k not in out or run.cost < out[k].cost:
            out[k] = run
    return out


def clustering_scores(blocks: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, tuple[float | None, float | None]]:
    """Mean silhouette (squared distances) and Calinski-Harabasz score of several clusterings, given as centres: one pass for the
    moments of all clusters and one for the rows' silhouettes."""
    moments = {i: s[1:].reshape(len(centres[i]), -1) for i, s in _summed(blocks, _assigned(centres)).items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {i: np.zeros(2) for i in moments}
        for _, x in _vectors(batches):
            norms = (x**2).sum(1)
            for i, m in moments.items():
                own = _distances(x, centres[i]).argmin(1)
                n, rows = m[:, 0], np.arange(len(x))
                means, squares = m[:, 1:-1] / np.maximum(n, 1)[:, None], m[:, -1] / np.maximum(n, 1)
                far = norms[:, None] + squares - 2 * x @ means.T
                a = far[rows, own] * n[own] / np.maximum(n[own] - 1, 1)
                far[rows, own] = np.inf
                far[:, n == 0] = np.inf
                b = far.min(1)
                top = np.maximum(a, b)
                score = np.where((n[own] == 1) | ~np.isfinite(b) | (top <= 0), 0.0, (b - a) / np.where(top > 0, top, 1))
                total[i] += [score.sum(), len(x)]
        yield _rows(total)

    silhouettes = _summed(blocks, run)
    out = {}
    for i, m in moments.items():
        m = m[m[:, 0] > 0]
        n, k = m[:, 0].sum(), len(m)
        explained = ((m[:, 1:-1] ** 2).sum(1) / m[:, 0]).sum()
        between = explained - (m[:, 1:-1].sum(0) ** 2).sum() / n
        within = m[:, -1].sum() - explained
        harabasz = float((between / (k - 1)) / (within / (n - k))) if k > 1 and n > k and within > 0 else None
        out[i] = (float(silhouettes[i][0] / silhouettes[i][1]), harabasz)
    return out
