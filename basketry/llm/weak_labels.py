"""Quality classifier from weak labels."""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from basketry.materialize import stored

#: Bound on the documents the scorer is fitted on.
TRAIN_ROWS = 20_000
FEATURE_BITS = 14
#: Updates of the scorer at least, and epochs at most; between them it stops once its loss settles.
LEAST_UPDATES, MOST_EPOCHS, SETTLED = 600, 400, 1e-3
LEAST_WORDS = 8
SEED = 8

_LETTERS = bytes(range(97, 123))
_SPACE = b" \t\n\x0b\x0c\r"
_PLAIN = b".,;:!?'\"()-"
#: Shape of a byte: lower case and beyond ASCII "a", upper case "A", digits "0", others as they are.
_SHAPE = bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))
_SYMBOLS = bytes(b for b in range(33, 128) if not chr(b).isalnum() and b not in _PLAIN)
_ENDS = (b".", b"!", b"?")
LABELLERS = ("symbols", "repeats", "marks", "word_length", "sentences", "lines", "given")
GOOD, BAD, SILENT = 1, 0, 2


def votes(text: bytes | None) -> list[int]:
    """What the heuristic labellers say about one text: good, bad or nothing. Each looks at one thing
    and keeps silent between its two limits and on texts of fewer than ``LEAST_WORDS`` words."""
    text = text or b""
    words = text.split()
    n = len(words)
    if n < LEAST_WORDS:
        return [SILENT] * (len(LABELLERS) - 1)

    def judge(x: float, good: float, bad: float) -> int:
        return GOOD if x <= good else BAD if x >= bad else SILENT

    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    repeats = sum(map(eq, words, words[1:]))
    marks = sum(1 for w in set(words) if not w.strip(_SYMBOLS + _PLAIN)) and sum(not w.strip(_SYMBOLS + _PLAIN) for w in words)
    letters = len(text) - text.count(b" ") - text.count(b"\n")
    mean = letters / n
    ends = sum(w.endswith(_ENDS) for w in words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    copies = len(lines) - len(set(lines))
    return [
        judge(symbols / max(letters, 1), 0.02, 0.08),
        judge(repeats / n, 0.02, 0.15),
        judge(marks / n, 0.01, 0.1),
        judge(abs(mean - 5.5), 2.5, 5.0),
        judge(abs(ends / n - 0.12), 0.1, 0.3) if ends or n < 40 else BAD,
        judge(copies / max(len(lines), 1), 0.1, 0.4) if len(lines) >= 4 else SILENT,
    ]


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of one text, of unit length: word shapes, doubled words and single symbols."""
    text = text or b""
    counts: dict[bytes, int] = {}
    for shape in text.translate(_SHAPE).split():
        counts[shape] = counts.get(shape, 0) + 1
    words = text.split()
    counts[b" again"] = sum(map(eq, words, words[1:]))
    for b in _SYMBOLS:
        if k := text.count(b):
            counts[b" " + bytes([b])] = k
    size = 1 << FEATURE_BITS
    at = np.array([xxh3_64_intdigest(w) % size for w in counts], np.int64)
    value = np.log1p(np.array(list(counts.values()), float) * 100 / max(len(words), 1))
    return at, value / max(np.sqrt((value**2).sum()), 1e-9)


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        said = [bytes(votes(t)).hex() for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(said, pa.string())], ["doc_id", "said"])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([a.astype(np.int32).tobytes() for a, _ in found], pa.binary()), pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary())],
            ["doc_id", "at", "value"],
        )


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """The posterior of "good" for every vote pattern (rows of 0, 1, 2) by expectation maximisation.

    Each labeller has an accuracy for good and one for bad documents, estimated from how it agrees
    with the others; a silent labeller says nothing. Starts from the majority, so that "good" keeps
    its meaning; priors of a few votes keep accuracies inside (0, 1).
    """
    good, bad = patterns == GOOD, patterns == BAD
    posterior = (good.sum(1) + 0.5) / (good.sum(1) + bad.sum(1) + 1.0)
    posterior = np.where(bad.sum(1) > 0, np.minimum(posterior, 0.5), np.maximum(posterior, 0.5))
    for _ in range(rounds):
        w1, w0 = counts * posterior, counts * (1 - posterior)
        right = (w1 @ good + 4) / (w1 @ (good | bad) + 5)
        wrong = (w0 @ good + 1) / (w0 @ (good | bad) + 5)
        prior = (w1.sum() + 1) / (counts.sum() + 2)
        logit = np.log(prior / (1 - prior)) + good @ np.log(right / wrong) + bad @ np.log((1 - right) / (1 - wrong))
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - posterior).max() < 1e-9:
            break
        posterior = new
    return posterior


def fit_scorer(rows: list[tuple[bytes, bytes, float]]) -> np.ndarray:
    """Logistic regression on hashed features and soft labels; the last weight is the intercept. Adagrad
    over fixed batches, so the result repeats. A small corpus gives few batches an epoch and so gets more epochs: they
    end after ``LEAST_UPDATES``, when the loss of an epoch has settled."""
    weights = np.zeros((1 << FEATURE_BITS) + 1)
    if not rows:
        weights[-1] = 1.0
        return weights
    target = np.array([r[2] for r in rows])
    at = [np.r_[np.frombuffer(r[0], np.int32), len(weights) - 1] for r in rows]
    value = [np.r_[np.frombuffer(r[1], np.float32), 0.3] for r in rows]
    power = np.full(len(weights), 1e-8)
    rng = np.random.default_rng(SEED)
    updates, before = 0, np.inf
    for _ in range(MOST_EPOCHS):
        order, loss = rng.permutation(len(rows)), 0.0
        for lo in range(0, len(order), 128):
            pick = order[lo : lo + 128]
            a, v = np.concatenate([at[i] for i in pick]), np.concatenate([value[i] for i in pick])
            own = np.repeat(np.arange(len(pick)), [len(at[i]) for i in pick])
            margin = np.bincount(own, weights[a] * v, len(pick))
            loss += float((np.logaddexp(0, margin) - target[pick] * margin).sum())
            error = 1 / (1 + np.exp(-margin)) - target[pick]
            slope = np.bincount(a, error[own] * v, len(weights)) / len(pick) + 1e-7 * weights
            power += slope**2
            weights -= 0.3 * slope / np.sqrt(power)
            updates += 1
        if updates >= LEAST_UPDATES and loss > before * (1 - SETTLED):
            break
        before = loss
    return weights


def scorer(weights: np.ndarray, text: Column) -> Column:
    """The fitted scorer as a column: the probability that a text is good."""
    held = weights.astype(np.float32)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            at, value = features(t)
            out.append(float(held[at] @ value + 0.3 * held[-1]))
        return pd.Series(1 / (1 + np.exp(-np.array(out, float))))

    return score(text.cast("binary"))


def fit_quality(docs: DataFrame, labels: DataFrame | None = None, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights of the quality scorer.

    All documents are labelled by the heuristics and, where ``labels`` (``doc_id, quality``) has them,
    by given labels as one more labeller; conflicting given labels count as silent. The accuracies
    come from the counts of vote patterns over all documents (one row per pattern). The scorer is
    fitted on a hash sample of about ``train_rows`` documents with their posteriors.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    voted = slim.mapInArrow(_voted, "doc_id long, said string")
    if labels is not None:
        given = (
            labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("of_id"))
            .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
            .select("of_id", F.when(F.col("low") == F.col("high"), F.col("low")).alias("given"))
        )
        voted = voted.join(given, F.col("doc_id") == F.col("of_id"), "left")
    else:
        voted = voted.withColumn("given", F.lit(None).cast("int"))
    vote = F.when(F.col("given") == 1, "01").when(F.col("given") == 0, "00").otherwise("02")
    voted = stored(voted.select("doc_id", F.concat("said", vote).alias("said")), "votes")
    counted = voted.groupBy("said").count().collect()  # at most 3 to the number of labellers
    if not counted:
        return fit_scorer([])
    patterns = np.array([list(bytes.fromhex(r["said"])) for r in counted])
    counts = np.array([r["count"] for r in counted], float)
    posterior = dict(zip((r["said"] for r in counted), fit_labellers(patterns, counts).tolist(), strict=True))
    share = min(1.0, train_rows / counts.sum())
    chosen = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
    sample = (
        slim.where(chosen).mapInArrow(_featured, "doc_id long, at binary, value binary")
        .join(voted.where(chosen).dropDuplicates(["doc_id"]), "doc_id").orderBy("doc_id", "at", "value").collect()  # bounded by train_rows
    )
    return fit_scorer([(r["at"], r["value"], posterior[r["said"]]) for r in sample])


def score_quality(docs: DataFrame, labels: DataFrame | None = None, train_rows: int = TRAIN_ROWS, least: float = 0.5) -> DataFrame:
    """``docs`` with ``quality_score`` and ``kept``: the scorer's probability that a text is good, and whether
    it is at least ``least``.

    Null and empty texts are scored like texts without words, alike for all of them; so are texts of
    spaces. Repeated rows get equal scores. Rows without an id are scored but not learnt from. Columns
    of ``docs`` with the new names are replaced. Empty input gives an empty result.
    """
    weights = fit_quality(docs, labels, train_rows)
    columns = [c for c in docs.columns if c not in ("quality_score", "kept")]
    scored = docs.select(*columns, scorer(weights, F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("quality_score"))
    return scored.withColumn("kept", F.col("quality_score") >= least)
