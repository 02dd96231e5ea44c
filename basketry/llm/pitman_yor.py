"""Language-model scoring with a hierarchical Pitman-Yor model.

A token is predicted from the word before it. The previous word picks one of ``CONTEXTS`` restaurants
by its hash, so that frequent words have one nearly to themselves and rare ones share. Words are
dealt into classes by hash, as many as keep a class within one task's memory, and

    p(word | context) = p(class | context) * p(word | context, class).

Inside a class every context has a restaurant with Pitman-Yor seating, and all share one parent, the
restaurant of the class's words; tables of the children are customers of the parent. All counts
of a class are in one place, so seatings are sampled by Gibbs where the counts are, and a document's
score is a sum of what its words' classes send back.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.hashing import U64, mix, slot, split_words, word_hashes
from basketry.materialize import stored

CONTEXT_BITS = 12
CONTEXTS = 1 << CONTEXT_BITS
CLASS_TOKENS = 250_000
FLUSH_TOKENS = 4_000_000
DISCOUNT, STRENGTH = 0.75, 1.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.6, 1.0
#: Customers a context needs before its own choice of classes counts as much as the overall one.
CLASS_STRENGTH = 8.0
SWEEPS, BURN_IN, EVERY = 10, 4, 2
#: Pairs of a context are drawn in so many blocks a sweep.
BLOCKS = 8
#: Dishes with up to so many customers are weighed with listed Stirling numbers, others with integrals over so many points.
LISTED, POINTS = 1024, 32
#: Dishes between two of these numbers of customers are weighed together.
WIDTHS = [1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 40, 48, 64, 96, 128, 192, 256, 384, 512, 768, LISTED]
#: Weights held at once, and weights beside the middle one that are only rounding.
CELLS, ROUNDING = 1 << 18, 1e-11
HELD_OUT = (7, 2)
SEED = 6
_LOW = U64(CONTEXTS - 1)
_END = word_hashes([b"\n"])
_START = word_hashes([b""])


def is_held_out(doc_id) -> bool:
    parts, part = HELD_OUT
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % parts == part


def pair_keys(text: bytes | None) -> np.ndarray:
    """A 64-bit key per token, the end token included: 52 bits of the word's hash, then the context."""
    h = word_hashes(split_words(text))
    contexts = slot(np.concatenate([_START, h]), CONTEXTS)
    return (mix(np.concatenate([h, _END])) & ~_LOW) | contexts


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    return zip(batch.column("doc_id").to_pylist(), map(pair_keys, batch.column("text").cast(pa.binary()).to_pylist()), strict=True)


def _context_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, learnt = 0, np.zeros(CONTEXTS, np.int64)
    for batch in batches:
        for doc, keys in _documents(batch):
            seen += len(keys)
            if not is_held_out(doc):
                learnt += np.bincount((keys & _LOW).astype(np.int64), minlength=CONTEXTS)
    at = np.flatnonzero(learnt)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.r_[-1, at], pa.int64()), pa.array(np.r_[seen, learnt[at]], pa.int64())], ["context", "n"]
    )


_PACKED = "p long, base long, pairs binary, uses binary, docs binary"


def _packed(classes: int):
    """Tokens by class: the distinct pairs of a run of documents, how often each occurs, and for every
    occurrence the document (its distance from the run's smallest id, doubled, plus 1 if held out)."""

    def rows(docs: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        base = min(d for d, _ in docs)
        keys = np.concatenate([k for _, k in docs])
        named = np.array([(d - base) * 2 + is_held_out(d) for d, _ in docs], np.int64)
        of = np.repeat(named.astype(np.int32) if named.max() < 2**31 else named, [len(k) for _, k in docs])
        order = np.argsort(keys)
        keys, of = keys[order], of[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        pairs, uses = keys[starts], np.diff(np.r_[starts, len(keys)]).astype(np.int32)
        p = slot(pairs, classes)
        cuts = np.flatnonzero(np.r_[True, p[1:] != p[:-1], True])
        ends = np.r_[starts, len(keys)]
        out = [[], [], [], [], []]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            row = (int(p[lo]), int(base), pairs[lo:hi].tobytes(), uses[lo:hi].tobytes(), of[ends[lo] : ends[hi]].tobytes())
            for column, value in zip(out, row, strict=True):
                column.append(value)
        types = [pa.int64(), pa.int64(), *[pa.binary()] * 3]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], ["p", "base", "pairs", "uses", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc, keys in _documents(batch):
                held.append((doc, keys))
                size += len(keys)
                if size >= FLUSH_TOKENS:
                    yield from rows(held)
                    held, size = [], 0
        if held:
            yield from rows(held)

    return run


def _stirling(discount: float, most: int) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: the weight of all ways to seat c customers at t tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(most):
        t = np.arange(1, c + 2)
        stay = np.log(np.maximum(c - discount * t, 1e-300)) + out[c, 1 : c + 2]
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c, : c + 1], stay)
    return out


_WAYS = {d: _stirling(d, LISTED) for d in (DISCOUNT, PARENT_DISCOUNT)}


def _listed_tables(customers: np.ndarray, others: np.ndarray, base: np.ndarray, discount: float, strength: float, rng) -> np.ndarray:
    """``draw_tables`` for dishes of at most ``LISTED`` customers: weights of all numbers of tables, side by side."""
    c = int(customers.max())
    t = np.arange(1, c + 1)
    opening = np.cumsum(np.log(strength + discount * (others[:, None] + t - 1)), axis=1)
    weight = opening + _WAYS[discount][customers, 1 : c + 1] + t * np.log(base)[:, None]
    upto = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), axis=1)
    return 1.0 + (upto < (rng.random(len(others)) * upto[:, -1])[:, None]).sum(1)


class _Contour:
    """The weights of numbers of tables of dishes with so many customers that their Stirling numbers are not listed.

    S(c, t) = c! / (d^t t!) [z^c] f^t with f = 1 - (1-z)^d. As an integral along a path of s = -log z, and by parts, the weight
    of t tables is in proportion to

        (a+1)(a+2)...(a+t-1) / (t-1)! * base^(t-1) * integral of e^((c-1)s) (1-e^-s)^(d-1) f^(t-1) ds,  a = strength/d + others.

    The path crosses the real axis at the saddle point of the sum over all t and bends to the left like its steepest descent, so
    few points give a row's weights to about 12 digits of the largest one whatever c is.
    """

    def __init__(self, customers: np.ndarray, others: np.ndarray, base: np.ndarray, discount: float, strength: float):
        d, self.c, self.a, self.base = discount, customers.astype(np.float64), strength / discount + others, base
        low = np.log(np.log1p((1 - d) / (self.c - 1)))
        high = np.log(np.maximum(1.0, np.log(4 * (self.a + 2) / (self.c - 1))))
        for _ in range(24):  # the path need not meet the saddle point to the last digit
            x = (low + high) / 2
            z, v, f = self._terms(np.exp(x), d)
            over = (1 - d) * z / v + (self.a + 1) * base * d * z * v ** (d - 1) / (1 - base * f) > self.c - 1
            low, high = np.where(over, x, low), np.where(over, high, x)
        saddle = np.exp((low + high) / 2)
        z, v, f = self._terms(saddle, d)
        #: Tables but one: their middle and how far they spread.
        self.middle = (self.a + 1) * base * f / (1 - base * f)
        slope = d * z * v ** (d - 1) / f
        curved = (1 - d) * z / v**2 + self.middle * np.maximum(d * z * v ** (d - 2) * (v + (1 - d) * z) / f - slope**2, 0.0)
        self.spread = 1 / np.sqrt((1 - base * f) / self.middle + slope**2 / curved)
        start = np.maximum(saddle, 4 / (self.c - 1))
        end = np.minimum(np.pi, 9 / np.sqrt(np.where(start > saddle, (1 - d) * (self.c - 1) / start, curved)))
        y = end[:, None] * np.arange(POINTS + 1) / POINTS
        bend = np.where(start < 1, 0.25 / start, 0.0)[:, None]
        s = start[:, None] + 1j * y - bend * y**2
        log_v, log_v0 = np.log(-np.expm1(-s)), np.log(-np.expm1(-start))[:, None]
        log_f0 = np.log(-np.expm1(d * log_v0))
        self.grow = np.log(-np.expm1(d * log_v)) - log_f0
        self.ahead = (self.c - 1)[:, None] * (s - start[:, None]) + (d - 1) * (log_v - log_v0)
        self.share = 1 + 2j * bend * y
        self.share[:, 0] *= 0.5
        self.share[end >= np.pi, -1] *= 0.5  # the path has come round
        self.ratio = base * np.exp(log_f0[:, 0])

    @staticmethod
    def _terms(s: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        v = -np.expm1(-s)
        return np.exp(-s), v, -np.expm1(d * np.log(v))

    def weights(self, at: np.ndarray, low: np.ndarray, width: int) -> np.ndarray:
        """Weights of ``low + 1 .. low + width`` tables for the dishes ``at``."""
        grow = self.grow[at][:, None, :]
        step = 1 << (width.bit_length() // 2)
        first = self.share[at] * np.exp(self.ahead[at] + low[:, None] * self.grow[at])
        sums = (first[:, None, :] * np.exp(np.arange(0, width, step)[:, None] * grow)) @ np.exp(grow.transpose(0, 2, 1) * np.arange(step))
        t = low[:, None] + np.arange(width)
        prior = np.zeros(t.shape)
        prior[:, 1:] = np.cumsum(np.log(self.ratio[at][:, None] * (self.a[at][:, None] + t[:, 1:]) / t[:, 1:]), axis=1)
        found = np.exp(prior - prior.max(1, keepdims=True)) * sums.real.reshape(len(at), -1)[:, :width]
        return np.where(t < self.c[at][:, None], np.maximum(found, 0.0), 0.0)

    def around_middle(self, at: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The weights from the middle out to where they are lost in rounding, and whether ``low`` and ``width`` reach that far."""
        found, place = self.weights(at, low, width), np.arange(width)
        middle = np.clip(np.rint(self.middle[at] - low), 0, np.minimum(width, self.c[at] - low) - 1).astype(np.int64)[:, None]
        lost = found < ROUNDING * np.take_along_axis(found, middle, 1)
        left = np.where(lost & (place < middle), place, -1).max(1)
        right = np.where(lost & (place > middle), place, width).min(1)
        found[(place <= left[:, None]) | (place >= right[:, None])] = 0.0
        return found, ((left >= 0) | (low == 0)) & ((right < width) | (low + width >= self.c[at]))


def _unlisted_tables(customers: np.ndarray, others: np.ndarray, base: np.ndarray, discount: float, strength: float, rng) -> np.ndarray:
    """``draw_tables`` for dishes of any number of customers above ``LISTED``."""
    contour = _Contour(customers, others, base, discount, strength)
    tables, chance = np.ones(len(customers)), rng.random(len(customers))
    todo, reach = np.arange(len(customers)), 7.5
    while len(todo):
        off = reach * contour.spread[todo] + 16
        low = np.maximum(np.floor(contour.middle[todo] - off), 0.0)
        widths = np.minimum(np.ceil(contour.middle[todo] + off), contour.c[todo] - 1) - low + 1
        sizes = np.int64(1) << np.ceil(np.log2(widths)).astype(np.int64)
        again = []
        for size in np.unique(sizes):
            alike = np.flatnonzero(sizes == size)
            for part in np.array_split(alike, -(-len(alike) * size // CELLS)):
                if len(part):
                    found, whole = contour.around_middle(todo[part], low[part], int(size))
                    upto = np.cumsum(found, axis=1)
                    tables[todo[part]] = low[part] + 1 + (upto < (chance[todo[part]] * upto[:, -1])[:, None]).sum(1)
                    again.append(todo[part][~whole])
        todo, reach = np.concatenate(again), reach * 2
    return tables


def draw_tables(customers: np.ndarray, others: np.ndarray, base: np.ndarray, discount: float, strength: float, rng) -> np.ndarray:
    """New numbers of tables for dishes with ``customers`` (at least 1) each: all customers of a dish leave and are seated again given
    the other dishes. Every number is drawn from its own distribution given everything else, whatever the number of customers: ``others``
    tables in the same restaurant, ``base`` the parent's probability of the dish."""
    tables = np.ones(len(customers))
    order = np.argsort(customers, kind="stable")
    sizes = customers[order]
    cuts = [*np.searchsorted(sizes, WIDTHS, side="right"), len(order)]
    for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        draw, width = (_listed_tables, WIDTHS[i + 1]) if i + 1 < len(WIDTHS) else (_unlisted_tables, 1)
        for at in np.array_split(order[lo:hi], -(-(hi - lo) * width // CELLS)) if hi > lo else ():
            tables[at] = draw(customers[at], others[at], base[at], discount, strength, rng)
    return tables


class Seating:
    """The restaurants of one class. ``word`` and ``context`` number the distinct pairs, ``count`` is how
    often each was seen in training; words and contexts are numbered from 0 within the class.

    What matters of a seating is the number of tables of every pair. A sweep draws it anew for all pairs, block by block: the
    pairs of one context are dealt over ``BLOCKS`` blocks, so that those drawn together are few, and then for all words in the
    parent, whose customers are the tables of the pairs.
    """

    def __init__(self, word: np.ndarray, context: np.ndarray, count: np.ndarray, rng):
        self.word, self.context, self.count, self.rng = word, context, count.astype(np.int64), rng
        self.words, self.contexts = int(word.max()) + 1, int(context.max()) + 1
        self.customers = np.bincount(context, count, self.contexts)
        self.movable = np.flatnonzero(count >= 2)
        order = np.argsort(context[self.movable], kind="stable")
        block = np.empty(len(order), np.int64)
        block[order] = np.arange(len(order)) % BLOCKS
        self.blocks = [self.movable[block == b] for b in range(BLOCKS)]
        self.tables = (count > 0).astype(np.float64)
        self.base = 1.0 / ((np.bincount(word, count, self.words) > 0).sum() + 1)
        self.parent_tables = (np.bincount(word, self.tables, self.words) > 0).astype(np.float64)
        self.refresh()

    def refresh(self) -> None:
        """Totals and the parent's predictions from the tables as they are."""
        self.of_context = np.bincount(self.context, self.tables, self.contexts)
        c0 = np.bincount(self.word, self.tables, self.words)
        t0 = self.parent_tables
        self.parent = (c0 - PARENT_DISCOUNT * t0 + (PARENT_STRENGTH + PARENT_DISCOUNT * t0.sum()) * self.base) / (PARENT_STRENGTH + c0.sum())

    def predictions(self) -> np.ndarray:
        """p(word | context, class) of every pair under this seating."""
        back = (STRENGTH + DISCOUNT * self.of_context[self.context]) * self.parent[self.word]
        return (self.count - DISCOUNT * self.tables + back) / (STRENGTH + self.customers[self.context])

    def sweep(self) -> None:
        """One Gibbs sweep over the tables of all pairs and of all words in the parent."""
        for at in self.blocks:
            if len(at):
                others = self.of_context[self.context[at]] - self.tables[at]
                new = draw_tables(self.count[at], others, self.parent[self.word[at]], DISCOUNT, STRENGTH, self.rng)
                np.add.at(self.of_context, self.context[at], new - self.tables[at])
                self.tables[at] = new
        c0 = np.bincount(self.word, self.tables, self.words).astype(np.int64)
        seen = np.flatnonzero(c0 > 0)
        for b in range(BLOCKS):
            at = seen[b::BLOCKS]
            if len(at):
                others = self.parent_tables.sum() - self.parent_tables[at]
                self.parent_tables[at] = draw_tables(c0[at], others, np.full(len(at), self.base), PARENT_DISCOUNT, PARENT_STRENGTH, self.rng)
        self.refresh()


def sampled_predictions(word: np.ndarray, context: np.ndarray, count: np.ndarray, seed: int) -> np.ndarray:
    """Predictive probabilities of all pairs, averaged over the sampled seatings."""
    seating = Seating(word, context, count, np.random.default_rng([SEED, seed]))
    total, samples = np.zeros(len(word)), 0
    for sweep in range(SWEEPS):
        seating.sweep()
        if sweep >= BURN_IN and (sweep - BURN_IN) % EVERY == 0:
            total += seating.predictions()
            samples += 1
    return total / samples


def _scored(classes: int, learnt: np.ndarray):
    everything = float(learnt.sum())

    def run(table: pa.Table) -> pa.Table:
        p = table.column("p")[0].as_py()
        pairs, uses, docs = [], [], []
        for row in table.to_pylist():
            own, used = np.frombuffer(row["pairs"], U64), np.frombuffer(row["uses"], np.int32)
            width = len(row["docs"]) // max(int(used.sum()), 1)
            of = np.frombuffer(row["docs"], np.int32 if width == 4 else np.int64).astype(np.int64)
            pairs.append(np.repeat(own, used))
            uses.append(of & 1)
            docs.append((of >> 1) + row["base"])
        keys, held, docs = np.concatenate(pairs), np.concatenate(uses), np.concatenate(docs)
        distinct, at = np.unique(keys, return_inverse=True)
        count = np.bincount(at, 1 - held, len(distinct)).astype(np.int64)
        word = np.unique(distinct & ~_LOW, return_inverse=True)[1]
        contexts, context = np.unique((distinct & _LOW).astype(np.int64), return_inverse=True)
        in_class = np.bincount(context, count, len(contexts))
        share = (count.sum() + 1) / (everything + classes)
        chosen = (in_class + CLASS_STRENGTH * share) / (learnt[contexts] + CLASS_STRENGTH)
        logs = np.log10(chosen[context] * sampled_predictions(word, context, count, p))
        of_word = np.bincount(word, count)
        per_doc, doc = np.unique(docs, return_inverse=True)
        known = of_word[word][at]
        add = lambda x: np.bincount(doc, x, len(per_doc))
        ones = np.ones(len(at))
        columns = {
            "doc_id": np.r_[per_doc, 0],
            "real": np.r_[np.ones(len(per_doc), bool), False],
            "n_tokens": np.r_[add(ones), 0].astype(np.int64),
            "n_known": np.r_[add(known > 0), (of_word > 0).sum()].astype(np.int64),
            "base": np.r_[add(np.log10(known + 1.0)), 0.0],
            "score": np.r_[add(logs[at]), 0.0],
        }
        return pa.table(columns)

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per document.

    Scores are sums of log10 probabilities over the words (A-Z lower-cased) and one end token.
    Documents whose ``crc32(doc_id) % 7`` is 2 are held out, the rest is learnt from. The base score is
    add-one smoothing over single words. A word not seen in training has the parent's share for
    unseen words. Seeds are fixed by class, so equal input gives equal scores.

    Null and empty texts are just the end token. Rows that share a doc_id are one document with all their
    tokens; rows without one are left out, as nothing could be said about them. Empty input gives
    an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    counted = texts.mapInArrow(_context_counts, "context long, n long").groupBy("context").agg(F.sum("n").alias("n")).collect()  # one row per context
    learnt, tokens = np.zeros(CONTEXTS), 0
    for r in counted:
        if r["context"] < 0:
            tokens = r["n"]
        else:
            learnt[r["context"]] = r["n"]
    classes = max(64, -(-tokens // CLASS_TOKENS))
    parts = texts.mapInArrow(_packed(classes), _PACKED).groupBy("p").applyInArrow(
        _scored(classes, learnt), "doc_id long, real boolean, n_tokens long, n_known long, base double, score double"
    )
    sums = stored(parts.groupBy("real", "doc_id").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")]), "scores")
    vocabulary = sums.where(~F.col("real")).agg(F.sum("n_known")).first()[0] or 0
    train = int(learnt.sum())
    parts_, part = HELD_OUT
    return sums.where("real").select(
        "doc_id",
        (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts_)) == part).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(train).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.log10(F.lit(float(train + vocabulary + 1)))).alias("base_score"),
        "score",
    )
