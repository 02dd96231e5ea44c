"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from basketry.llm.hashing import U64
from basketry.materialize import stored

NEAREST = 20
#: Rows the rotations, the radius and the lower bounds of the queries are fitted on: about this many.
SAMPLE_ROWS = 8_192
#: A code is this many substrings of 64 bits; each substring has an index of its own.
TABLES = 4
WORD = 64
BITS = TABLES * WORD
ITERATIONS = 30
#: Share of the sample's near pairs whose codes lie within the radius.
WITHIN = 0.95
#: Rows and queries that meet in one task.
GROUP_ROWS = 16_384
#: Pairs of a query and a substring that a task looks at together.
PROBED_TOGETHER = 1 << 17
SEED = 12


def _augmented(m: np.ndarray, largest: float) -> np.ndarray:
    """Unit vectors with one more part, which makes up for what a vector lacks to the largest norm: for a unit
    query without that part, the order by cosine is the order by inner product."""
    scaled = m / largest
    rest = np.sqrt(np.maximum(1 - (scaled**2).sum(1), 0))
    return np.c_[scaled, rest]


def _unit_queries(m: np.ndarray) -> np.ndarray:
    scaled = m / np.abs(m).max(1, keepdims=True)
    return np.c_[scaled / np.linalg.norm(scaled, axis=1, keepdims=True), np.zeros(len(m))]


def learned_rotations(sample: np.ndarray) -> np.ndarray:
    """Columns whose signs are the bits of a code: principal directions of the sample turned by iterative
    quantisation (the rotation that brings the sample nearest to its own signs), from as many random
    starts as it takes to fill the code."""
    dim = sample.shape[1]
    values, directions = np.linalg.eigh(sample.T @ sample)
    main = directions[:, np.argsort(-values)[: min(dim, WORD)]]
    seen = sample @ main
    rng, out, width = np.random.default_rng([SEED, dim]), [], 0
    while width < BITS:
        turn = np.linalg.qr(rng.standard_normal((main.shape[1], main.shape[1])))[0]
        for _ in range(ITERATIONS):
            left, _, right = np.linalg.svd(np.where(seen @ turn >= 0, 1.0, -1.0).T @ seen)
            turn = (left @ right).T
        out.append(main @ turn)
        width += main.shape[1]
    return np.hstack(out)[:, :BITS]


def codes(points: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """``TABLES`` words of 64 bits per point."""
    packed = np.packbits(points @ rotations >= 0, axis=1)
    return np.ascontiguousarray(packed).view(">u8").astype(U64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1).astype(np.int64)


class Fitted:
    """Rotations, sample and the slack of the radius for vectors of one length."""

    def __init__(self, sample: np.ndarray, largest: float, nearest: int):
        self.largest, self.nearest = largest, nearest
        self.items = _augmented(sample, largest)
        self.rotations = learned_rotations(self.items)
        ask = _unit_queries(sample[:512])
        cosines = ask @ self.items.T
        apart = distances(codes(ask, self.rotations)[:, None], codes(self.items, self.rotations)[None])
        floor = self._floors(cosines)
        near = cosines >= floor[:, None]
        #: How much farther than the angle says the codes of near pairs lie.
        self.slack = float(np.quantile((apart - self.expected(cosines))[near], WITHIN)) if near.any() else 0.0

    def _floors(self, cosines: np.ndarray) -> np.ndarray:
        k = self.nearest + 1  # the query itself may be one of them
        if cosines.shape[1] < k:
            return np.full(len(cosines), -1.0)
        return -np.partition(-cosines, k - 1, axis=1)[:, k - 1]

    @staticmethod
    def expected(cosines: np.ndarray) -> np.ndarray:
        return BITS * np.arccos(np.clip(cosines, -1, 1)) / np.pi

    def radius(self, queries: np.ndarray) -> np.ndarray:
        """Radius that holds the nearest rows of each query: they lie no farther than its nearest sample rows."""
        floors = self._floors(queries @ self.items.T)
        reach = np.where(floors <= -1, BITS, np.ceil(self.expected(floors) + self.slack))
        return np.clip(reach, 0, BITS).astype(np.int32)


def fit(classes: DataFrame, nearest: int, sample_rows: int) -> dict[int, Fitted]:
    """A fit per length of vectors, on the rows whose hashes lie below a limit: about ``sample_rows`` in all, whatever the
    table's size. A length without sample rows gets the whole code as its radius, so nothing is missed."""
    sums = classes.groupBy("dim").agg(F.max("norm").alias("most"), F.count(F.lit(1)).alias("n")).collect()  # one row per length
    share = min(1.0, sample_rows / max(1, sum(r["n"] for r in sums)))
    hashed = F.pmod(F.xxhash64("rep"), F.lit(1_000_000_000))
    rows: dict[int, list] = {r["dim"]: [] for r in sums}
    for r in classes.where(hashed < int(share * 1_000_000_000)).select("dim", "vec").orderBy(hashed, "rep").collect():  # bounded by sample_rows
        rows[r["dim"]].append(r["vec"])
    return {r["dim"]: Fitted(np.array(rows[r["dim"]], float).reshape(-1, r["dim"]), r["most"], nearest) for r in sums}


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        part = batch.filter(pa.array(dims == dim))
        yield int(dim), part, part.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), -1)


def _binary(a: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in a], pa.binary())




def _prefixes(words: np.ndarray, bits: int) -> np.ndarray:
    return (words >> U64(WORD - bits)).astype(np.int64) if bits else np.zeros(len(words), np.int64)


def _indexed(fits: dict[int, Fitted], bits: int):
    """Every row once in the index of each substring, under the substring's first ``bits`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part, m in _rows_of(batch):
                own = codes(_augmented(m, fits[dim].largest), fits[dim].rotations)
                n, packed = len(part), _binary(own)
                for tab in range(TABLES):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim] * n, pa.int32()), pa.array([tab] * n, pa.int32()), pa.array(_prefixes(own[:, tab], bits)), part.column("rep"), packed, part.column("vec")],
                        ["dim", "tab", "prefix", "rep", "code", "vec"],
                    )

    return run


def _asked(fits: dict[int, Fitted], bits: int):
    """Every query under all prefixes that a substring within its share of the radius can have.

    The share of substring t is ``(radius - t) // TABLES``: were every substring of a code beyond its share, the
    code would be beyond the radius. A prefix lies no farther than its substring."""
    every = np.arange(1 << bits, dtype=np.int64)
    some = max(1, (1 << 22) >> bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, whole, points in _rows_of(batch):
                for lo in range(0, len(whole), some):
                    part, ask = whole.slice(lo, some), _unit_queries(points[lo : lo + some])
                    own, radius = codes(ask, fits[dim].rotations), fits[dim].radius(ask)
                    packed = _binary(own)
                    for tab in range(TABLES):
                        reach = np.bitwise_count(_prefixes(own[:, tab], bits)[:, None] ^ every) <= ((radius - tab) // TABLES)[:, None]
                        at, prefix = np.nonzero(reach)
                        pick, n = pa.array(at), len(at)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([dim] * n, pa.int32()), pa.array([tab] * n, pa.int32()), pa.array(prefix, pa.int64()), part.column("rep").take(pick),
                                pa.array(radius[at], pa.int32()), packed.take(pick), part.column("vec").take(pick),
                            ],
                            ["dim", "tab", "prefix", "rep", "radius", "code", "vec"],
                        )

    return run


def _counted(fits: dict[int, Fitted], bits: int):
    """How many rows stand under each prefix of each substring."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _indexed(fits, bits)(batches):
            prefix, n = np.unique(batch.column("prefix").to_numpy(), return_counts=True)
            same = [batch.column(c).take(pa.array([0] * len(n))) for c in ("dim", "tab")]
            yield pa.RecordBatch.from_arrays([*same, pa.array(prefix), pa.array(n, pa.int64())], ["dim", "tab", "prefix", "n"])

    return run


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _words(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), U64).reshape(-1, TABLES)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places from each start on, as many as each size says."""
    return np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())


def _answered(nearest: int):
    """Queries against the rows under one prefix: the index of the substring is probed with the share of the radius,
    whole codes are checked against the radius, and what is left is ranked by the vectors. A pair belongs to the
    first substring that finds it. Ties go to the smaller id."""

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if rows.num_rows and asked.num_rows:
            tab = rows.column("tab")[0].as_py()
            own = _words(rows.column("code"))
            order = np.argsort(own[:, tab], kind="stable")
            own, reps, vectors = own[order], rows.column("rep").to_numpy()[order], _matrix(rows.column("vec"))[order]
            directory, first = np.unique(own[:, tab], return_index=True)
            sizes = np.diff(np.r_[first, len(own)])
            asks, radius = asked.column("rep").to_numpy(), asked.column("radius").to_numpy().astype(np.int64)
            wanted, points = _words(asked.column("code")), _matrix(asked.column("vec"))
            shares = [((radius - t) // TABLES).astype(np.int16) for t in range(tab + 1)]
            share = shares[tab]
            own_words, wanted_words = [[np.ascontiguousarray(w) for w in a.T] for a in (own, wanted)]
            some = max(1, PROBED_TOGETHER // len(directory))
            for lo in range(0, len(asks), some):
                near_words = np.bitwise_count(directory ^ wanted[lo : lo + some, tab, None]) <= share[lo : lo + some, None]
                q, hit = np.divmod(np.flatnonzero(near_words).astype(np.int32), np.int32(len(directory)))
                if len(directory) < len(own):
                    q, hit = np.repeat(q, sizes[hit]), _ranges(first[hit], sizes[hit])
                for cut in range(0, len(q), PROBED_TOGETHER):
                    i, j = q[cut : cut + PROBED_TOGETHER] + lo, hit[cut : cut + PROBED_TOGETHER]
                    # Word by word: takes along one array are much quicker than takes of rows.
                    apart = [np.bitwise_count(words[j] ^ asked_words[i]) for words, asked_words in zip(own_words, wanted_words, strict=True)]
                    good = sum(a.astype(np.int16) for a in apart) <= radius[i]
                    for before, a in zip(shares, apart[:tab]):
                        good &= a > before[i]
                    i, j = i[good], j[good]
                    near = np.einsum("ij,ij->i", vectors[j], points[i])
                    best = np.lexsort((reps[j], -near, i))
                    i, j, near = i[best], j[best], near[best]
                    starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
                    kept = np.arange(len(i)) - np.repeat(starts, np.diff(np.r_[starts, len(i)])) <= nearest if len(i) else slice(0)
                    out.append((asks[i[kept]], reps[j[kept]], near[kept]))
        ask, rep, score = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"ask": ask, "rep": rep, "score": score})

    return run


def _blocks(rows: DataFrame, sizes: DataFrame, own: str, others: str, block: int) -> DataFrame:
    """``rows`` with their own block (by hash) and a copy for each block of the other side; both counts come from ``sizes``."""
    count = lambda n: F.ceil(F.col(n) / block).cast("int")
    spread = F.sequence(F.lit(0), count(others) - 1)
    return (
        rows.join(sizes, ["dim", "tab", "prefix"])
        .withColumn(f"{own}_block", F.pmod(F.xxhash64("rep"), count(own)).cast("int"))
        .withColumn(f"{others}_block", F.explode(spread)).drop(own, others)
    )


def nearest_vectors(
    vectors: DataFrame, is_query, nearest: int = NEAREST, sample_rows: int = SAMPLE_ROWS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vec_id, embedding`` that meets ``is_query`` the ``nearest`` other rows by
    inner product, nearest first, ties to the smaller vec_id.

    Equal vectors are one class: it stands in the index once and carries its ``nearest + 1`` smallest ids, more of which no answer can
    hold. Classes get ``TABLES`` substrings of 64 bits and stand in the index of each. A query's radius comes from
    its own nearest sample rows, which bound the score of its nearest rows from below, and from how far codes
    of near pairs lie apart in the sample. All codes within the radius are found; whether a true neighbour's code lies
    within it is what makes the answer approximate. Prefixes with many rows or queries are cut into blocks of
    ``group_rows``; nothing is left out.

    Null or zero vectors, those with null or non-finite parts and rows without vec_id take no part; vectors of different
    length are not compared. Rows that repeat a vec_id are rows of their own but answers hold an id once, and not the query's. Empty input gives an empty result.
    """
    part = vectors.schema["embedding"].dataType
    kind = "array<float>" if isinstance(part, ArrayType) and isinstance(part.elementType, FloatType) else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("vec"), is_query.alias("asks"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.col("vec").isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    rows = rows.where(F.coalesce(good, F.lit(False))).withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)).cast(kind))
    rows = rows.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(7), "vec")})
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    classes = stored(
        rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.first("vec").alias("vec"), F.max(F.coalesce("asks", F.lit(False))).alias("asks"))
        .withColumns({"dim": F.size("vec"), "norm": length}),
        "classes",
    )
    fits = fit(classes, nearest, sample_rows)
    bits = max(0, ceil(log2(max(classes.count(), 1) / group_rows)))
    slim = classes.select("dim", "rep", "vec")
    index = slim.mapInArrow(_indexed(fits, bits), f"dim int, tab int, prefix long, rep long, code binary, vec {kind}")
    asked = stored(
        classes.where("asks").select("dim", "rep", "vec").mapInArrow(_asked(fits, bits), f"dim int, tab int, prefix long, rep long, radius int, code binary, vec {kind}"),
        "asked",
    )
    keys = ["dim", "tab", "prefix"]
    n_rows = slim.mapInArrow(_counted(fits, bits), "dim int, tab int, prefix long, n long").groupBy(*keys).agg(F.sum("n").alias("n_rows"))
    sizes = stored(n_rows.join(asked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_asked")), keys), "sizes")
    left = _blocks(index, sizes, "n_rows", "n_asked", group_rows)
    right = _blocks(asked, sizes, "n_asked", "n_rows", group_rows)
    meet = [*keys, "n_rows_block", "n_asked_block"]
    found = left.groupBy(*meet).cogroup(right.groupBy(*meet)).applyInArrow(_answered(nearest), "ask long, rep long, score double")
    first = Window.partitionBy("ask").orderBy(F.desc("score"), "rep")
    best = stored(found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= nearest + 1).drop("place"), "best")
    return _answers(rows.select("h1", "h2", "vec_id", "asks"), classes, best, nearest)


def _answers(rows: DataFrame, classes: DataFrame, best: DataFrame, nearest: int) -> DataFrame:
    """The classes found, as rows: members of each class by id, the query itself left out."""
    named = rows.join(classes.select("h1", "h2", "rep"), ["h1", "h2"]).select("rep", "vec_id", "asks")
    wanted = best.select("rep").distinct()
    place = F.row_number().over(Window.partitionBy("rep").orderBy("vec_id"))
    members = (
        named.join(wanted, "rep", "left_semi").select("rep", "vec_id").distinct()
        .withColumn("place", place).where(F.col("place") <= nearest + 1)
        .groupBy("rep").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    )
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    items = (
        best.join(members, "rep").select("ask", "score", F.explode("members").alias("vec_id"))
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= nearest + 1)
        .groupBy("ask").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("items"))
    )
    own = named.where("asks").select(F.col("rep").alias("ask"), F.col("vec_id").alias("query_id")).distinct()
    others = F.slice(F.filter("items", lambda x: x["vec_id"] != F.col("query_id")), 1, nearest)
    return (
        own.join(items, "ask").select("query_id", F.posexplode(others).alias("rank", "item"))
        .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("item.vec_id").alias("vec_id"), F.col("item.score").alias("score"))
    )
