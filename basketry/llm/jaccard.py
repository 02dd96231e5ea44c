"""N-gram Jaccard join by universe partition: exact pairs of similar shingle sets.

Two sets of sizes a and b with Jaccard similarity of at least 0.8 differ in at most (a + b) / 9
elements. Sizes are cut into bands; pairs within a band and pairs across a border each get a partition
of the hash universe into segments, more of them than elements can differ. By the pigeonhole
principle two similar sets then have an equal segment, so equal segment hashes are the candidates.

Cost-based allocation: a set needs one more filled segment than it can differ in, so it emits
only the first so many (allocation 1) and no empty one (allocation 0). The number of segments is the
smallest that leaves few sets short of filled segments. Those emit one-deletion neighbourhoods of
all their segments besides (allocation 2: a segment may then differ in one element); a set still
short emits single elements, the prefix that any similar set must share. Each level is complete for
pairs of which both sets are short at the level before, so no pair is lost.

Words on the executors are hashed to 64 bits; sets are compared by these hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import fresh
from basketry.llm.components import connected_components
from basketry.llm.hashing import U64, mix, shingle_set, slot
from basketry.materialize import stored

WIDTH = 5
#: Shingles per group of keys in one task's hands.
GROUP_SHINGLES = 250_000
FLUSH_KEYS = 2_000_000
#: Sets and shingles in one block of pairwise work.
CHUNK = 2_048
BLOCK_SHINGLES = 2_000_000
#: Bits of the filter of wanted documents: 8 MB, whatever the number of documents.
FILTER_BITS = 1 << 26

_EDGES = [4]
while _EDGES[-1] < 2**40:
    _EDGES.append(int(_EDGES[-1] * 2.25) + 1)


def most_different(a: int, b: int) -> int:
    return (a + b) // 9


def tags(size: int) -> list[tuple[int, int, int]]:
    """``tag, largest partner, differences the tag allows for`` of the partitions a set takes part in."""
    band = int(np.searchsorted(_EDGES, size))
    upper = _EDGES[band]
    out = [(2 * band, min(upper, size * 5 // 4), most_different(upper, upper))]
    if 10 * size >= 8 * (upper + 1):
        out.append((2 * band + 1, size * 5 // 4, most_different(upper, upper * 5 // 4)))
    if band and 4 * size <= 5 * _EDGES[band - 1]:
        below = _EDGES[band - 1]
        out.append((2 * band - 1, min(below * 5 // 4, size * 5 // 4), most_different(below, below * 5 // 4)))
    return out


@lru_cache(maxsize=None)
def segments(allowed: int, size: int) -> int:
    """The number of segments: at least ``allowed + 1`` of them are filled in nearly all sets of ``size``."""
    m = allowed + 1
    while m > 1 and m < 2 * (allowed + 1) + 4:
        load = size / m
        empty = exp(-load)
        filled = m * (1 - empty)
        spread = sqrt(max(m * empty * (1 - (1 + load) * empty), 0.0))
        if filled - 2.5 * spread >= allowed + 1:
            break
        m += max(1, m // 64)
    return m


def set_keys(s: np.ndarray) -> np.ndarray:
    """The candidate keys of one sorted shingle set."""
    size = len(s)
    if size == 0:
        return s
    elements = mix(s)
    out = []
    short_of_all = False
    for tag, partner, allowed in tags(size):
        need = most_different(size, partner) + 1
        m = segments(allowed, _EDGES[tag // 2])
        where = slot(s, m)
        starts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        sums = np.add.reduceat(elements, starts)
        salt = mix(where[starts] * U64(2) + U64((tag + 1) << 40))
        keys = mix(sums ^ salt)
        out.append(keys[:need])
        if len(keys) >= need:
            continue
        lengths = np.diff(np.r_[starts, size])
        own = np.repeat(np.arange(len(starts)), lengths)
        again = salt ^ U64(0x5DEECE66D)
        out.append(mix(sums ^ again))
        longer = lengths[own] > 1
        out.append(mix((sums[own] - elements)[longer] ^ again[own][longer]))
        short_of_all = short_of_all or int(np.minimum(lengths, 2).sum()) < need
    if short_of_all:
        prefix = size - -(-4 * size // 5) + 1
        out.append(mix(elements[:prefix] ^ U64(0xB5026F5AA96619E9)))
    return np.concatenate(out)


def sketch(s: np.ndarray) -> bytes:
    """The parity of the set in a power-of-two number of bits: two sketches differ in no more bits than
    their sets differ in elements."""
    bits = 64
    while bits < 1.5 * _EDGES[int(np.searchsorted(_EDGES, len(s)))] and bits < 1 << 20:
        bits *= 2
    return np.packbits(np.bincount((mix(s) & U64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def _folded(bits: np.ndarray, length: int) -> np.ndarray:
    while len(bits) > length:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def similar_sketches(na: int, a: bytes, nb: int, b: bytes) -> bool:
    """Whether two sets may be similar, by their sizes and sketches; never false for similar ones."""
    if 4 * max(na, nb) > 5 * min(na, nb):
        return False
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    length = min(len(x), len(y))
    return int(np.bitwise_count(_folded(x, length) ^ _folded(y, length)).sum()) <= most_different(na, nb)


def similar_sets(a: np.ndarray, b: np.ndarray) -> bool:
    if 4 * max(len(a), len(b)) > 5 * min(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= 80 * (len(a) + len(b) - both)


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _sizes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())],
                ["doc_id", "n_shingles", "sketch"],
            )

    return run


_KEY_ROWS = "p long, keys binary, docs binary, several binary, members binary"


def _keyed(width: int, groups: int):
    """Keys by group of the hash range, as packed arrays. Sets of one batch with one key are combined
    here: only the first goes with the key, the others go on as its members, spread by their own ids."""

    def packed(ids: list[np.ndarray], keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        k, d = np.concatenate(keys), np.concatenate(ids)
        order = np.lexsort((d, k))
        k, d = k[order], d[order]
        first = np.r_[True, k[1:] != k[:-1]]
        starts = np.flatnonzero(first)
        leader = d[starts][np.cumsum(first) - 1]
        other = d != leader
        several = np.add.reduceat(other.astype(np.int64), starts) > 0
        rows: dict[str, list] = {"p": [], "keys": [], "docs": [], "several": [], "members": []}

        def add(p, keys_, docs_, several_, members_):
            cuts = np.flatnonzero(np.r_[True, p[1:] != p[:-1], True])
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                rows["p"].append(int(p[lo]))
                rows["keys"].append(keys_[lo:hi].tobytes())
                rows["docs"].append(docs_[lo:hi].tobytes())
                rows["several"].append(None if several_ is None else several_[lo:hi].tobytes())
                rows["members"].append(None if members_ is None else members_[lo:hi].tobytes())

        add(slot(k[starts], groups), k[starts], d[starts], several, None)
        if other.any():
            p = slot(mix(d[other].astype(U64)), groups)
            by = np.argsort(p, kind="stable")
            add(p[by], k[other][by], leader[other][by], None, d[other][by])
        types = [pa.int64(), *[pa.binary()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], list(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, held = [], [], 0
            for doc, text in zip(batch.column("doc_id").to_pylist(), _texts(batch), strict=True):
                own = set_keys(shingle_set(text, width))
                if len(own):
                    ids.append(np.full(len(own), doc, np.int64))
                    keys.append(own)
                    held += len(own)
                if held >= FLUSH_KEYS:
                    yield from packed(ids, keys)
                    ids, keys, held = [], [], 0
            if held:
                yield from packed(ids, keys)

    return run


def _grouped(table: pa.Table) -> pa.Table:
    """Sets with equal keys in one hash range, as ``key, a, b``: the first set and each other. A key of
    two sets is a pair and needs no name (0); of several keys with the same sets one is named."""

    def joined(rows: pa.Table, column: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(rows.column(column).to_pylist()), kind)

    whole = table.filter(pa.compute.is_null(table.column("members")))
    out = [[], [], []]
    if whole.num_rows:
        k, d, several = joined(whole, "keys", U64), joined(whole, "docs", np.int64), joined(whole, "several", np.bool_)
        order = np.lexsort((d, k))
        k, d, several = k[order], d[order], several[order]
        once = np.r_[True, (k[1:] != k[:-1]) | (d[1:] != d[:-1])]
        k, d = k[once], d[once]
        several = np.logical_or.reduceat(several, np.flatnonzero(once))
        first = np.r_[True, k[1:] != k[:-1]]
        starts = np.flatnonzero(first)
        at = np.cumsum(first) - 1
        size = np.diff(np.r_[starts, len(k)])
        more = np.logical_or.reduceat(several, starts)
        leader = d[starts][at]
        pair = ((size == 2) & ~more)[at] & ~first
        a, b = np.unique(np.stack([leader[pair], d[pair]]), axis=1)
        out[0].append(np.zeros(len(a), np.int64)), out[1].append(a), out[2].append(b)
        sets = np.add.reduceat(mix(d.astype(U64)), starts)
        named = (size > 2) | ((size == 2) & more)
        kept = np.zeros(len(starts), bool)
        plain = np.flatnonzero(named & ~more)
        kept[plain[np.unique(sets[plain], return_index=True)[1]]] = True
        kept |= named & more
        rows = kept[at] & ~first
        out[0].append(k[rows].astype(np.int64)), out[1].append(leader[rows]), out[2].append(d[rows])
    local = table.filter(pa.compute.is_valid(table.column("members")))
    if local.num_rows:
        out[0].append(joined(local, "keys", U64).astype(np.int64))
        out[1].append(joined(local, "docs", np.int64)), out[2].append(joined(local, "members", np.int64))
    return pa.table({n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in zip(("key", "a", "b"), out, strict=True)})


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*[batch.column(c).to_pylist() for c in ("na", "sa", "nb", "sb")], strict=True)
        keep = pa.array([similar_sketches(*r) for r in rows], pa.bool_())
        yield batch.select(["a", "b"]).filter(keep)


class Classes:
    """Union-find over labels that appear as they come."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (up := self.parent.get(x, x)) != x:
            path.append(x)
            x = up
        for p in path:
            self.parent[p] = x
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


def _blocks(batches: Iterator[pa.RecordBatch], key: tuple[str, ...], columns: tuple[str, ...]) -> Iterator[list[tuple]]:
    """Runs of rows with equal ``key`` from sorted batches, each row as its ``columns``."""
    held: list[tuple] = []
    of = None
    for batch in batches:
        names = [batch.column(c).to_pylist() for c in key]
        values = [batch.column(c).cast(pa.binary()).to_pylist() if c == "text" else batch.column(c).to_pylist() for c in columns]
        for k, row in zip(zip(*names, strict=True), zip(*values, strict=True), strict=True):
            if held and k != of:
                yield held
                held = []
            of = k
            held.append(row)
    if held:
        yield held


def _close(labels: list[int], chunks: list[int], n: np.ndarray, bits: np.ndarray, classes: Classes, similar) -> Iterator[tuple[int, int]]:
    """Pairs of rows that join classes: similar by size, sketch and ``similar``. Rows with most
    neighbours come first, so that few rows settle a group of copies. In a block of two chunks only
    pairs between these count."""
    cross = len(set(chunks)) > 1
    chunk = np.array(chunks)
    label = np.array([classes.root(x) for x in labels])

    def neighbours(i: int) -> np.ndarray:
        open_ = (label != label[i]) & (4 * np.maximum(n, n[i]) <= 5 * np.minimum(n, n[i]))
        if cross:
            open_ &= chunk != chunk[i]
        others = np.flatnonzero(open_)
        far = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1, dtype=np.int64)
        return others[far <= (n[others] + n[i]) // 9]

    for i in range(len(labels)):
        if (label == label[0]).all():
            return
        for j in neighbours(i):
            if label[j] != label[i] and similar(i, j) and classes.join(int(label[i]), int(label[j])):
                new = classes.root(int(label[i]))
                label[(label == label[i]) | (label == label[j])] = new
                yield i, j


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = ([x[k] for x in found] for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _bits(sketches: list[bytes]) -> np.ndarray:
    length = min(map(len, sketches))
    return np.stack([_folded(np.frombuffer(x, np.uint8), length) for x in sketches])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``key, lo, hi``: pairs that join labels which the sketches cannot tell apart. Joins
    hold for the whole task, so a later key repeats none of them."""
    classes = Classes()
    for rows in _blocks(batches, ("key", "lo", "hi"), ("doc", "chunk", "label", "n_shingles", "sketch")):
        docs, chunks, labels, n, sketches = map(list, zip(*rows, strict=True))
        if len({classes.root(x) for x in labels}) > 1:
            pairs = _close(labels, chunks, np.array(n), _bits(sketches), classes, lambda i, j: True)
            if found := [(docs[i], docs[j]) for i, j in pairs]:
                yield _pairs(found)


def _verified(width: int):
    """Rows sorted by ``component, lo, hi``: links that join the documents of a block as all its links would."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches, ("component", "lo", "hi"), ("doc", "chunk", "text")):
            classes = Classes()
            first: dict[bytes, int] = {}
            found, kept = [], []
            for doc, chunk, text in rows:
                s = shingle_set(text, width)
                same = first.setdefault(s.tobytes(), doc)
                if same == doc:
                    kept.append((doc, chunk, s))
                else:
                    found.append((same, doc))
            docs, chunks, sets = map(list, zip(*kept, strict=True))
            n = np.array([len(s) for s in sets])
            bits = _bits([sketch(s) for s in sets])
            near = _close(docs, chunks, n, bits, classes, lambda i, j: similar_sets(sets[i], sets[j]))
            found += [(docs[i], docs[j]) for i, j in near]
            if found:
                yield _pairs(found)

    return run


def _in_chunks(rows: DataFrame) -> DataFrame:
    """``rows`` with the number of ``chunks`` of their group, dealt to blocks ``lo, hi``: every chunk and every two chunks meet in one."""
    chunk = F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int")
    return (
        rows.withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumns({"lo": F.least("chunk", "other"), "hi": F.greatest("chunk", "other")})
        .drop("other", "chunks")
    )


def _wanted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without most rows whose ``doc_id`` is not a ``node`` of ``ids``, so that their texts need no
    shuffle. The filter of hashed ids may let a row through, but never holds one of ``ids`` back; the join after it is exact."""

    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)) + 1

    filters = ids.groupBy(F.bitmap_bucket_number(place("node")).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place("node"))).alias("bits")
    )
    bit = F.bitmap_bit_position(place("doc_id"))
    byte = F.conv(F.hex(F.col("bits").substr((F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return (
        docs.join(F.broadcast(filters), F.bitmap_bucket_number(place("doc_id")) == F.col("bucket"))
        .where(F.getbit(byte, (bit % 8).cast("int")) == 1)
        .select(*docs.columns)
    )


def jaccard_components(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row: the size of its shingle set and the smallest
    doc_id reachable over links, itself included. Two documents link when the similarity of their sets is at least 0.8.

    Candidates are narrowed by parity sketches, which can prove that two sets differ too much. Every
    set with a key is compared with the first one of that key; where a key then still holds several
    components, its other pairs across these are compared too, but only pairs that join
    components are handed on, so a group of n copies costs about n rows and not n squared. What hangs
    together by sketches is then read once, in blocks of bounded size, and joined by exact
    similarity: each pair in it that could still join two components is verified.

    A null or empty text, or one without words, has an empty set, links with nothing and is its own
    component. A null doc_id cannot be named: its row has a null component and links with nothing.
    Rows with one doc_id are one node; each row keeps its own size. Empty input gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sizes = stored(docs.mapInArrow(_sizes(width), "doc_id long, n_shingles long, sketch binary"), "sizes")
    named = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    total = sizes.agg(F.sum("n_shingles")).first()[0] or 0
    groups = max(16, -(-total // GROUP_SHINGLES))
    same_key = stored(
        named.mapInArrow(_keyed(width, groups), _KEY_ROWS).groupBy("p").applyInArrow(_grouped, "key long, a long, b long"), "same-key"
    )
    sketches = sizes.where("n_shingles > 0 AND doc_id IS NOT NULL").dropDuplicates(["doc_id", "sketch"])

    def side(x: str) -> DataFrame:
        return sketches.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))

    stars = same_key.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b").mapInArrow(_pruned, "a long, b long")
    near = stored(stars.distinct(), "stars")
    labels = stored(connected_components(near), "labels")

    members = same_key.where("key != 0").select("key", F.explode(F.array("a", "b")).alias("doc")).distinct()
    labelled = stored(
        members.join(labels, F.col("doc") == F.col("node"), "left").select("key", "doc", F.coalesce("component", "doc").alias("label")), "members"
    )
    # Keys with the same sets lead to the same comparisons: one of them is enough.
    mixed = (
        labelled.groupBy("key")
        .agg(
            F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("doc")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(7), "doc")).alias("h2"),
        )
        .where("x != y").groupBy("n", "h1", "h2").agg(F.min("key").alias("key"))
        .select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    )
    across = (
        _in_chunks(labelled.join(mixed, "key"))
        .join(sketches.withColumnRenamed("doc_id", "doc"), "doc")
        .repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
        .mapInArrow(_across, "a long, b long").distinct()
    )
    more = stored(across, "across")
    if not more.isEmpty():
        labels = stored(connected_components(near.union(more)), "labels")

    sized = labels.join(sketches, F.col("node") == F.col("doc_id")).select("component", F.col("node").alias("doc"), "n_shingles")
    blocks = sized.groupBy("component").agg(
        F.ceil(F.greatest(F.sum("n_shingles") / BLOCK_SHINGLES, F.count(F.lit(1)) / CHUNK)).cast("int").alias("chunks")
    )
    placed = stored(_in_chunks(labels.select("component", F.col("node").alias("doc")).join(blocks, "component")), "blocks")
    links = (
        placed.join(_wanted(named, labels).withColumnRenamed("doc_id", "doc"), "doc")
        .repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi", "doc")
        .mapInArrow(_verified(width), "a long, b long").distinct()
    )
    final = connected_components(stored(links, "links"))
    return sizes.join(final, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def drop_near_copies(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with one document of every component: the one with the smallest doc_id. Rows without
    an id stay."""
    (gone_id,) = fresh(docs, "gone_id")
    gone = jaccard_components(docs, width).where("component_id != doc_id").select(F.col("doc_id").alias(gone_id)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(gone_id), "left_anti")
