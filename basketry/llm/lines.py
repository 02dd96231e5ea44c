"""Line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import SPACES, fresh, hash_pair, lower_ascii, whole_text
from basketry.materialize import scratch_path, stored

MIN_CHARS = 1
MIN_DOCS = 10
BATCHES = 4
FANOUT = 4
SALTS = 16


def line_key(line: Column) -> Column:
    """A line's key: ASCII white space stripped at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(text: Column, min_chars: int) -> Column:
    """One 128-bit hash per line, null where the key is shorter than ``min_chars``."""
    keys = F.transform(split_lines(text), line_key)
    return F.transform(keys, lambda k: F.when(F.length(k) >= min_chars, hash_pair(k)))


class LineRuns:
    """How many documents hold each line, kept as sorted runs in levels, and the lines that have become common.

    A run is a table of ``h1, h2, docs``, cut into buckets by hash and sorted inside them. A new batch is shuffled to the
    same buckets once and merge-joined with every run where it lies: lines known to be common leave by an anti-join, the
    others add up their earlier counts. Those that reach ``min_docs`` go to a small run of common lines, the rest become a run
    of level 0. When a level holds ``fanout`` runs they are merged into one run of the next level, so n batches
    leave about ``fanout * log(n)`` runs and every count is rewritten once per level. Stored runs are never shuffled.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.crossed: list[DataFrame] = []

    def _run(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid4().hex}"
        rows.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", scratch_path(self.spark, "run")).saveAsTable(name)
        return self.spark.table(name)

    def _uncommon(self, rows: DataFrame) -> DataFrame:
        for run in self.crossed:
            rows = rows.join(run, ["h1", "h2"], "left_anti")
        return rows

    def with_earlier(self, counts: DataFrame) -> DataFrame:
        """A batch's ``h1, h2, docs`` that are not common yet, with ``total``: their documents in the runs and the batch."""
        rows, total = self._uncommon(counts), F.col("docs")
        for i, run in enumerate(r for level in self.levels for r in level):
            rows = rows.join(run.withColumnRenamed("docs", f"docs_{i}"), ["h1", "h2"], "left")
            total = total + F.coalesce(f"docs_{i}", F.lit(0))
        return rows.select("h1", "h2", "docs", total.alias("total"))

    def add(self, counts: DataFrame) -> None:
        """Take in ``h1, h2, docs`` of one batch (a row per line) and compact the levels that are full."""
        met = self._run(self.with_earlier(counts))
        common = met.where(F.col("total") >= self.min_docs).select("h1", "h2")
        self._push(0, met.where(F.col("total") < self.min_docs).select("h1", "h2", "docs"))
        self.crossed.append(self._run(common))
        if len(self.crossed) >= self.fanout:
            self.crossed = [self._run(_united(self.crossed))]

    def _push(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = _united(self.levels[level]).groupBy("h1", "h2").agg(F.sum("docs").alias("docs"))
            self.levels[level] = []
            self._push(level + 1, self._run(self._uncommon(merged)))

    def common(self) -> DataFrame | None:
        """``h1, h2`` of the lines found in at least ``min_docs`` documents so far; None before the first batch."""
        return _united(self.crossed) if self.crossed else None

    def counts(self) -> DataFrame | None:
        """``h1, h2, docs`` of the other lines."""
        runs = [r for level in self.levels for r in level]
        return self._uncommon(_united(runs).groupBy("h1", "h2").agg(F.sum("docs").alias("docs"))) if runs else None


def _united(runs: list[DataFrame]) -> DataFrame:
    united = runs[0]
    for r in runs[1:]:
        united = united.unionByName(r)
    return united


def batch_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """``batch, doc_id, h1, h2``: the distinct lines of every row, stored by batch."""
    hashes = F.array_compact(F.array_distinct(line_hashes(whole_text(), min_chars)))
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    return stored(
        docs.select(batch.alias("batch"), "doc_id", F.explode(hashes).alias("h")).select("batch", "doc_id", "h.h1", "h.h2"),
        "lines",
        "batch",
    )


def drop_common_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    salts: int = SALTS,
    runs: LineRuns | None = None,
) -> DataFrame:
    """``docs`` with ``text`` less the lines found in at least ``min_docs`` documents, ``n_lines`` and ``n_dropped``.

    The rows come in ``batches``. Each meets the runs of the batches before it and adds its own; the lines that became
    common on the way are lost by every row. ``runs`` may hold earlier batches, which then count as
    well (its ``min_docs`` applies). Rows with common lines are joined with just the hashes of these; a very common line is
    spread over ``salts`` keys, and counts are added up before they are shuffled.

    Null or empty text is one empty line, whose key is too short to be dropped, and comes back
    as empty text. Every row counts as a document, repeated rows too; a row with a line many times
    counts once for it. A document whose lines all go keeps an empty text. Rows with a null doc_id
    are handled like any other. Empty input gives an empty result.
    """
    runs = LineRuns(docs.sparkSession, min_docs, fanout) if runs is None else runs
    lines = batch_lines(docs, min_chars, batches)
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs")))
    salt = F.pmod(F.xxhash64("doc_id", "h1"), F.lit(salts))
    common = runs.common().select(
        "h1", "h2", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("salt")
    )
    gone_id, gone_hashes, all_parts, kept_parts = fresh(docs, "gone_id", "gone", "parts", "kept_parts")
    gone = (
        lines.withColumn("salt", salt)
        .join(common, ["h1", "h2", "salt"], "left_semi")
        .groupBy(F.col("doc_id").alias(gone_id))
        .agg(F.collect_set(F.struct("h1", "h2")).alias(gone_hashes))
    )
    columns = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    text = whole_text()
    parts = split_lines(text)
    staying = F.filter(
        parts,
        lambda line: (F.length(line_key(line)) < min_chars) | ~F.array_contains(F.col(gone_hashes), hash_pair(line_key(line))),
    )
    kept = F.when(F.col(gone_hashes).isNull(), parts).otherwise(staying)
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(gone_id)), "left").select(*columns, parts.alias(all_parts), kept.alias(kept_parts))
    return joined.select(
        *columns,
        F.array_join(kept_parts, "\n").alias("text"),
        F.size(all_parts).cast("long").alias("n_lines"),
        (F.size(all_parts) - F.size(kept_parts)).cast("long").alias("n_dropped"),
    )
