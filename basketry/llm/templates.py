"""Benchmark decontamination by template canonicalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import fresh, let, whole_text
from basketry.materialize import stored

WINDOW = 8
MIN_LITERALS = 3
MIN_COVERAGE = 0.4
#: More windows than this are joined by a shuffle instead of a broadcast.
BROADCAST_WINDOWS = 500_000

#: Fixed list of measuring units.
UNITS = (
    "km|cm|mm|m|mi|ft|kg|mg|g|lbs?|oz|ml|l|hours?|h|minutes?|min|seconds?|sec|s|days?|weeks?|months?|years?|"
    "percent|dollars?|euros?|usd|eur|mph|gb|mb|kb|kw|w|v"
)
NUM, NAME, UNIT, END = "\u0001", "\u0002", "\u0003", "\u0004"
_NUMBER = r"\p{Sc}?\d+(?:[.,:/]\d+)*"
_UNIT = rf"(?<=\d) ?(?i:{UNITS})(?![\p{{L}}\p{{M}}])|(?<=\d) ?[%°\p{{Sc}}][CF]?"
#: A capitalised word that does not open a sentence or a line.
_NAME = r"(?<=[^.!?:;\s][ \t])\p{Lu}[\p{L}\p{M}]*(?:['’-][\p{L}\p{M}]+)*"
_TOKEN = r"[\u0001-\u0003]|[\p{L}\p{M}]+"
_VALUED = r"[\u0001-\u0003][^\u0004]*\u0004|[\p{L}\p{M}]+"


def template_tokens(text: Column, values: bool = False) -> Column:
    """The words of a text in lower case, with a typed placeholder for every name, unit and number;
    with ``values`` a placeholder is followed by what it stands for. Both forms have the same length."""
    # A unit follows the digits of its number, so it is marked before them; values never nest.
    marked = F.regexp_replace(text, "[\u0001-\u0004]", " ")
    for pattern, mark in ((_NAME, NAME), (_UNIT, UNIT), (_NUMBER, NUM)):
        marked = F.regexp_replace(marked, pattern, f" {mark}$0{END} " if values else f" {mark} ")
    return F.regexp_extract_all(F.lower(marked), F.lit(_VALUED if values else _TOKEN), F.lit(0))


def window_hashes(tokens: Column, length: int) -> Column:
    """A hash per run of ``length`` tokens, in order."""
    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    return let(
        hashes,
        lambda h: F.when(
            F.size(h) >= length,
            F.transform(F.sequence(F.lit(1), F.size(h) - length + 1), lambda i: F.xxhash64(F.slice(h, i, length))),
        ).otherwise(F.array().cast("array<bigint>")),
    )


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, min_literals: int = MIN_LITERALS) -> DataFrame:
    """``item_id, length, hash, offset, windows``: the windows of every item that can tell it from other
    text. An item shorter than ``window`` is one window of its own length. Windows of fewer than
    ``min_literals`` words besides placeholders say too little and are left out."""
    def windows(words: Column) -> Column:
        length = F.least(F.lit(window), F.size(words))
        return F.when(
            F.size(words) > 0, F.transform(F.sequence(F.lit(1), F.size(words) - length + 1), lambda i: F.slice(words, i, length))
        )

    cut = benchmark.select(
        "item_id", F.posexplode(let(template_tokens(whole_text()), windows)).alias("offset", "words")
    ).withColumn("length", F.size("words"))
    literal = F.size(F.filter("words", lambda w: ~w.isin(NUM, NAME, UNIT)))
    told = cut.where(literal >= F.least(F.lit(min_literals), F.col("length")))
    hashed = told.select("item_id", "length", "offset", F.xxhash64(F.transform("words", lambda w: F.xxhash64(w))).alias("hash"))
    counts = hashed.groupBy("item_id").agg(F.count(F.lit(1)).alias("windows"))
    return hashed.join(counts, "item_id")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    min_literals: int = MIN_LITERALS,
    min_coverage: float = MIN_COVERAGE,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """``doc_id, item_id, matched, coverage, slots``: the documents that hold a benchmark item or a
    re-parameterised form of it.

    Names, units and numbers become typed placeholders on both sides and all windows of
    ``window`` template words are hash-joined. Matches of one item at one place in a document (equal
    shift between both) are counted; where at least ``min_coverage`` of the item's windows match,
    the slots are read: every value of the item must stand for one value of the document
    throughout (``slots`` is the number of different values). A copy fits as well, with every value
    standing for itself. The best place is reported per document and item.

    The windows of the benchmark are broadcast only up to ``broadcast_windows`` of them and joined by a shuffle beyond.
    Null and empty texts hold nothing and match nothing; items without a telling window match
    nothing. Repeated rows of a document count once. Null ids are kept as ids. Empty tables give
    an empty result.
    """
    bench = stored(benchmark_windows(benchmark, window, min_literals), "windows")
    size = bench.count()
    lengths = [r["length"] for r in bench.select("length").distinct().collect()]  # at most ``window`` values
    tokens = docs.select("doc_id", template_tokens(whole_text()).alias("tokens"))
    by_hash = bench.select("hash", "item_id", "offset", "windows", "length")
    if size <= broadcast_windows:
        by_hash = F.broadcast(by_hash)
    hits = None
    for length in lengths:
        cut = tokens.select("doc_id", F.posexplode(window_hashes(F.col("tokens"), length)).alias("pos", "hash"))
        found = cut.join(by_hash.where(F.col("length") == length), "hash").select(
            "doc_id", "item_id", "windows", "offset", (F.col("pos") - F.col("offset")).alias("shift")
        )
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        none = {"item_id": benchmark.schema["item_id"].dataType, "matched": "long", "coverage": "double", "slots": "long"}
        return docs.where(F.lit(False)).select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    places = stored(
        hits.groupBy("doc_id", "item_id", "windows", "shift")
        .agg(F.count_distinct("offset").alias("matched"))
        .where(F.col("matched") >= F.col("windows") * min_coverage),
        "places",
    ).withColumnsRenamed({"doc_id": "at_id", "item_id": "of_item"})
    theirs = docs.select("doc_id", whole_text().alias("text"))
    items = benchmark.select("item_id", template_tokens(whole_text(), values=True).alias("item_words"))
    with_doc = (
        places.join(theirs, F.col("at_id").eqNullSafe(F.col("doc_id")))
        .select("doc_id", "of_item", "windows", "shift", "matched", template_tokens(F.col("text"), values=True).alias("doc_words"))
    )
    both = with_doc.join(items, F.col("of_item").eqNullSafe(F.col("item_id")))
    facing = F.slice("doc_words", F.greatest(F.col("shift"), F.lit(0)) + 1, F.size("item_words"))
    mine = F.slice("item_words", F.greatest(-F.col("shift"), F.lit(0)) + 1, F.size("item_words"))
    pairs = F.filter(
        F.zip_with(mine, facing, lambda b, d: F.struct(b.alias("b"), d.alias("d"))),
        lambda p: p["b"].startswith(NUM) & p["d"].startswith(NUM)
        | p["b"].startswith(NAME) & p["d"].startswith(NAME)
        | p["b"].startswith(UNIT) & p["d"].startswith(UNIT),
    )
    distinct = F.array_distinct(pairs)
    values = F.size(F.array_distinct(F.transform(distinct, lambda p: p["b"])))
    checked = both.select(
        "doc_id", "item_id", "matched", (F.col("matched") / F.col("windows")).alias("coverage"),
        F.size(distinct).alias("facing"), values.alias("slots"),
    )
    return (
        checked.where("facing = slots")
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("matched", "coverage", "slots")).alias("best"))
        .select("doc_id", "item_id", F.col("best.matched").cast("long").alias("matched"), "best.coverage", F.col("best.slots").cast("long").alias("slots"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    (hit_id,) = fresh(docs, "hit_id")
    hit = find_contamination(docs, benchmark, **options).select(F.col("doc_id").alias(hit_id)).distinct()
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col(hit_id)), "left_anti")
