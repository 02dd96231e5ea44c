"""Conversation prefix trie with subtree totals by parallel tree contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.turns import joined_digests, placed_turns
from basketry.materialize import stored

#: Conversations share the opening of the one whose id is theirs less this remainder.
FAMILY = 100
MOST_SHARED = 6
#: Places in one window; longer conversations are cut.
WINDOW_ROWS = 4096
NO_TEXT = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def shared_turns(conversation: Column) -> Column:
    """How many turns a conversation takes over from the head of its family."""
    return (F.crc32(conversation.cast("string").cast("binary")) % MOST_SHARED).cast("long")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations as slim rows (``c, place, t1, t2, chars, last``; hashes of role and text, the text's
    length) and the table of all conversations (``c, length``), turnless ones included."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    slim = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn"), F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(7), role, text).alias("t2"), F.length(text).cast("long").alias("chars"),
    )
    placed = stored(placed_turns(slim, "c", "t1", "t2"), "placed")
    sizes = placed.groupBy("c").agg(F.max("place").alias("n"))
    heads = sizes.where(F.col("c") % FAMILY == 0).select(F.col("c").alias("head"), F.col("n").alias("head_n"))
    plan = (
        sizes.withColumn("h", shared_turns(F.col("c"))).withColumn("head", F.col("c") - F.col("c") % FAMILY)
        .join(heads, "head", "left")
        .withColumn("taken", F.least("h", F.coalesce("head_n", F.lit(0))).cast("long"))
        .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .select("c", "head", "h", "taken", "length")
    )
    plan = stored(plan, "plan")
    row = ["c", "place", "t1", "t2", "chars", "length"]
    own = (
        placed.join(plan.select("c", "h", "taken", "length"), "c").where("place > h")
        .withColumn("place", F.col("place") - F.col("h") + F.col("taken")).select(*row)
    )
    opening = placed.where((F.col("c") % FAMILY == 0) & (F.col("place") < MOST_SHARED)).withColumnRenamed("c", "head")
    taken = opening.join(plan.select("c", "head", "taken", "length"), "head").where("place <= taken").select(*row)
    rows = own.unionByName(taken).withColumn("last", F.col("place") == F.col("length")).drop("length")
    return rows, plan.select("c", "length")


def prefix_rows(rows: DataFrame) -> DataFrame:
    """``rows`` with the key of the prefix that ends there (``a, b``) and of the one before (``pa, pb``).

    A prefix is known by the exclusive or of the hashes of its (place, turn) pairs, 128 bits in all. That
    can be added up in any order, so long conversations are cut into windows and the totals of
    the earlier windows are added.
    """
    keyed = stored(
        rows.withColumns({"k1": F.xxhash64("place", "t1", "t2"), "k2": F.xxhash64(F.lit(11), "t2", "place", "t1"), "cut": F.floor((F.col("place") - 1) / WINDOW_ROWS)})
        .drop("t1", "t2"),
        "rebuilt",
    )
    upto = Window.partitionBy("c", "cut").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    inner = keyed.withColumns({"a": F.bit_xor("k1").over(upto), "b": F.bit_xor("k2").over(upto)})
    earlier = Window.partitionBy("c").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    whole = (
        keyed.groupBy("c", "cut").agg(F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2"))
        .select("c", "cut", F.coalesce(F.bit_xor("x1").over(earlier), F.lit(0)).alias("x1"), F.coalesce(F.bit_xor("x2").over(earlier), F.lit(0)).alias("x2"))
    )
    return (
        inner.join(whole, ["c", "cut"])
        .withColumns({"a": F.col("a").bitwiseXOR(F.col("x1")), "b": F.col("b").bitwiseXOR(F.col("x2"))})
        .withColumns({"pa": F.col("a").bitwiseXOR(F.col("k1")), "pb": F.col("b").bitwiseXOR(F.col("k2"))})
        .select("c", "place", "last", "chars", "a", "b", "pa", "pb")
    )


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """``a, b, leaves, saved``: what every subtree of a tree holds of both measures.

    ``nodes`` has ``a, b`` (key), ``pa, pb`` (the parent's, null at the one root), ``depth, pdepth, kids`` (children) and the
    node's own ``leaves, saved``. Each round rakes all leaves into their parents and then compresses unary
    chains: a node with one child is taken out if the round's bit of its depth is set and that of its parent's
    depth is not, so no two neighbours go at once and chains halve. A node taken out sends what it
    holds to its parent in the next round, as a leaf does, and its child moves up. Then the rounds are
    undone from the last to the first: a node taken out has its own share and its child's total, which is known by then.
    The tables of the rounds shrink with the tree.
    """
    spark = nodes.sparkSession
    bits = max(1, int(nodes.agg(F.max("depth")).first()[0] or 0).bit_length())
    live = stored(nodes.select("a", "b", "pa", "pb", "depth", "pdepth", "kids", "leaves", "saved"), "live")
    rounds: list[tuple[DataFrame, DataFrame]] = []
    while live.count() > 1:
        bit = 1 << (len(rounds) % bits)
        low, ghost = F.col("kids") <= 0, F.col("kids") < 0
        up = (
            live.where("depth > 0").groupBy(F.col("pa").alias("ua"), F.col("pb").alias("ub")).agg(
                F.count_if(low & ~ghost).alias("gone"),
                F.coalesce(F.sum(F.when(low, F.col("leaves"))), F.lit(0)).alias("up_leaves"),
                F.coalesce(F.sum(F.when(low, F.col("saved"))), F.lit(0)).alias("up_saved"),
                F.coalesce(F.bit_xor(F.when(~low, F.col("a"))), F.lit(0)).alias("ca"),
                F.coalesce(F.bit_xor(F.when(~low, F.col("b"))), F.lit(0)).alias("cb"),
            )
        )
        grown = live.where("kids > 0").join(up, (F.col("a") == F.col("ua")) & (F.col("b") == F.col("ub"))).select(
            "a", "b", "pa", "pb", "depth", "pdepth", (F.col("kids") - F.col("gone")).alias("kids"),
            (F.col("leaves") + F.col("up_leaves")).alias("leaves"), (F.col("saved") + F.col("up_saved")).alias("saved"), "ca", "cb",
        )
        out = (F.col("kids") == 1) & (F.col("depth") > 0) & (F.col("depth").bitwiseAND(bit) != 0) & (F.col("pdepth").bitwiseAND(bit) == 0)
        grown = stored(grown.withColumn("out", F.coalesce(out, F.lit(False))), "grown")
        taken = grown.where("out")
        raked = live.where("kids = 0 AND depth > 0").select("a", "b", "leaves", "saved")
        rounds.append((raked, taken.select("a", "b", "leaves", "saved", "ca", "cb")))
        moved = taken.select(F.col("ca").alias("ma"), F.col("cb").alias("mb"), F.col("pa").alias("na"), F.col("pb").alias("nb"), F.col("pdepth").alias("nd"))
        stay = grown.where("NOT out").join(moved, (F.col("a") == F.col("ma")) & (F.col("b") == F.col("mb")), "left").select(
            "a", "b", *[F.when(F.col("ma").isNull(), F.col(old)).otherwise(F.col(new)).alias(old) for old, new in (("pa", "na"), ("pb", "nb"))],
            "depth", F.when(F.col("ma").isNull(), F.col("pdepth")).otherwise(F.col("nd")).alias("pdepth"), "kids", "leaves", "saved",
        )
        ghosts = taken.withColumn("kids", F.lit(-1).cast("long")).select(*stay.columns)
        live = stored(stay.unionByName(ghosts), "live")
    known = live.select("a", "b", "leaves", "saved")
    for raked, taken in reversed(rounds):
        child = known.select(F.col("a").alias("ca"), F.col("b").alias("cb"), F.col("leaves").alias("c_leaves"), F.col("saved").alias("c_saved"))
        back = taken.join(child, ["ca", "cb"]).select(
            "a", "b", (F.col("leaves") + F.col("c_leaves")).alias("leaves"), (F.col("saved") + F.col("c_saved")).alias("saved")
        )
        known = stored(known.unionByName(back).unionByName(raked), "known")
    return known


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by ``turn`` (null first) and, where turns are equal, by a hash of role and text, so that repeated
    rows stay beside each other. Null role or text is empty. Rows without a conv_id belong to no
    conversation and are left out. Prefixes are compared by 128-bit hashes of whole texts. Further columns of ``turns`` are not
    used. An empty table has no node, not even the root.
    """
    rows, conversations = rebuilt_turns(turns)
    rows = stored(prefix_rows(rows), "prefixes")
    all_of_them = conversations.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    root = all_of_them.select(zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("chars"))
    found = rows.groupBy("a", "b", "pa", "pb", F.col("place").cast("long").alias("depth")).agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars")
    )
    nodes = stored(found.unionByName(root), "nodes")
    kids = nodes.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("kids"))
    nodes = stored(nodes.join(kids, ["a", "b"], "left").withColumn("kids", F.coalesce("kids", F.lit(0))), "nodes")
    totals = subtree_totals(
        nodes.withColumns({
            "pdepth": F.when(F.col("depth") > 0, F.col("depth") - 1), "leaves": (F.col("kids") == 0).cast("long"),
            "saved": (F.col("n_convs") - 1) * F.col("chars"),
        })
    )
    ends = rows.where("last").select("a", "b", "c").unionByName(conversations.where("length = 0").select(zero.alias("a"), zero.alias("b"), "c"))
    digests = joined_digests(ends.withColumn("part", F.col("c").cast("string")), ["a", "b"], ["c"], "part", ",", "ends_sha256")
    parents = nodes.where("kids > 0").select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(totals, ["a", "b"]).join(digests, ["a", "b"], "left").join(parents, ["pa", "pb"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_TEXT)).alias("ends_sha256"),
        )
    )
