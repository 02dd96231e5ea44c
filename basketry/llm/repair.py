"""Repair of conversation structure by cheapest edits.

A conversation is legal when its role initials read ``(s?(ua)+)?``. Its edit lattice has a node per
(rows read, state of that pattern); an edge is an edit of the next row or an insertion.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.turns import placed_turns
from basketry.materialize import stored

#: Rows of a conversation that one search sees; longer conversations are cut and the pieces joined.
BLOCK_ROWS = 256
RESERVED = "\x20\x09-\x0d"
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
#: States of the pattern: at the start, after "s", after "u", after "a".
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
TURN = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
#: States from which a turn in order leads to a state.
TURNED = {state: [b for b in range(4) if NEXT[b][TURN[b]] == state] for state in range(4)}
ROLE = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")


#: A conversation as a string of codes: a row's role initial (o: any other), upper case if cut off; x: to be deleted.


def _steps(codes: str, i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """Edges out of a node: cost, edit, and the node they lead to."""
    turn = TURN[state]
    yield INSERT, "I", i, NEXT[state][turn]
    if i == len(codes):
        return
    yield DELETE, "D", i + 1, state
    code = codes[i]
    if code == "x":
        return
    late = CUT_OFF if code.isupper() else 0
    if code.lower() in NEXT[state]:
        yield late, "K", i + 1, NEXT[state][code.lower()]
    if code.lower() != turn:
        yield late + REROLE, "R", i + 1, NEXT[state][turn]


def _steps_back(codes: str, i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """Edges into a node: cost, edit, and the node they come from."""
    for before in TURNED[state]:
        yield INSERT, "I", i, before
    if i == 0:
        return
    yield DELETE, "D", i - 1, state
    code = codes[i - 1]
    if code == "x":
        return
    late, initial = CUT_OFF if code.isupper() else 0, code.lower()
    for before in range(4):
        if NEXT[before].get(initial) == state:
            yield late, "K", i - 1, before
    for before in TURNED[state]:
        if initial != TURN[before]:
            yield late + REROLE, "R", i - 1, before


@lru_cache(maxsize=50_000)
def cheapest(codes: str, start: int = START, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits that lead from ``start`` before the first row to one of ``ends`` after
    the last, the least audit in ASCII order among them, by bidirectional Dijkstra; None if no edits do.

    Two heaps, ordered by cost, rows passed and audit, settle nodes from both ends. At equal cost no audit
    that leads to a node is the beginning of another one (it would differ by insertions, which cost), so
    the least audit of a node is its neighbour's least audit and the edit between. Crossings are counted at
    nodes and edges; once both heads together exceed the cheapest crossing, all crossings of that cost are
    known, and the least concatenation is the answer.
    """
    n, steps = len(codes), (_steps, _steps_back)
    heaps = [[(0, 0, "", 0, start)], [(0, 0, "", n, e) for e in ends]]
    settled: list[dict[tuple[int, int], tuple[int, str]]] = [{}, {}]
    best: tuple[int, str] | None = None
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best[0]):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        mine, other = settled[side], settled[1 - side]
        cost, _, audit, i, state = heappop(heaps[side])
        if (i, state) in mine:
            continue
        mine[i, state] = cost, audit
        reached = [(0, audit, (i, state))]
        for more, edit, j, at in steps[side](codes, i, state):
            if (j, at) not in mine:
                longer = audit + edit if side == 0 else edit + audit
                heappush(heaps[side], (cost + more, j if side == 0 else n - j, longer, j, at))
                reached.append((more, longer, (j, at)))
        for more, longer, node in reached:
            if node in other:
                far, rest = other[node]
                crossing = cost + more + far, longer + rest if side == 0 else rest + longer
                best = crossing if best is None else min(best, crossing)
    return best


def walked(codes: str, audit: str, state: int) -> tuple[list[tuple[int, str | None]], int]:
    """What an audit leaves of a block entered in ``state``: per turn the place of its row (-1: inserted) and its
    new role (null: its own), and the state after the block."""
    out, i = [], 0
    for edit in audit:
        if edit == "K":
            out.append((i, None))
            state = NEXT[state][codes[i].lower()]
        elif edit != "D":
            out.append((i if edit == "R" else -1, ROLE[TURN[state]]))
            state = NEXT[state][TURN[state]]
        i += edit != "I"
    return out, state


_CHOSEN = "conv string, cut long, state int, cost long, audit string"
_ROUTES = "conv string, cut long, routes array<struct<s:int,t:int,cost:long,audit:string>>"
_LEFT = "conv string, cut long, left array<struct<at:int,role:string>>"


def _routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cheapest routes through every block of a long conversation: from each state to each state."""
    kind = pa.list_(pa.struct([("s", pa.int32()), ("t", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    for batch in batches:
        routes = []
        for cut, codes in zip(batch.column("cut").to_pylist(), batch.column("codes").to_pylist(), strict=True):
            own = [(s, t, cheapest(codes, s, (t,))) for s in ((START,) if cut == 0 else range(4)) for t in range(4)]
            routes.append([{"s": s, "t": t, "cost": r[0], "audit": r[1]} for s, t, r in own if r])
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("cut"), pa.array(routes, kind)], ["conv", "cut", "routes"])


def _chosen_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [cheapest(codes) for codes in batch.column("codes").to_pylist()]
        n = len(found)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array([0] * n, pa.int64()), pa.array([START] * n, pa.int32()), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
            ["conv", "cut", "state", "cost", "audit"],
        )


class _Line:
    """The best ways through the blocks of one conversation so far, one for each state they end in. What
    all ways share at their beginning is settled and leaves memory."""

    def __init__(self, conv: str):
        self.conv = conv
        self.ways = {START: (0, [])}
        self.done: list[tuple] = []

    def add(self, cut: int, routes: list[dict]) -> None:
        new: dict[int, tuple[int, list]] = {}
        for r in routes:
            if r["s"] in self.ways:
                cost, pieces = self.ways[r["s"]]
                way = (cost + r["cost"], [*pieces, (cut, r["s"], r["cost"], r["audit"])])
                if r["t"] not in new or _key(way) < _key(new[r["t"]]):
                    new[r["t"]] = way
        self.ways = new
        while all(w[1] for w in new.values()) and len({w[1][0] for w in new.values()}) == 1:
            self.done.append(next(iter(new.values()))[1][0])
            for w in new.values():
                w[1].pop(0)

    def end(self) -> list[tuple]:
        pieces = min((self.ways[e] for e in ENDS if e in self.ways), key=_key)[1]
        return [(self.conv, cut, s, cost, audit) for cut, s, cost, audit in pieces]

    def ready(self) -> list[tuple]:
        rows, self.done = [(self.conv, cut, s, cost, audit) for cut, s, cost, audit in self.done], []
        return rows


def _key(way: tuple[int, list]) -> tuple[int, str]:
    return way[0], "".join(p[3] for p in way[1])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of long conversations, in order, with the routes of the cheapest way through all of them."""
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
    names = ["conv", "cut", "state", "cost", "audit"]
    line = None
    for batch in batches:
        rows = []
        for conv, cut, routes in zip(*(batch.column(c).to_pylist() for c in ("conv", "cut", "routes")), strict=True):
            if line is None or line.conv != conv:
                rows += line.end() if line else []
                line = _Line(conv)
            line.add(cut, routes)
            rows += line.ready()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)
    if line:
        rows = line.end()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns that the chosen audits leave of each block."""
    kind = pa.list_(pa.struct([("at", pa.int32()), ("role", pa.string())]))
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("codes", "audit", "state")]
        left = [[{"at": at, "role": role} for at, role in walked(c, a, s)[0]] for c, a, s in zip(*columns, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("cut"), pa.array(left, kind)], ["conv", "cut", "left"])


def row_faults(turns: DataFrame) -> DataFrame:
    """Slim rows of the conversations in order: ``conv, place, turn, initial, fault, h1, h2``."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    blank = ~text.rlike(f"[^{RESERVED}]")
    ended = text.rlike(rf"[.!?][{RESERVED}]*\z")
    initial = F.substring(role, 1, 1)
    slim = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"), blank.alias("blank"), ended.alias("ended"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(7), role, text).alias("h2"),
    )
    placed = stored(placed_turns(slim, "conv", "initial", "h1", "h2"), "placed")
    again = placed.groupBy("conv", "h1", "h2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("place") > F.col("first"), "duplicate").when(~F.col("ended"), "truncated").otherwise("")
    )
    return placed.join(again, ["conv", "h1", "h2"], "left").select("conv", "place", "turn", "initial", fault.alias("fault"), "h1", "h2")


def repair_conversations(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """``(report, repaired)`` for conversations given as rows of ``conv_id, turn, role, text``.

    ``report`` has a row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.
    ``repaired`` has the turns after the repair: ``conv_id, cut, k`` (their order), ``role, text`` and ``inserted``.

    Rows stand in order of turn (null first), then role initial, then a hash of role and text; equal rows stand
    side by side and all but the first are duplicates. A null role or text is one space; a null conv_id is a
    conversation of its own with a null id. A role that does not begin with s, u or a (an empty one too) can only be changed or
    deleted. Gaps that exceed a long are null. Texts are compared by 128-bit hashes of whole texts. A conversation of more than ``block_rows`` rows is cut: a
    search finds the cheapest routes through each block between any two states, and a pass over the
    blocks keeps the best way to each state. Further columns are ignored; an empty table gives empty results.
    """
    rows = stored(row_faults(turns), "rows")
    code = (
        F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    )
    kept = F.struct("place", code.alias("code"), "initial", "h1", "h2")
    cells = (
        rows.withColumn("cut", F.floor((F.col("place") - 1) / block_rows)).groupBy("conv", "cut").agg(F.sort_array(F.collect_list(kept)).alias("rows"))
        .select(
            "conv", "cut", F.array_join(F.col("rows.code"), "").alias("codes"), F.array_join(F.col("rows.initial"), "").alias("initials"),
            F.transform("rows", lambda r: F.struct(r["h1"].alias("h1"), r["h2"].alias("h2"))).alias("hashes"),
        )
    )
    counts = (
        rows.groupBy("conv").agg(
            F.max("place").alias("n"), F.max("turn").alias("high"), F.min("turn").alias("low"),
            *[F.count_if(F.col("fault") == x).alias(x) for x in ("blank", "duplicate", "truncated")],
        )
        .join(rows.where("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv").agg(F.count(F.lit(1)).alias("turns")), "conv", "left")
    )
    counts = stored(counts, "counts")
    blocks = stored(cells.join(counts.select("conv", "n"), "conv"), "blocks")
    whole = blocks.where(F.col("n") <= block_rows).select("conv", "codes").mapInArrow(_chosen_whole, _CHOSEN)
    routes = blocks.where(F.col("n") > block_rows).select("conv", "cut", "codes").mapInArrow(_routed, _ROUTES)
    long_ones = routes.repartition("conv").sortWithinPartitions("conv", "cut").mapInArrow(_joined, _CHOSEN)
    chosen = stored(whole.unionByName(long_ones), "chosen")
    pair = F.concat(F.substring("initials", -1, 1), F.substring("next", 1, 1))
    # Pairs inside a block, and the one between a block and the next.
    pairs = F.transform(F.sequence(F.lit(1), F.length("initials") - 1), lambda i: F.substring(F.col("initials"), i, F.lit(2)))
    inside = F.when(F.length("initials") > 1, F.size(F.filter(pairs, lambda p: ~p.isin(*LEGAL_PAIRS)))).otherwise(0)
    heads = blocks.where("cut > 0").select("conv", (F.col("cut") - 1).alias("cut"), F.col("initials").alias("next"))
    illegal = (
        blocks.join(heads, ["conv", "cut"], "left")
        .select("conv", (inside + F.when(F.col("next").isNotNull() & ~pair.isin(*LEGAL_PAIRS), 1).otherwise(0)).alias("illegal"))
        .groupBy("conv").agg(F.sum("illegal").cast("long").alias("illegal"))
    )
    audits = chosen.groupBy("conv").agg(
        F.sum("cost").alias("cost"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("cut", "audit"))), lambda x: x["audit"]), "").alias("audit")
    )
    named = F.when(F.col("conv") != " ", F.col("conv").cast("long")).alias("conv_id")
    gaps = F.expr("try_subtract(try_add(try_subtract(high, low), 1L), turns)")
    report = counts.join(illegal, "conv").join(audits, "conv").select(
        named, F.when(F.col("high").isNull(), F.lit(0)).otherwise(gaps).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )
    left = blocks.select("conv", "cut", "codes").join(chosen, ["conv", "cut"]).select("conv", "cut", "codes", "state", "audit").mapInArrow(_left, _LEFT)
    staying = left.join(blocks.select("conv", "cut", "hashes"), ["conv", "cut"]).select("conv", "cut", "hashes", F.posexplode("left").alias("k", "one")).select(
        "conv", "cut", "k", F.col("one.role").alias("new_role"), F.when(F.col("one.at") >= 0, F.col("hashes")[F.greatest(F.col("one.at"), F.lit(0))]).alias("h")
    )
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    texts = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"), F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(7), role, text).alias("h2"), role.alias("role"), text.alias("text")
    ).dropDuplicates(["conv", "h1", "h2"])
    staying = staying.select("conv", "cut", "k", "new_role", F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2"))
    repaired = staying.join(texts, ["conv", "h1", "h2"], "left").select(
        named, "cut", "k", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.col("h1").isNull().alias("inserted")
    )
    return report, repaired
