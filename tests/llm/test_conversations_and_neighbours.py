"""Conversation repair, prefix trie and multi-index search against brute force, and their edge cases."""

import hashlib
import os
import random
import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import multi_index, prefix_trie, repair
from basketry.llm.queries import QUERIES, damaged
from basketry.llm.turns import joined_digests

FOLDER = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
LONG = "word " * 40_000 + "."
EDGES = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, None, "assistant", "Yes?"), (1, 2, None, None),
    (2, 5, "assistant", "late"), (2, 5, "assistant", "late!"), (2, 9, "", "no role."), (None, 1, "user", "no id."), (None, None, None, None),
    (3, 0, "user", LONG), (3, 1, "assistant", LONG), (3, 1, "assistant", LONG), (3, 3, "user", "é\U0001f600?"), (4, 7, "user", ""),
    (100, 0, "user", "shared."), (100, 1, "assistant", "shared too."), (101, 0, "user", "own."), (102, 0, "user", "own."), (199, 4, "user", "x."), (-5, 0, "user", "below."),
]


def clashing(df):
    return df.select("*", *[F.lit("x").alias(n) for n in "place conv c a b cut k h1 rows piece part depth n codes left rep vec dim".split()])


def of_conversations(df):
    return [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()]


# Repair -----------------------------------------------------------------------------------------


def least_edits(codes, start=repair.START, ends=repair.ENDS):
    """Least cost, then least audit, row by row over all states."""

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                to, way = repair.NEXT[state][repair.TURN[state]], (cost + 5, audit + "I")
                best[to] = min(best.get(to, way), way)
        return best

    best = inserted({start: (0, "")})
    for code in codes:
        after = {}
        for state, (cost, audit) in best.items():
            late, initial = 5 * code.isupper(), code.lower()
            ways = [(state, 2, "D")]
            if code != "x":
                ways.append((repair.NEXT[state][repair.TURN[state]], 1 + late, "R"))
                if initial in repair.NEXT[state]:
                    ways.append((repair.NEXT[state][initial], late, "K"))
            for to, more, edit in ways:
                way = (cost + more, audit + edit)
                after[to] = min(after.get(to, way), way)
        best = inserted(after)
    found = [best[e] for e in ends if e in best]
    return min(found) if found else None


def test_bidirectional_search_finds_the_least_audit():
    rng = random.Random(11)
    for n in range(400):
        codes = "".join(rng.choice("suauaoSUAOx") for _ in range(n % 23))
        for start in range(4):
            for ends in (repair.ENDS, (0,), (1,), (2,), (3,)):
                assert repair.cheapest(codes, start, ends) == least_edits(codes, start, ends)


def repaired_by_hand(rows):
    conversations = defaultdict(list)
    for c, turn, role, text in rows:
        conversations[c].append((turn is not None, turn or 0, role, text))
    out = {}
    for c, own in conversations.items():
        own = [(t, " " if r is None else r, " " if x is None else x) for has, t, r, x in sorted(own, key=lambda o: o[:2])]
        has = [turn for is_set, turn, _, _ in conversations[c] if is_set]
        gaps = max(has) - min(has) + 1 - len(set(has)) if has else 0
        seen, codes, initials, faults = set(), "", [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            visible = re.sub(r"[\x20\x09-\x0d]", "", text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else None
            if fault:
                faults[fault] += 1
            codes += "x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
            initials.append(initial)
            seen.add((role, text))
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = least_edits(codes)
        turns = [(role or own[at][1], own[at][2] if at >= 0 else "") for at, role in repair.walked(codes, audit, repair.START)[0]]
        out[c] = (gaps, *faults.values(), illegal, cost, audit, turns)
    return out


def repaired(spark, rows, **options):
    report, left = repair.repair_conversations(rows if hasattr(rows, "columns") else spark.createDataFrame(rows, TURNS), **options)
    turns = defaultdict(list)
    for r in sorted(left.collect(), key=lambda r: (r["cut"], r["k"])):
        turns[r["conv_id"]].append((r["role"], r["text"]))
    return {r["conv_id"]: (*[r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")], turns[r["conv_id"]]) for r in report.collect()}


@needs_data
def test_repair_query(spark):
    turns = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    want = repaired_by_hand(of_conversations(damaged(turns)))
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = {r["conv_id"]: tuple(r[c] for c in columns) for r in QUERIES["op11_conversation_repair"](spark, FOLDER).collect()}
    every = {r[0] for r in of_conversations(turns)}
    digest = lambda own: hashlib.sha256("\n".join(f"{r}:{x}" for r, x in own).encode()).hexdigest()
    assert got == {c: (*want[c][:-1], digest(want[c][-1])) if c in want else (0, 0, 0, 0, 0, 0, "", digest([])) for c in every}


def test_damage_by_crc(spark):
    rows = [(c, t, r, "One. Two! Three?") for c in (7, None) for t in (*range(60), None) for r in ("assistant", None)]
    got = sorted(map(repr, of_conversations(damaged(spark.createDataFrame(rows, TURNS)))))
    want = []
    for c, t, r, x in rows:
        kind = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: "One Two Three"}.get(kind, x)
        want += [(c, t, "user" if kind == 4 else r or " ", text)] * {0: 0, 3: 2}.get(kind, 1)
    assert got == sorted(map(repr, want))


def test_repair_edges_and_blocks(spark):
    # Rows of one turn stand by role initial and a hash, so that rows which differ have turns of their own here.
    rows = [r for r in EDGES if r[0] != 2]
    want = repaired_by_hand(rows)
    df = clashing(spark.createDataFrame(rows, TURNS))
    assert repaired(spark, df) == want
    assert repaired(spark, df, block_rows=2) == want
    tied = repaired(spark, [r for r in EDGES if r[0] == 2])[2]
    assert tied[:4] == (3, 0, 0, 1) and tied == repaired(spark, [r for r in EDGES if r[0] == 2][::-1])[2]
    assert repaired(spark, spark.createDataFrame([], TURNS)) == {}


def test_long_conversation_is_cut_without_changing_the_answer(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice([f"t{t}.", f"t{t}", "", "again."])) for t in range(300)]
    rows += [(2, t, rng.choice(["user", "assistant"]), f"t{t}.") for t in range(7)]
    want = repaired_by_hand(rows)
    assert repaired(spark, rows) == want
    assert repaired(spark, rows, block_rows=7) == want


def test_extreme_turns_give_no_gap(spark):
    rows = [(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")]
    assert repaired(spark, rows)[1][0] is None


def test_digest_streams_over_keys(spark):
    rows = [(i % 3, i, f"p{i}") for i in range(50)]
    df = joined_digests(spark.createDataFrame(rows, "k long, at long, part string"), ["k"], ["at"], "part", ",", "sha")
    want = {k: hashlib.sha256(",".join(f"p{i}" for i in range(k, 50, 3)).encode()).hexdigest() for k in range(3)}
    assert {r["k"]: r["sha"] for r in df.collect()} == want


# Trie -------------------------------------------------------------------------------------------

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in own.items()}
    head = lambda c: c - (abs(c) % 100) * (1 if c >= 0 else -1)
    share = {c: crc32(str(c).encode()) % 6 for c in own}
    built = {c: own.get(head(c), [])[: share[c]] + own[c][share[c] :] for c in own}
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
        ends[tuple(built[c])].append(c)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(kids[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends.get(n, []))).encode()).hexdigest())
        for n, m in members.items()
    )


def trie(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@needs_data
def test_trie_query(spark):
    rows = of_conversations(spark.read.parquet(f"{FOLDER}/conversations.parquet"))
    assert trie(QUERIES["op13_prefix_trie"](spark, FOLDER)) == trie_by_hand(rows)


def test_trie_edges(spark):
    rows = [r for r in EDGES if r[0] != 2]  # rows of one turn that differ: see the next test
    assert trie(prefix_trie.prefix_trie(clashing(spark.createDataFrame(rows, TURNS)))) == trie_by_hand(rows)
    assert trie(prefix_trie.prefix_trie(spark.createDataFrame([], TURNS))) == []
    assert trie(prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS))) == []


def test_trie_of_tied_turns_does_not_depend_on_row_order(spark):
    rows = [(300, 1, "user", f"t{i}") for i in range(9)]
    df = lambda r: trie(prefix_trie.prefix_trie(spark.createDataFrame(r, TURNS)))
    assert df(rows) == df(rows[::-1]) and len(df(rows)) == 10


def test_deep_and_wide_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "WINDOW_ROWS", 7)
    rng = random.Random(13)
    rows = [(1000, t, "user", f"deep {t}") for t in range(70)]
    rows += [(c, t, "user", f"deep {t}" if t < cut else f"own {c} {t}") for c in range(1001, 1060) for cut in [rng.randrange(40)] for t in range(rng.randrange(1, 45))]
    rows += [(2000 + c, t, "user", "copy") for c in range(40) for t in range(3)]
    assert trie(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == trie_by_hand(rows)


# Search -----------------------------------------------------------------------------------------


def nearest_by_hand(rows, asks, nearest):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if asks(q):
            others = {(-float((v * w).sum()), i) for i, w in good if i != q and len(w) == len(v)}
            out[q] = [(i, -s) for s, i in sorted(others)[:nearest]]
    return out


def answers(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


VECTORS = "vec_id long, embedding array<float>"


def test_search_edges(spark):
    one = [0.5, 0.25, -1.0]
    rows = [(i, one) for i in range(60)] + [(60, [1.0, 0.0, 0.0]), (61, [-0.0, 3.0, 0.0]), (62, None), (63, [0.0, 0.0, 0.0]), (64, [1.0, None, 0.0])]
    rows += [(65, [float("nan"), 1.0, 0.0]), (66, [float("inf"), 1.0, 0.0]), (None, one), (80, [1.0, 2.0]), (81, [2.0, 1.0]), (82, []), (100, [5.0])]
    asks = F.col("vec_id") % 20 == 0
    got = answers(multi_index.nearest_vectors(clashing(spark.createDataFrame(rows, VECTORS)), asks, 5))
    want = nearest_by_hand(rows, lambda q: q % 20 == 0, 5)
    assert {q: w for q, w in want.items() if w} == got
    assert got[0] == [(i, 1.3125) for i in range(1, 6)] and got[20][:2] == [(0, 1.3125), (1, 1.3125)]
    assert answers(multi_index.nearest_vectors(spark.createDataFrame([], VECTORS), asks)) == {}


def test_search_in_many_groups_ranks_by_inner_product(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 16)) * 2
    rows = [(i, [float(x) for x in np.float32(centres[i % 20] + rng.standard_normal(16) * (0.3 if i % 3 else 0.0))]) for i in range(1500)]
    got = answers(multi_index.nearest_vectors(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0, 10, sample_rows=300, group_rows=64))
    want = nearest_by_hand(rows, lambda q: q % 50 == 0, 10)
    assert got.keys() == want.keys()
    right = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert right >= 0.9 * sum(map(len, want.values()))
    scores = dict(rows)
    for q, found in got.items():
        assert len(found) == 10 and found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - np.dot(scores[q], scores[i])) < 1e-9 for i, s in found)


@needs_data
def test_search_recall(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    want = nearest_by_hand(rows, lambda q: q % 20 == 0, 20)
    got = answers(QUERIES["op12_multi_index"](spark, FOLDER))
    assert all(len(got[q]) == 20 for q in want) and got.keys() == want.keys()
    right = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert right >= 0.9 * 20 * len(want)


def test_codes_find_everything_within_the_radius():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, (400, multi_index.TABLES)).astype(np.uint64)
    near = words.copy()
    near[:, 0] ^= np.uint64(0b1011)
    apart = multi_index.distances(words, near)
    assert (apart == 3).all()
    share = 3 // multi_index.TABLES
    assert (np.bitwise_count(words ^ near) <= share).any(1).all()
