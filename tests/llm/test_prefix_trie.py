import hashlib
import random
import zlib

import pytest

from cartpulse.llm import prefix_trie as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "ends_sha256"]


def brute(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, ts in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(original.get(c - c % 100, [])[:h] + ts[h:])
    members = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    inner = {n[:-1] for n in members if n}
    children, leaves, saved = ({n: 0 for n in members} for _ in range(3))
    for n in members:
        if n:
            children[n[:-1]] += 1
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in inner
            saved[n[:d]] += (len(members[n]) - 1) * len(n[-1][1]) if n else 0
    out = []
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    children[node], leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def made(seed, convs=50, deep=30):
    """Shared beginnings, one very common first turn, copies, one deep conversation."""
    rng = random.Random(seed)
    rows = []
    ids = rng.sample(range(0, 420), convs) + [0, 200]
    shared = [("user", f"question {i}") for i in range(3)]
    for c in dict.fromkeys(ids):
        path = list(shared[:rng.randrange(4)]) if rng.random() < 0.5 else []
        path += [(rng.choice(["user", "bot", None]), rng.choice(["a", "bb", "ccc é", None, ""]))
                 for _ in range(rng.randrange(0, 9))]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(path)]
    rows += [(7, k, "user", f"turn {k % 3}") for k in range(deep)]
    return rows


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, node int, piece string")
    got = P.prefix_trie(spark, df, **options)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("limit", [40, 100_000])
def test_equals_brute_force(spark, limit):
    rows = made(limit)
    assert run(spark, rows, limit=limit) == sorted(brute(rows), key=str)


def test_copies_and_members_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(P, "RANGE", 4)
    rows = [(c, k, "user", t) for c in range(300, 400) for k, t in enumerate("abcdefgh")]
    rows += [(c, 0, "bot", "") for c in range(500, 520)]
    assert run(spark, rows, limit=200) == sorted(brute(rows), key=str)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 0, "user", "none"), (1, None, "user", "first"), (1, 5, None, None), (1, 5, None, None),
            (1, 5, None, ""), (2, None, "user", "first"), (100, 0, "a", "x"), (100, 1, "a", "y"),
            (101, 3, "b", "long " * 5000), (102, 1, "a", "y")]
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "a", "b")]) == []


def test_one_conversation_over_many_pieces(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(5, k, "user", str(k * k % 17)) for k in range(900)] + [(6, 0, "user", "0")]
        assert run(spark, rows, limit=450) == sorted(brute(rows), key=str)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_roll_up_of_odd_shapes():
    rng = random.Random(2)
    for n in (1, 2, 3, 10, 400):
        for kind in ("path", "star", "random", "broom"):
            parent = [-1] + [{"path": i - 1, "star": 0, "random": rng.randrange(i),
                              "broom": min(i - 1, n // 2)}[kind] for i in range(1, n)]
            own = [[rng.randrange(9) for _ in range(n)] for _ in range(2)]
            want = [list(x) for x in own]
            for u in range(n - 1, 0, -1):
                for w in want:
                    w[parent[u]] += w[u]
            assert P.roll_up(parent, own, [list(range(n))]) == want
