import random
import re

import numpy as np
import pytest
import xxhash

from cartpulse.llm import simhash_dedup as S


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)][:len(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(points):
    """Smallest index reachable over 4 bits or fewer."""
    parent = list(range(len(points)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(points):
        for j in range(i):
            if bin(a ^ points[j]).count("1") <= 4:
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return [find(i) for i in range(len(points))]


def crowd(rng, n, spread=3):
    """Points in balls of several sizes and lone ones."""
    out = []
    for size in [n // 3, n // 6, n // 12, 5, 2]:
        middle = rng.getrandbits(64)
        for _ in range(size):
            p = middle
            for _ in range(rng.randrange(spread + 1)):
                p ^= 1 << rng.randrange(64)
            out.append(p)
        chain = middle
        for _ in range(6):  # a chain of links leaves the ball
            for _ in range(4):
                chain ^= 1 << rng.randrange(64)
            out.append(chain)
    return out + [rng.getrandbits(rng.choice([8, 64])) for _ in range(n // 3)]


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows],
                                 "doc_id long, text string, point int, low int")


def check(got, rows):
    prints = [brute_print(t) for _, t in rows]
    comp = brute_components(prints)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted((str(i), f"{p:016x}", str(least.get(c))) for (i, _), p, c in zip(rows, prints, comp))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_fingerprint_in_blocks(monkeypatch):
    rng = random.Random(1)
    for block in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(S, "BLOCK", block)
        for n in (0, 1, 2, 3, 4, 5, 9, 200):
            text = "".join(rng.choice(["Ab", "é", "x", "İ"]) * rng.randrange(1, 9)
                           + rng.choice([" ", "\n\t ", "\x0b", "  "]) for _ in range(n))
            assert S.fingerprint(text.encode()) == brute_print(text), (block, n)


@pytest.mark.parametrize("pairs", [1, 50, 2000, 1 << 30])
def test_link_equals_brute_force(monkeypatch, pairs):
    monkeypatch.setattr(S, "PAIRS", pairs)
    monkeypatch.setattr(S, "COMPARED", 64)
    rng = random.Random(pairs)
    points = sorted(set(crowd(rng, 400)))
    want = brute_components(points)
    arr = np.array(points, np.uint64)
    forest = S.Forest(len(arr))
    everything = np.arange(len(arr))
    for mask in S.PARTS:
        S.link(arr, everything, everything[:0], mask, forest)
    assert forest.roots(everything).tolist() == want


def test_shards_hold_every_pair(monkeypatch):
    monkeypatch.setattr(S, "PAIRS", 20)
    rng = random.Random(8)
    points = np.array(sorted(set(crowd(rng, 900))), np.uint64)
    forest = S.Forest(len(points))
    shards = 0
    for mask in S.PARTS:
        tree = S.Tree(mask).grow(points[::3], len(points), 60)
        shards += tree.shards
        homes_met = []
        for _, homes, guests in tree.route(points):
            S.link(points, homes, guests, mask, forest)
            homes_met.append(homes)
            assert len(np.unique(np.concatenate([homes, guests]))) == len(homes) + len(guests)
        assert sorted(np.concatenate(homes_met)) == list(range(len(points)))
    assert shards > 12
    assert forest.roots(np.arange(len(points))).tolist() == brute_components(points.tolist())


@pytest.mark.parametrize("group", [1 << 20, 40])
def test_documents_equal_brute_force(spark, group):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    rows, at = [], 0
    for size in (1, 2, 40, 9, 3, 1, 1, 1):
        words = [rng.choice(vocab) for _ in range(rng.choice([150, 400]))]
        for k in range(size):
            copy = list(words)
            for _ in range(k % 4):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((at * 7 % 1009, " ".join(copy)))
            at += 1
    rows += [(2001, None), (2002, ""), (2003, " \n"), (2004, "One"), (2005, "one two"), (2004, "oNE"),
             (None, "one"), (None, "lonely words that only this text has"), (3, "ONE TWO"),
             (2006, "x " * 30000), (2007, "x " * 29000)]
    got = S.near_duplicates(spark, docs_frame(spark, rows), shard=10, group=group).collect()
    check(got, rows)


def test_blocks_of_a_crowded_shard(spark):
    rng = random.Random(11)
    points = sorted(set(crowd(rng, 300)))
    low = {p: i for i, p in enumerate(points)}
    nodes = spark.createDataFrame([(int(np.uint64(p).view(np.int64)), i) for p, i in low.items()],
                                  "point long, low long").cache()
    edges = S.links(spark, nodes, shard=64, group=32).collect()
    forest = S.Forest(len(points))
    forest.union(np.array([e.a.low for e in edges]), np.array([e.b.low for e in edges]))
    assert forest.roots(np.arange(len(points))).tolist() == brute_components(points)


def test_empty_table(spark):
    assert S.near_duplicates(spark, docs_frame(spark, [])).collect() == []
