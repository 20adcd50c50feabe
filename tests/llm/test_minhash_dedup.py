import random

from cartpulse.llm import minhash_dedup as M


def brute(docs, n):
    sets = {}
    for key, text in docs:
        w = (text or "").encode().lower().split()
        sets[key] = (set(zip(*[w[i:] for i in range(n)])) if len(w) >= n else {tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            both = len(x & y)
            if x and y and 100 * both >= 80 * (len(x) + len(y) - both):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {k: (len(sets[k]), find(k)) for k in keys}


def run(spark, docs, n=2):
    df = spark.createDataFrame([(i, t, "k") for i, t in docs], "doc_id long, text string, kept string")
    return M.near_duplicates(spark, df, n).collect()


def test_equals_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    docs = []
    for base in range(12):
        text = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 6, 30, 90, 200]))]
        for _ in range(rng.choice([1, 3, 14])):
            t = list(text)
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            docs.append((len(docs) * 3, rng.choice([" ", "\n", "  "]).join(t)))
    docs += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "W1"), (1004, "w1"), (1005, "one Two"),
             (1006, "ONE two"), (1007, "É a b"), (1008, "é a b")]
    got = {r.doc_id: r for r in run(spark, docs)}
    want = brute(docs, 2)
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == want
    assert all(r.kept == (k == want[k][1]) for k, r in got.items())


def test_large_group_of_near_copies(spark):
    # variants differ from the base by two words and from each other by four
    rng = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    docs = [(0, " ".join(base))]
    for i in range(1, 80):
        t = list(base)
        for p in rng.sample(range(60), rng.choice([1, 2, 3, 4])):
            t[p] = f"x{i}{p}"
        docs.append((i, " ".join(t)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in run(spark, docs)}
    assert got == brute(docs, 2)


def test_repeated_and_null_ids(spark):
    rows = run(spark, [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "q r s t"), (2, None)])
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id is not None) == [
        (2, 2, True), (5, 5, True), (5, 5, True)]
    nulls = sorted(str(r.component_id) for r in rows if r.doc_id is None)
    assert nulls == ["5", "None"]
    assert run(spark, []) == []


def test_one_of_each(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, 0), (2, text, 1), (2, text, 1), (3, "other words", 2),
                                  (3, "other words", 2), (4, None, 3)],
                                 "doc_id long, text string, component_id int")
    out = M.one_of_each(spark, docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100)],
                                  "a long, b long")
    got = {r.node: r.comp for r in M.components(spark, edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_long_texts(spark):
    rng = random.Random(7)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(150_000)]
    near = list(words)
    near[::40] = ["other"] * len(near[::40])
    far = [f"z{rng.randrange(10 ** 6)}" for _ in range(150_000)]
    got = {r.doc_id: r for r in run(spark, [(1, " ".join(far)), (2, " ".join(words)), (3, " ".join(near))])}
    assert [got[i].component_id for i in (1, 2, 3)] == [1, 2, 2] and got[2].n_shingles > 140_000
