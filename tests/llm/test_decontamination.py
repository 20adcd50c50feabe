import random

from cartpulse.llm import decontamination as D

VOCAB = [f"w{i}" for i in range(400)]


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, score double"),
            spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string"))


def test_planted_passages_and_clean_texts(spark):
    rng = random.Random(1)
    def some(n):
        return [rng.choice(VOCAB) for _ in range(n)]
    items = [(k, " ".join(some(rng.randrange(20, 60)))) for k in range(20)]
    docs, want = [], set()
    for k, t in items:
        docs.append((k, " ".join(some(30)) + "\n" + t.upper() + "! " + " ".join(some(30))))
        want.add((k, k))
        # two substitutions, ten words apart
        w = t.split()
        w[4], w[14] = "zzz", "yyy"
        docs.append((100 + k, " ".join(some(10) + w)))
        want.add((100 + k, k))
        docs.append((200 + k, " ".join(some(120))))
    d, b = frames(spark, docs, items)
    rows = D.contaminated(spark, d, b).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    exact = [r for r in rows if r.doc_id < 100]
    assert all(r.score == r.matched_words == r.run_words and r.start_word == 30 for r in exact)
    kept = D.clean(spark, d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(200, 220))


def test_edge_rows(spark):
    t = " ".join(f"q{i}" for i in range(30))
    docs = [(1, t), (1, t), (None, t), (2, None), (3, ""), (4, "..."), (5, t[:20])]
    items = [(7, t), (8, t), (None, None), (9, ""), (10, "too short to search")]
    d, b = frames(spark, docs, items)
    rows = D.contaminated(spark, d, b).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in rows) == [("1", 7), ("1", 8), ("None", 7), ("None", 8)]
    assert sorted(str(r.doc_id) for r in D.clean(spark, d, b).collect()) == ["2", "3", "4", "5"]
    d0, b0 = frames(spark, [], [])
    assert D.contaminated(spark, d0, b).count() == 0 and D.contaminated(spark, d, b0).count() == 0


def test_best_run(spark):
    df = spark.createDataFrame([([True, False, True, True, False, True, True, True],), ([],), ([False],)],
                               "e array<boolean>")
    got = [(r.s.score, r.s.start, r.s.end) for r in df.select(D.best_run(df.e).alias("s")).collect()]
    assert got == [(3, 5, 8), (0, 0, 0), (0, 0, 0)]


def test_short_items(spark):
    """Items under the shortest mask are found verbatim, tiny ones as whole texts."""
    ten, five, four = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("t", 10), ("f", 5), ("z", 4)))
    items = [(1, ten), (2, five), (3, four), (4, "tiny")]
    docs = [(1, f"some words {ten} and more"), (2, f"{five}"), (3, f"x {four} y"), (4, four.upper() + "!"),
            (5, "a tiny text of its own kind here"), (6, "Tiny."), (7, ten.replace("t5", "other")),
            (8, " ".join(["pad"] * 50_000) + " " + ten)]
    d, b = frames(spark, docs, items)
    rows = {(r.doc_id, r.item_id): (r.score, r.start_word) for r in D.contaminated(spark, d, b).collect()}
    assert rows == {(1, 1): (10, 2), (2, 2): (5, 0), (4, 3): (4, 0), (6, 4): (1, 0), (8, 1): (10, 50_000)}


def test_two_inner_substitutions_in_sixteen(spark):
    item = [f"s{i}" for i in range(16)]
    pairs = [(i, j) for i in range(3, 13) for j in range(i + 1, 13)]
    docs = []
    for k, (i, j) in enumerate(pairs):
        w = list(item)
        w[i], w[j] = "other", "words"
        docs.append((k, "before it " + " ".join(w) + " after it"))
    d, b = frames(spark, docs, [(1, " ".join(item))])
    seeded = {k for k, pair in enumerate(pairs) if any(
        not any(p + at in pair for at, bit in enumerate(m) if bit == "1")
        for m in D.MASKS for p in range(16 - len(m) + 1))}
    rows = {r.doc_id: r.score for r in D.contaminated(spark, d, b).collect()}
    assert set(rows) == seeded and len(seeded) >= 0.7 * len(pairs)
    assert min(rows.values()) >= 10


def test_clashing_names(spark):
    t = " ".join(f"q{i}" for i in range(30))
    d = spark.createDataFrame([(1, t, 5, "k"), (2, "clean", 6, "l")], "doc_id long, text string, _id int, _KEY string")
    _, b = frames(spark, [], [(7, t)])
    kept = D.clean(spark, d, b)
    assert kept.columns == d.columns and [tuple(r) for r in kept.collect()] == [(2, "clean", 6, "l")]
