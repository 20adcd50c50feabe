import math
import random

import numpy as np
import pytest

from cartpulse.llm import hard_negatives as H


def brute(rows):
    kept = {}
    for vec_id, v, label in rows:
        if vec_id is None or v is None or label is None or any(
                x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        kept[vec_id, label, tuple(v)] = [math.floor(256 * x) for x in v]
    out = []
    for (a, la, _), x in kept.items():
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, lab, tuple(y)) for (i, lab, _), y in kept.items()
                        if i != a or lab != la)
        positives = [(i, -s) for s, i, lab, _ in scored if lab == la and i != a][:5]
        for pos, ps in positives:
            negatives = [(i, -s) for s, i, lab, _ in scored if lab != la and 30 * ps <= -100 * s <= 90 * ps][:10]
            out += [(a, pos, r + 1, n, ps, ns) for r, (n, ns) in enumerate(negatives)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<double>, "
                               "label int, key int, shard int, v int")
    got = H.hard_negatives(spark, df, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def made(seed, n=260, d=6):
    rng = random.Random(seed)
    rows = [(i * 3 if i % 2 else i * 10, [rng.gauss(0, 0.3) for _ in range(d)], rng.randrange(4))
            for i in range(n)]
    # a third share one vector: many ties
    return [(i, [0.25, -0.5, 0.0, 0.125, 0.5, -0.25], lab) if rng.random() < 0.33 else (i, v, lab)
            for i, v, lab in rows]


@pytest.mark.parametrize("options", [{}, {"shard": 40, "block": 2}])
def test_equals_brute_force(spark, options):
    rows = [r for i, r in enumerate(made(1)) if r[0] not in {x[0] for x in made(1)[:i]}]
    got = run(spark, rows, **options)
    assert len(got) > 500 and got == brute(rows)


def test_nulls_lengths_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (1, [1.0], 1), (2, [0.5, 0.5, 9.0], 1),
            (3, [0.4, 0.2], 2), (4, [0.4, 0.2], 2), (4, [0.4, 0.2], 2), (5, [], 2), (200, [], 2),
            (None, [1.0, 1.0], 1), (6, None, 1), (7, [1.0, 1.0], None), (8, [1.0, None], 2),
            (9, [nan, 1.0], 2), (10, [inf, 1.0], 2), (11, [0.5, 0.5], 2), (0, [1.0, 1.0], 9)]
    got = run(spark, rows)
    assert got and got == brute(rows)


def test_large_components_stay_exact(spark):
    big = 2.0 ** 22  # sums of 2 ** 57 that differ by one
    rows = [(100, [big, 1 / 256], 1), (1, [big / 4, 0.0], 1), (2, [big / 8, 1 / 256], 2),
            (3, [big / 8, 2 / 256], 2), (4, [big / 8, 0.0], 2)]
    got = run(spark, rows)
    assert [(r[3], r[5]) for r in got] == [(r[3], r[5]) for r in brute(rows)] and len(got) == 3


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, [1.0], 1)]) == []


def test_lists_stop_early_and_miss_nothing():
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.normal(0, 0.3, (4000, 3)))
    lists = H.Lists(x, np.arange(4000), np.zeros(4000, int))
    a = np.floor(256 * rng.normal(0, 0.5, 3))
    valid = rng.random(4000) < 0.7
    s = x @ a
    top = s.max()
    windows = [(-np.inf, np.inf), (30 * top, 90 * top), (99 * top, 100 * top)]
    for (lo, hi), got in zip(windows, lists.best(a, valid, windows, 10)):
        want = sorted((-s[i], i) for i in range(4000) if valid[i] and lo <= 100 * s[i] <= hi)[:10]
        assert [(-s[i], i) for i in got] == want
    assert (lists.scores != 0).mean() < 0.8  # not all rows were scored
