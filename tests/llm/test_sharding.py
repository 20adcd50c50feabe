import zlib

import numpy as np
import pytest

from cartpulse.llm import sharding


def test_matrix_sums():
    sizes = [13, 0, 250, 7, 1]
    m = np.array(sharding.communication_matrix(sizes, 4, seed=1))
    assert m.sum(1).tolist() == sizes
    assert sorted(m.sum(0)) == [67, 68, 68, 68]


def test_hypergeometric_moments():
    rng = np.random.default_rng(2)
    good, bad, draws = 300, 700, 100
    x = np.array([sharding.hypergeometric(rng, good, bad, draws) for _ in range(4000)])
    n = good + bad
    assert abs(x.mean() - 30) < 0.3
    assert abs(x.var() - 100 * .3 * .7 * (n - draws) / (n - 1)) < 1.5
    # totals beyond 10**9 are drawn, too
    y = sharding.hypergeometric(rng, 10 ** 11, 3 * 10 ** 11, 10 ** 6)
    assert abs(y - 250_000) < 5000


def rows(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string, shard string, slot string")


def test_exact_sizes_nulls_and_repeats(spark):
    data = [(i, f"text {i}", "x", "y") for i in range(100)]
    data += [(None, None, "x", None), (None, "", None, None), (3, "text 3", "x", "y")]
    data += [(7, "same", "x", "y")] * 20
    out = sharding.shard_documents(spark, rows(spark, data), 8).collect()
    assert len(out) == len(data)
    sizes = [sorted(r.slot for r in out if r.shard == s) for s in range(8)]
    assert {len(s) for s in sizes} <= {15, 16}
    assert all(s == list(range(len(s))) for s in sizes)
    got = sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in out)
    want = sorted((i is None, i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
                  for i, t, _, _ in data)
    assert [g[2:] for g in got] == [w[2:] for w in want]
    assert {r.law for r in out} == {"rows"} and {r.grown_shard for r in out} == {None}


def test_empty_and_fewer_rows_than_shards(spark):
    assert sharding.shard_documents(spark, rows(spark, []), 8).count() == 0
    out = sharding.shard_documents(spark, rows(spark, [(1, "a", "", ""), (2, "b", "", "")]), 8).collect()
    assert [r.slot for r in out] == [0, 0] and out[0].shard != out[1].shard


@pytest.mark.parametrize("rows_per_task", [5, 1000])
def test_slices_keep_slots_gapless(spark, rows_per_task):
    df = spark.range(300).withColumnRenamed("id", "k")
    out = sharding.shuffle_into_shards(spark, df, ["k"], 4, rows_per_task=rows_per_task).collect()
    for s in range(4):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(75))


def test_equal_rows_lie_like_any_others(spark):
    """200 equal rows among 3,200: as many neighbours, and as even over places, as a
    uniform shuffle gives."""
    data = [(i, f"text {i}", "x", "y") for i in range(3000)] + [(7_000, "same", "x", "y")] * 200
    out = sharding.shard_documents(spark, rows(spark, data), 8).collect()
    at = sorted((r.shard, r.slot) for r in out if r.doc_id == 7_000)
    assert len(at) == len(set(at)) == 200
    neighbours = sum(a[0] == b[0] and b[1] - a[1] == 1 for a, b in zip(at, at[1:]))
    assert neighbours <= 30  # 12 expected, deviation 3.5
    shards = np.bincount([s for s, _ in at], minlength=8)
    places = np.bincount([slot // 40 for _, slot in at], minlength=10)
    assert ((shards - 25) ** 2 / 25).sum() < 30 and ((places - 20) ** 2 / 20).sum() < 34
