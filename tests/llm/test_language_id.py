import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from cartpulse.llm import language_id as L

SYL = {"aa": ["ba", "bo", "bi"], "cc": ["ku", "ke", "ko"], "ru": ["жа", "шо", "ли"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYL[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def docs(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, lang, 30), lang) for i, lang in enumerate(list(SYL) * 20)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rng


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(3)
    for _ in range(50):
        sizes = rng.integers(0, 5, 4)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        s = rng.normal(size=(bounds[-1], 3)).astype(np.float32) * 2
        got = L.viterbi(s, bounds, 1.5)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            def value(path):
                return sum(s[lo + i, p] for i, p in enumerate(path)) - 1.5 * sum(
                    a != b for a, b in zip(path, path[1:]))
            best = max(value(p) for p in itertools.product(range(3), repeat=int(hi - lo)))
            assert abs(value(got[lo:hi]) - best) < 1e-4


def test_languages_spans_and_edges(spark):
    train, rng = docs(spark)
    model = L.train(train, F.lit(True))
    mixed = text(rng, "aa", 20) + " " + text(rng, "cc", 12)
    rows = [(1, text(rng, "aa", 9), None), (2, text(rng, "cc", 9), "aa"), (3, text(rng, "ru", 9), "x"),
            (4, mixed, ""), (5, None, None), (6, "", None), (7, "12 !? 34", None), (8, "漢字", None),
            (None, text(rng, "aa", 9), None), (9, text(rng, "cc", 20_000), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(9))
    got = {r.doc_id: r for r in L.label_spans(df, model).collect()}
    assert {k: r.lang_pred for k, r in got.items()} == {
        1: "aa", 2: "cc", 3: "ru", 4: "aa", 5: "und", 6: "und", 7: "und", 8: "aa", None: "aa", 9: "cc"}
    assert [(s.lang, mixed[s.start:s.end].split()[0][0]) for s in got[4].spans] == [("aa", "b"), ("cc", "k")]
    assert got[1].score == 1.0 and got[7].score == 0.0 and 0.5 < got[4].score < 1


def test_without_training_rows(spark):
    train, _ = docs(spark)
    model = L.train(train, F.lit(False))
    assert {r.lang_pred for r in L.label_spans(train, model).collect()} == {"und"}
    assert L.label_spans(train.where("false"), model).count() == 0


def test_held_out_accuracy(spark):
    from cartpulse.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op2_language_id"](spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    ok = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert out.count() == 1000 and ok > 0.97


def test_untrained_scripts_get_a_learned_language(spark):
    """The contract: ``und`` only for null texts and texts without letters."""
    train, rng = docs(spark)
    model = L.train(train, F.lit(True))
    rows = [(1, "漢字 かな"), (2, "\U0001F600 \U0001F680"), (3, "\U00010428\U00010429 12"), (4, "Ωμέγα ψ " * 3000)]
    got = {r.doc_id: r for r in L.label_spans(
        spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert {k: r.lang_pred in SYL for k, r in got.items()} == {1: True, 2: False, 3: True, 4: True}
    assert got[2].lang_pred == "und" and all(r.score == 0 for r in got.values())
    # emoji are no letters: they lower no score
    plain = text(rng, "cc", 20)
    rows = [(1, plain), (2, plain.replace(" ", " \U0001F600 "))]
    got = L.label_spans(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("cc", 1.0)] * 2


def test_many_labels():
    scores = np.zeros((4, 300), np.float32)
    scores[:, 280] = 1
    assert L.viterbi(scores, np.array([0, 1, 4])).tolist() == [280] * 4


def test_scores_do_not_depend_on_blocks(monkeypatch):
    rng = random.Random(4)
    counts = np.random.default_rng(1).integers(0, 9, (5, L.BUCKETS + len(L.SCRIPT_NAMES)))
    model = L.Model(list("abcde"), counts)
    words = L.Words([text(rng, lang, n) for lang in SYL for n in (1, 0, 50)])
    want = model.plain_scores(words)
    monkeypatch.setattr(L, "CELLS", 40)
    assert np.allclose(model.plain_scores(words), want, atol=1e-4) and np.abs(want).max() > 0.01


def test_repeated_rows(spark):
    train, rng = docs(spark)
    model = L.train(train, F.lit(True))
    one = train.limit(1)
    assert L.label_spans(one.unionAll(one), model).distinct().count() == 1
