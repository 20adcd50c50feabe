import random

import numpy as np
from pyspark.sql import functions as F

from cartpulse.llm import toxicity as T

VOCAB = [a + b + c for a in "bdfg" for b in "aeiou" for c in ("n", "rt", "ss")]


def sample(n, seed, bad="grumbol"):
    rng = random.Random(seed)
    texts, toxic = [], []
    for i in range(n):
        words = [rng.choice(VOCAB) for _ in range(rng.randrange(8, 60))]
        t = i % 3 == 0
        if t:
            for _ in range(2):
                words[rng.randrange(len(words))] = bad + rng.choice(["", "s", "ix", "er"])
        texts.append(" ".join(words))
        toxic.append(t)
    return texts, np.array(toxic)


def test_learns_words_and_misspellings():
    texts, toxic = sample(300, 1)
    model = T.train_texts(texts, toxic, np.arange(300) % 4 == 0)
    other, marks = sample(120, 2, bad="grumboll")  # not met in training
    s = model.scores(other)
    assert s[marks].min() > s[~marks].max()
    assert ((s >= T.THRESHOLD) == marks).mean() > 0.97
    assert model.scores(["", "12 34"]).max() < T.THRESHOLD


def test_windows_cover_all_words():
    bounds = np.array([0, 0, 3, 20, 28])
    start, end, text = T.windows(bounds)
    for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        covered = set()
        for s, e in zip(start[text == i], end[text == i]):
            covered |= set(range(s, e))
        assert covered == set(range(lo, hi))


def frames(spark):
    texts, toxic = sample(300, 1)
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)] + [
        (1000, None, 0.1), (1001, "", None), (None, texts[0], 0.2), (1002, texts[0] * 300, 0.3)],
        "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)] + [
        (1000, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    return docs, labels, toxic


def test_operator_and_stage(spark):
    docs, labels, toxic = frames(spark)
    model = T.train(docs, labels, F.lit(True))
    rows = T.score(docs, model).collect()
    assert len(rows) == 304 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score >= T.THRESHOLD for r in rows}
    assert np.mean([by[i] == toxic[i] for i in range(300)]) > 0.97
    assert not by[1000] and not by[1001] and by[1002]
    kept = T.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, bad in by.items() if not bad}


def test_without_labels(spark):
    docs, labels, _ = frames(spark)
    model = T.train(docs, labels.where("toxic = 0"), F.lit(True))
    assert {r.score for r in T.score(docs, model).collect()} == {0.0}
    assert T.without_toxic(docs, model).count() == 304
    assert T.score(docs.where("false"), model).count() == 0


def test_length_alone_is_no_evidence():
    texts, toxic = sample(300, 1)
    model = T.train_texts(texts, toxic, np.arange(300) % 4 == 0)
    rng = random.Random(3)
    long = [" ".join(rng.choice(VOCAB) for _ in range(n)) for n in (1000, 4000, 20000, 60000)]
    assert model.scores(long).max() < T.THRESHOLD
    assert model.scores([t + " grumbolix grumbols" for t in long]).min() >= T.THRESHOLD
    one = model.logits(texts[:1])
    assert np.isclose(model.logits([" ".join([texts[0] + " ." * 8] * 50)]), one, atol=2).all()


def test_long_texts_are_drawn(spark):
    texts, toxic = sample(120, 6)
    docs = spark.createDataFrame([(i, t + " " + " ".join(VOCAB * 30)) for i, t in enumerate(texts)],
                                 "doc_id long, text string")
    assert docs.where("length(text) <= 6000").count() == 0
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    assert T.train(docs, labels, F.lit(True)).trained
    few = T.train(docs, labels, F.lit(True), max_chars=60_000)  # about eight texts of a class
    assert few.trained


def brute_logit(model, text):
    """The score's logit by loops: n-grams of a word, means of words and of windows."""
    from cartpulse.llm.language_id import Words
    codes = [int(c) for c in Words([text]).codes]
    m64 = (1 << 64) - 1

    def bucket(gram):
        h = len(gram)
        for c in reversed(gram):
            h = ((h ^ c) * 0x100000001B3) & m64
        for _ in range(2):
            h = ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93) & m64
        return ((h ^ (h >> 32)) >> 20) % T.BUCKETS

    words, start = [], None
    for i, c in enumerate(codes):
        if c and start is None:
            start = i
        if not c and start is not None:
            values = []
            for n in T.ORDERS:
                for last in range(start, i + 1):
                    gram = codes[max(0, last - n + 1):last + 1]
                    if len(gram) == n and all(gram[1:-1]):
                        values.append(float(model.buckets[bucket(gram)]))
            words.append(sum(values) / max(len(values), 1))
            start = None
    means = [sum(words[k:k + T.WINDOW]) / len(words[k:k + T.WINDOW]) for k in range(0, len(words), T.STRIDE)]
    return max(means) + model.bias if means else model.bias


def test_scores_equal_brute_force():
    rng = np.random.default_rng(8)
    model = T.Model(rng.normal(size=T.BUCKETS), -1.5)
    texts = ["", "a", "one", "Éa bb, ccc! dddd-eeeee", "x1y2", " ".join(f"word{chr(97 + i % 26) * (i % 9)}" for i in range(45)),
             "12 34", "one " * 17]
    got = model.logits(texts)
    assert np.allclose(got, [brute_logit(model, t) for t in texts], atol=1e-4)
    assert np.allclose(model.logits(texts + texts)[len(texts):], got, atol=1e-9)  # repeated rows


def test_sample_is_fitted_in_a_task(spark, monkeypatch):
    """The driver neither reads the drawn texts nor fits them; the model is the same."""
    docs, labels, toxic = frames(spark)
    docs = docs.where("doc_id < 300")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    back = np.array([r.back for r in docs.orderBy("doc_id").select((F.pmod(F.xxhash64(
        F.lit("back"), "doc_id"), F.lit(1 << 20)) / float(1 << 20) < 0.25).alias("back")).collect()])
    here = T.train_texts(list(texts), toxic, back)

    def driver(*_):
        raise AssertionError("in the driver")

    monkeypatch.setattr(T, "train_texts", driver)
    monkeypatch.setattr(type(docs), "toArrow", driver)
    model = T.train(docs, labels, F.lit(True))
    assert model.trained and np.array_equal(model.buckets, here.buckets)
    assert (model.bias, model.cut, model.scale) == (here.bias, here.cut, here.scale)


def test_buckets_are_summed_in_blocks():
    """As one sum over all n-grams, to the last bit."""
    corpus = T.Corpus(sample(300, 1)[0])
    value = np.random.default_rng(0).standard_normal(len(corpus.sizes))
    whole = np.bincount(corpus.ids, np.repeat(value, corpus.sizes), minlength=T.BUCKETS)
    for block in (1, 7, 4_000):
        assert np.array_equal(T._by_bucket(value, corpus, block), whole)
