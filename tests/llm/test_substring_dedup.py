import random

import numpy as np

from cartpulse.llm import substring_dedup as S
from cartpulse.llm import textnum

VOCAB = [f"w{i}" for i in range(500)]


def some(rng, n):
    return [rng.choice(VOCAB) for _ in range(n)]


def spans(spark, docs):
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, n_words int")
    return df, S.duplicate_spans(spark, df)


def test_planted_passages(spark):
    rng = random.Random(6)
    docs, planted = [], set()
    for k in range(60):
        passage = some(rng, rng.choice([51, 60, 120]))
        for j in range(2):
            docs.append((2 * k + j, " ".join(some(rng, rng.randrange(90)) + passage + some(rng, rng.randrange(90)))))
        planted.add((2 * k + 1, 2 * k))
    docs += [(1000 + k, " ".join(some(rng, 200))) for k in range(60)]
    _, out = spans(spark, docs)
    rows = out.collect()
    assert {(r.doc_id, r.first_doc_id) for r in rows} == planted
    words = {i: t.split() for i, t in docs}
    for r in rows:
        part = " ".join(words[r.doc_id][r.start_word:r.start_word + r.n_words])
        assert part in " ".join(words[r.first_doc_id])


def test_boundaries_move_with_the_text():
    rng = random.Random(7)
    text = some(rng, 400)
    def cuts(words):
        w, b = textnum.word_hashes([" ".join(words).encode()])
        return set(S.boundaries(w, b).tolist())
    a = cuts(text)
    b = cuts(["new"] * 5 + text)
    moved = {x + 5 for x in a if x >= 10}
    assert moved == {x for x in b if x >= 15}


def test_repeats_nulls_and_removal(spark):
    rng = random.Random(8)
    text = " ".join(some(rng, 80))
    docs = [(1, text), (2, text), (None, text), (3, None), (4, ""), (5, " \n"), (6, "short"), (7, "short")]
    df, out = spans(spark, docs)
    rows = out.collect()
    assert {(r.doc_id, r.first_doc_id, r.start_word, r.n_words) for r in rows} == {
        (2, 1, 0, 80), (None, 1, 0, 80)}
    kept = {r.doc_id: r.text for r in S.without_duplicates(df, out).collect() if r.doc_id is not None}
    assert kept[1] == text and kept[2] == "" and kept[6] == "short" and kept[3] is None
    df, out = spans(spark, [])
    assert out.count() == 0


def test_copy_inside_one_text(spark):
    rng = random.Random(9)
    passage = some(rng, 70)
    docs = [(1, " ".join(passage + some(rng, 50) + passage))]
    _, out = spans(spark, docs)
    r, = out.collect()
    assert (r.doc_id, r.first_doc_id) == (1, 1) and r.start_word >= 120 and r.n_words >= 50


def test_many_copies_grow_linearly(spark):
    rng = random.Random(10)
    passage = some(rng, 60)
    docs = [(i, " ".join(some(rng, 40) + passage)) for i in range(50)]
    _, out = spans(spark, docs)
    assert sorted(r.doc_id for r in out.collect()) == list(range(1, 50))
    firsts = [r.first_doc_id for r in out.collect()]
    # a chunk at the edge may match another copy by chance first
    assert np.mean([f == 0 for f in firsts]) > 0.8


def test_spans_equal_a_plain_dictionary(spark):
    """Chunks compared as tuples of words, not by digests; one text is very long."""
    import random

    import numpy as np

    from cartpulse.llm import substring_dedup as S
    from cartpulse.llm import textnum
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(3000)]
    passages = [[rng.choice(vocab) for _ in range(rng.choice([12, 40, 90]))] for _ in range(8)]
    texts = []
    for i in range(60):
        words = []
        for _ in range(rng.choice([0, 1, 4]) if i else 400):
            words += [rng.choice(vocab) for _ in range(rng.randrange(30))] + rng.choice(passages)
        texts.append((i, " ".join(words)))
    texts.append((60, texts[5][1]))
    chunks, seen, dup = [], {}, {}
    for i, text in texts:
        words, bounds = textnum.word_hashes([text.encode()])
        if not len(words):
            continue
        cut = S.boundaries(words, np.array([0, len(words)])).tolist() + [len(words)]
        plain = text.split()
        for k, start in enumerate(cut[:-1]):
            end = cut[min(k + 2, len(cut) - 1)]
            if end - start >= S.MIN_WORDS:
                key = (tuple(plain[start:cut[k + 1]]), tuple(plain[cut[k + 1]:end]))
                first = seen.setdefault(key, (i, start))
                if first != (i, start):
                    dup.setdefault(i, []).append((start, end, first[0]))
    want = []
    for i, spans in dup.items():
        joined = []
        for start, end, first in sorted(spans):
            if joined and start <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], end)
            else:
                joined.append([start, end, first])
        want += [(i, a, b - a, f) for a, b, f in joined if b - a >= 16]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], "doc_id long, text string, digest int, _id string")
    got = [tuple(r) for r in S.duplicate_spans(spark, df).collect()]
    assert len(want) > 40 and sorted(got) == sorted(want)
    kept = S.without_duplicates(df, spark.createDataFrame(got, "doc_id long, start_word int, n_words int, "
                                                          "first_doc_id long"))
    assert kept.columns == df.columns and kept.count() == len(texts)
