import re

from pyspark.sql import functions as F

from cartpulse.llm import quality_rules as Q

TEXTS = [
    None, "", "  \n\t ", "one", "a b c d e a b c d e", "a a a a a a a", "x y\nx y\n\nx y\nz",
    "a b c d e f a b c d e f g a b c d e", "# $ %& <|> **", "é è ü\nÀ B", "A1 B2!! c3",
    "a b c d e " * 40, "w " * 5, "p q r s t u",
]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {i + j for v in at.values() if len(v) > 1 for i in v for j in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def test_statistics_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r for r in Q.statistics(df).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t), t


def labelled_docs(spark, n=400):
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [f"w{(i * 7 + j * j) % 5000}" + ("***" if bad and j % 2 else "") for j in range(40)]
        docs.append((i, " ".join(words), "n_words"))
        labels.append((i, 0 if bad else 1))
    return (spark.createDataFrame(docs, "doc_id long, text string, kept string"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_learned_list_separates(spark):
    docs, labels = labelled_docs(spark)
    out = {r.doc_id: r.kept for r in Q.filter_documents(spark, docs, labels).collect()}
    assert len(out) == 400
    assert all(out[i] == (i % 4 != 0) for i in range(400))


def test_without_labels_only_the_base_rules(spark):
    docs, labels = labelled_docs(spark, 20)
    none = labels.where("false")
    extra = docs.union(spark.createDataFrame([(None, None, ""), (99, "too short", "")], docs.schema))
    out = Q.filter_documents(spark, extra, none).collect()
    assert len(out) == 22
    assert [r.kept for r in out if r.n_words < 10] == [False, False]
    assert all(r.kept for r in out if r.n_words >= 10)
    # contradicting and null labels are not used
    odd = labels.union(labels.withColumn("quality", 1 - F.col("quality")))
    assert sum(r.kept for r in Q.filter_documents(spark, docs, odd).collect()) == 20
    assert Q.filter_documents(spark, docs.where("false"), labels).count() == 0


def test_emitted_list_is_ordered():
    rule = [Q.Condition("n_words", True, 5.0), Q.Condition("digits_share", False, 0.5)]
    assert len(rule) == 2 and Q.best_condition([], {"n_words": [1.0]}) is None
