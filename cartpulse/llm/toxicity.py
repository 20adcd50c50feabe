"""Toxicity of texts by averaged subword embeddings and a linear softmax.

A word is the mean of the embeddings of its character n-grams, so an unseen
misspelling shares vectors with the words it resembles. A window of words is
the mean of its words, and a linear softmax gives its two classes' logits.
A text is toxic if any window is. Embeddings and softmax are trained jointly in
numpy on the noisy or of a text's windows; the score of a text is that of its
most toxic window, as a noisy or grows with the mere number of windows.

Training reads a bounded sample of whole texts: at most about ``per_class``
labelled texts of each class and at most about ``max_chars`` characters of them
together, drawn by a hash of the id whatever their length. A quarter of it is
held back to place the decision threshold at score 0.7. The sample is fitted in a
task, so the driver sees no texts, only the model: one number for each n-gram
bucket, a table of fixed size that all scoring tasks get.

Defined results: null texts and texts without letters have no windows and get
the score of a window without evidence; without labelled rows of both classes
every score is 0; rows that repeat are scored each; contradicting labels of one
document are not used; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartpulse.llm import textnum
from cartpulse.llm.common import map_arrow, slices
from cartpulse.llm.language_id import Words

ORDERS = (3, 4, 5, 6)
BUCKETS = 1 << 18
DIM = 8
WINDOW = STRIDE = 8
PER_CLASS = 2000
MAX_CHARS = 5_000_000  # of all drawn texts of a class together
THRESHOLD = 0.7
EPOCHS = 40
MIN_TEXTS = 20  # an n-gram in fewer training texts is not trained; less for small samples
RATE = 2.0
START = -5.0  # logit of a window before training


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the word windows of texts ``bounds[i]:bounds[i + 1]``."""
    sizes = np.diff(bounds)
    count = np.where(sizes > 0, np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = bounds[text] + nth * STRIDE
    return start, np.minimum(start + WINDOW, bounds[text + 1]), text


class Corpus:
    """Training texts as word ids, with the n-gram buckets of each distinct word."""

    def __init__(self, texts: list[str]) -> None:
        seen = np.empty(0, np.uint64)
        counts = np.zeros(BUCKETS, np.int32)
        hashes, bounds, ids, sizes, order = [], [0], [], [], []
        for a, b in textnum.chunks(texts, 1 << 18):
            words = Words(texts[a:b])
            h = textnum.range_hashes(words.codes, words.starts, words.ends)
            hashes.append(h)
            bounds.extend(bounds[-1] + words.bounds[1:])
            uniq, first = np.unique(h, return_index=True)
            new = ~np.isin(uniq, seen)
            uniq, first = uniq[new], first[new]
            seen = np.concatenate([seen, uniq])
            span = words.ends[first] + 1 - words.starts[first]
            at = np.repeat(words.starts[first] - (np.cumsum(span) - span), span) + np.arange(span.sum())
            word = np.repeat(np.arange(len(first)), span)
            parts, owner = [], []
            text_of = np.searchsorted(words.offsets, np.arange(len(words.codes)), side="right") - 1
            for bucket, ok in textnum.grams(words.codes, ORDERS, BUCKETS):
                met = np.unique(text_of[ok] * BUCKETS + bucket[ok]) % BUCKETS
                counts += np.bincount(met, minlength=BUCKETS).astype(np.int32)
                keep = ok[at]
                parts.append(bucket[at][keep])
                owner.append(word[keep])
            owner = np.concatenate(owner) if owner else np.empty(0, np.int64)
            by = np.argsort(owner, kind="stable")
            ids.append(np.concatenate(parts)[by].astype(np.int32))
            sizes.append(np.bincount(owner, minlength=len(first)))
            order.append(uniq)
        self.bounds = np.array(bounds)
        vocab = np.concatenate(order)
        rank = np.argsort(vocab)
        vocab, rank = vocab[rank], rank.astype(np.int32)
        self.tokens = np.concatenate([rank[np.searchsorted(vocab, h)] for h in hashes])
        self.ids = np.concatenate(ids)
        self.sizes = np.concatenate(sizes)
        self.text_counts = counts
        self.firsts = np.concatenate([[0], np.cumsum(self.sizes)])


def _word_means(table: np.ndarray, corpus: Corpus, block: int = 4_000) -> np.ndarray:
    out = np.zeros((len(corpus.sizes), table.shape[1]), np.float32)
    for a in range(0, len(out), block):
        b = min(a + block, len(out))
        lo, hi = corpus.firsts[a], corpus.firsts[b]
        sums = np.cumsum(table[corpus.ids[lo:hi]], axis=0, dtype=np.float64)
        sums = np.vstack([np.zeros((1, table.shape[1])), sums])
        f = corpus.firsts[a:b + 1] - lo
        out[a:b] = (sums[f[1:]] - sums[f[:-1]]) / np.maximum(corpus.sizes[a:b], 1)[:, None]
    return out


def _by_bucket(value: np.ndarray, corpus: Corpus, block: int = 4_000) -> np.ndarray:
    """Sum over each bucket's words of ``value``, added up in the words' order; the
    n-grams of a block of words at a time."""
    out = np.zeros(BUCKETS)
    for a in range(0, len(corpus.sizes), block):
        b = min(a + block, len(corpus.sizes))
        ids = corpus.ids[corpus.firsts[a]:corpus.firsts[b]].astype(np.intp)
        np.add.at(out, ids, np.repeat(value[a:b], corpus.sizes[a:b]))
    return out


def _window_means(words: np.ndarray, tokens: np.ndarray, start: np.ndarray, end: np.ndarray,
                  block: int = 8_000) -> np.ndarray:
    """Mean of each window's words; the tokens of a block of windows at a time."""
    out = np.zeros((len(start), words.shape[1]), np.float32)
    for a in range(0, len(start), block):
        b = min(a + block, len(start))
        lo, hi = start[a], end[b - 1]
        sums = np.zeros((hi - lo + 1, words.shape[1]))
        np.cumsum(words[tokens[lo:hi]], axis=0, dtype=np.float64, out=sums[1:])
        out[a:b] = (sums[end[a:b] - lo] - sums[start[a:b] - lo]) / (end[a:b] - start[a:b])[:, None]
    return out


class Descent:
    """Gradient descent with momentum; the largest entry moves by ``rate``. One
    scale for the whole array lets n-grams with steady evidence outrun noise."""

    def __init__(self, value: np.ndarray, rate: float) -> None:
        self.value, self.rate = value, rate
        self.m = np.zeros_like(value)

    def step(self, grad: np.ndarray) -> None:
        self.m = 0.8 * self.m + 0.2 * grad
        self.value -= self.rate * self.m / max(float(np.abs(self.m).max()), 1e-12)


def pooled(z: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Noisy or: log(1 - p) of each text, from the logits of its windows."""
    return -np.bincount(text, np.logaddexp(0, z), minlength=n_texts)


def fit(corpus: Corpus, toxic: np.ndarray, epochs: int, rate: float = RATE,
        seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embeddings, softmax weights, softmax bias) by full-batch descent."""
    rng = np.random.default_rng(seed)
    # zero embeddings: an n-gram not met in training is no evidence
    table = Descent(np.zeros((BUCKETS, DIM), np.float32), rate)
    weights = Descent((rng.standard_normal((DIM, 2))).astype(np.float32), 0.02)
    bias = Descent(np.array([-START / 2, START / 2], np.float32), 0.02)
    at_least = max(3, min(MIN_TEXTS, len(toxic) // 150))
    common = (corpus.text_counts >= at_least)[:, None]
    start, end, text = windows(corpus.bounds)
    share = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1))
    length = end - start
    # chance alone moves a gradient by about the root of an n-gram's count
    often = np.bincount(corpus.tokens, minlength=len(corpus.sizes))
    often = _by_bucket(often.astype(np.float64), corpus)[:, None]
    trust = (common / np.sqrt(np.maximum(often, 1))).astype(np.float32)
    for _ in range(epochs):
        words = _word_means(table.value, corpus)
        mean = _window_means(words, corpus.tokens, start, end)
        to_toxic = weights.value[:, 1] - weights.value[:, 0]
        z = np.clip(mean @ to_toxic + (bias.value[1] - bias.value[0]), -30, 30)
        clean = np.minimum(pooled(z, text, len(toxic)), -1e-6)
        # loss: -log(1 - p) of clean texts, -log(p) of toxic ones; d/dz by window
        odds = np.where(toxic, -np.exp(clean) / -np.expm1(clean), 1.0)
        gz = (share * odds)[text] / (1 + np.exp(-z))
        # through the softmax, the windows, the words, the n-grams
        gw = mean.T @ gz
        each = gz / length
        edge = np.bincount(start, each, minlength=len(corpus.tokens) + 1)
        edge -= np.bincount(end, each, minlength=len(corpus.tokens) + 1)
        np.cumsum(edge, out=edge)
        word = np.bincount(corpus.tokens, edge[:-1], minlength=len(corpus.sizes))
        word /= np.maximum(corpus.sizes, 1)
        evidence = _by_bucket(word, corpus)
        grad = np.empty((BUCKETS, DIM), np.float32)
        for d in range(DIM):
            # every column is the same evidence, times the softmax's weight
            grad[:, d] = evidence * to_toxic[d]
        table.step(grad * trust)
        weights.step(np.stack([-gw, gw], 1).astype(np.float32))
        bias.step(np.array([-gz.sum(), gz.sum()], np.float32))
    return table.value, weights.value, bias.value


class Model:
    """One number for each bucket, and the calibration of logits to scores."""

    def __init__(self, buckets: np.ndarray, bias: float) -> None:
        self.buckets, self.bias = buckets.astype(np.float32), bias
        self.cut, self.scale, self.trained = 0.0, 1.0, True

    def logits(self, texts: list[str]) -> np.ndarray:
        """Logit of every text: that of its most toxic window."""
        out = np.full(len(texts), self.bias)
        for a, b in textnum.chunks(texts, 1 << 18):
            words = Words(texts[a:b])
            if not len(words.starts):
                continue
            value = np.zeros(len(words.codes) + 1, np.float64)
            count = np.zeros(len(words.codes) + 1, np.float64)
            for bucket, ok in textnum.grams(words.codes, ORDERS, BUCKETS):
                value[:-1] += np.where(ok, self.buckets[bucket], 0)
                count[:-1] += ok
            cuts = np.stack([words.starts, words.ends + 1], 1).ravel()
            word = (np.add.reduceat(value, cuts)[0::2]
                    / np.maximum(np.add.reduceat(count, cuts)[0::2], 1))
            start, end, text = windows(words.bounds)
            sums = np.concatenate([[0.0], np.cumsum(word)])
            z = (sums[end] - sums[start]) / (end - start) + self.bias
            first = np.flatnonzero(np.diff(text, prepend=-1))
            out[a + text[first]] = np.maximum.reduceat(z, first)
        return out

    def calibrate(self, z: np.ndarray, toxic: np.ndarray) -> None:
        """Put the score 0.7 where the true positive rate most outweighs the false
        positive rate, which counts five times; halfway between two logits."""
        order = np.argsort(z, kind="stable")
        z, toxic = z[order], toxic[order]
        gain = np.append(np.cumsum(np.where(toxic, 1 / max(toxic.sum(), 1),
                                            -5 / max((~toxic).sum(), 1))[::-1])[::-1], 0.0)
        best = int(gain.argmax())
        low, high = z[max(best - 1, 0)], z[min(best, len(z) - 1)]
        self.cut = float(low + high) / 2
        self.scale = max(float(np.median(z[toxic]) - np.median(z[~toxic])) / 8, 1e-3)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(texts))
        x = (self.logits(texts) - self.cut) / self.scale + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def untrained() -> Model:
    model = Model(np.zeros(BUCKETS), 0.0)
    model.trained = False
    return model


MODEL = "buckets binary, bias double, cut double, scale double, trained boolean"


def _fitter(batches):
    """The model of a sample (doc_id, text, toxic, back), as one row."""
    batches = list(batches)
    model = untrained()
    if batches:
        rows = pa.Table.from_batches(batches).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        batches.clear()
        texts, toxic = rows["text"].to_pylist(), rows["toxic"].to_numpy() == 1
        back = np.array(rows["back"].to_pylist(), bool)
        del rows
        model = train_texts(texts, toxic, back)
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.buckets.tobytes()], pa.binary()), pa.array([model.bias], pa.float64()),
         pa.array([model.cut], pa.float64()), pa.array([model.scale], pa.float64()),
         pa.array([model.trained], pa.bool_())],
        names=["buckets", "bias", "cut", "scale", "trained"])


def fitted(sample: DataFrame) -> Model:
    """Train on a bounded sample (doc_id, text, toxic, back) in one task; only the
    model comes to the driver."""
    row = map_arrow(sample.repartition(1), _fitter, MODEL).first()
    if row is None:  # no partition at all
        return untrained()
    model = Model(np.frombuffer(row.buckets, np.float32), row.bias)
    model.cut, model.scale, model.trained = row.cut, row.scale, row.trained
    return model


def train_texts(texts: list[str], toxic: np.ndarray, back: np.ndarray) -> Model:
    """Train on the rows where ``back`` is false and calibrate on the others."""
    if not toxic[~back].any() or toxic[~back].all():
        return untrained()
    use = back if toxic[back].any() and not toxic[back].all() else ~back
    return _train([t for t, b in zip(texts, back) if not b], toxic[~back],
                  [t for t, u in zip(texts, use) if u], toxic[use])


def _train(seen: list[str], toxic: np.ndarray, held: list[str], held_toxic: np.ndarray) -> Model:
    corpus = Corpus(seen)
    seen.clear()  # the corpus has what is needed of them
    if not len(corpus.ids):
        return untrained()
    table, weights, bias = fit(corpus, toxic, EPOCHS)
    del corpus
    model = Model(table @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0]))
    model.calibrate(model.logits(held), held_toxic)
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = PER_CLASS,
          max_chars: int = MAX_CHARS) -> Model:
    """Train on labelled rows of ``docs`` where ``usable`` holds."""
    marks = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("toxic").alias("_low"), F.max("toxic").alias("toxic"))
             .where("_low = toxic").select(F.col("doc_id").alias("_id"), "toxic"))
    chars = F.length("text").cast("long")
    rows = docs.where(usable & (chars <= 2 * max_chars))  # one text alone beyond the bound
    # lengths alone are joined with all labels, texts only with the drawn ids
    sized = (rows.select("doc_id", chars.alias("chars"))
             .join(marks, F.col("doc_id") == F.col("_id")))
    sizes = {r.toxic: r for r in sized.groupBy("toxic").agg(
        F.count("*").alias("n"), F.sum("chars").alias("chars")).collect()}
    if len(sizes) < 2:
        return untrained()

    def draw(step):
        return F.pmod(F.xxhash64(F.lit(step), "doc_id"), F.lit(1 << 20)) / float(1 << 20)

    def chance(of):
        return min(per_class / of.n, max_chars / max(of.chars, 1))

    # the running sum only cuts a draw of twice the expected characters
    order = Window.partitionBy("toxic").orderBy(draw("sample"), "doc_id", "text").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    drawn = (sized.where(draw("sample") < F.when(F.col("toxic") == 1, chance(sizes[1]))
                         .otherwise(chance(sizes[0])))
             .select("_id", "toxic").distinct())
    # at most about per_class ids of each class, whatever the input's size
    sample = (rows.select("doc_id", "text")
              .join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))
              .withColumn("_chars", F.sum(chars).over(order)).where(F.col("_chars") <= 2 * max_chars)
              .select("doc_id", "text", "toxic", (draw("back") < 0.25).alias("back")))
    return fitted(sample)


def _scorer(model_cast):
    def run(batches):
        for batch in slices(batches):
            scores = model_cast.value.scores([t or "" for t in batch.column("text").to_pylist()])
            i = batch.schema.get_field_index("text")
            rest = [c for c in range(batch.num_columns) if c != i]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest] + [pa.array(scores, pa.float64())],
                names=[batch.schema.names[c] for c in rest] + ["score"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text_key, score) of every text; ``text_key`` is its hash."""
    cast = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"),
                       F.col("text").cast("string"))
    return map_arrow(rows, _scorer(cast), "doc_id long, text_key long, score double")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the texts that score ``THRESHOLD`` or more."""
    cast = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches):
            texts = pa.compute.cast(batch.column("text"), pa.string()).to_pylist()
            scores = cast.value.scores([t or "" for t in texts])
            yield batch.filter(pa.array(scores < THRESHOLD, pa.bool_()))

    return map_arrow(docs, run, docs.schema)
