"""Language of texts and of spans inside mixed-language texts.

Words are runs of letters. A word's script (by Unicode ranges) leaves only the
languages whose training texts use that script. Each left language scores the
word by the log probabilities of its character n-grams; a Viterbi pass over the
words finds the labelling with the best sum of scores minus a penalty for each
change of language. Runs of equal labels are the spans; the language with most
letters is the text's.

The n-gram counts come from a sample of labelled texts, at most about
``per_language`` of each language, drawn by a hash of the id; counting runs in
the tasks and only the table of counts (buckets x languages) reaches the driver.

Defined results: null text or text without letters gives ``und`` and score 0; a
text that has letters only in scripts that no language was trained on gets the
language of the best n-gram scores, or the most frequent one where these say
nothing, and score 0; without labelled rows every text is ``und``; ties go to the
language first in alphabetical order; repeated rows are labelled each; extra columns
are ignored. Words are scored ``CELLS`` (characters x languages) at a time; the
labels of a batch of texts take words x languages cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import textnum
from cartpulse.llm.common import map_arrow

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16
SWITCH_PENALTY = 10.0
CELLS = 1 << 22  # characters x languages scored at a time
BATCH_CELLS = 48_000_000  # characters x languages labelled at a time
PER_LANGUAGE = 2000
SCRIPT_SHARE = 0.01

# Unicode ranges by script (fixed values); letters elsewhere form one more.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
]
SCRIPT_NAMES = list(dict.fromkeys(s for s, _, _ in SCRIPTS)) + ["other"]

_TABLES: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letter (0: not a letter) and script of each code below 2**16."""
    if not _TABLES:
        lower = np.zeros(1 << 16, np.uint32)
        script = np.full(1 << 16, len(SCRIPT_NAMES) - 1, np.uint8)
        for name, a, b in SCRIPTS:
            script[a:b + 1] = SCRIPT_NAMES.index(name)
        for c in range(1 << 16):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                lower[c] = ord(low) if len(low) == 1 else c
        _TABLES[:] = [lower, script]
    return _TABLES[0], _TABLES[1]


class Words:
    """Letter runs of texts, with the buckets of their n-grams."""

    def __init__(self, texts: list[str]) -> None:
        lower, script = _tables()
        # a boundary before the first text, too: its scores must not depend on its place
        points = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le"), np.uint32)
        small = np.minimum(points, 0xFFFF)
        # letters beyond the first plane keep their code and the script "other"
        beyond = points > 0xFFFF
        self.codes = lower[small]
        if beyond.any():
            far, at = np.unique(points[beyond], return_inverse=True)
            self.codes[beyond] = np.array([c if chr(c).isalpha() else 0 for c in far], np.uint32)[at]
        self.starts, self.ends = textnum.runs(self.codes != 0)
        self.script = np.where(beyond, len(SCRIPT_NAMES) - 1, script[small])[self.starts]
        self.offsets = 1 + np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def grams(self):
        return textnum.grams(self.codes, ORDERS, BUCKETS)


def _counter(langs: list[str]):
    at = {lang: i for i, lang in enumerate(langs)}
    per = BUCKETS + len(SCRIPT_NAMES)

    def run(batches):
        total = np.zeros((len(langs), per), np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            marks = [at[x] for x in batch.column("lang").to_pylist()]
            for lang in sorted(set(marks)):
                own = [t for t, m in zip(texts, marks) if m == lang]
                for a, b in textnum.chunks(own):
                    words = Words(own[a:b])
                    for bucket, ok in words.grams():
                        total[lang, :BUCKETS] += np.bincount(bucket[ok], minlength=BUCKETS)
                    total[lang, BUCKETS:] += np.bincount(
                        words.script, minlength=len(SCRIPT_NAMES))
        lang, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang.astype(np.int32)), pa.array(cell.astype(np.int32)),
             pa.array(total[lang, cell])], names=["lang", "cell", "n"])
    return run


class Model:
    """Log probabilities by bucket and language, and scripts each may use."""

    def __init__(self, langs: list[str], counts: np.ndarray) -> None:
        self.langs = langs
        grams, scripts = counts[:, :BUCKETS].T.astype(np.float64), counts[:, BUCKETS:].T
        p = (grams + 0.3) / (grams.sum(0) + 0.3 * BUCKETS)
        table = np.log(p / p.mean(1, keepdims=True)) if langs else grams
        # neighbouring n-grams repeat each other's evidence
        self.table = (table / len(ORDERS)).astype(np.float32)
        self.allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
        self.frequent = grams.sum(0)

    def plain_scores(self, words: Words) -> np.ndarray:
        """(words, languages): summed scores of the words' n-grams."""
        out = np.zeros((len(words.starts), len(self.langs)), np.float32)
        if not out.size:
            return out
        grams = list(words.grams())
        step = max(1, CELLS // len(self.langs))
        # a word's n-grams end at its letters or at the boundary after it
        ends = words.ends + 1
        a = 0
        while a < len(out):
            lo = words.starts[a]
            b = max(a + 1, int(np.searchsorted(ends, lo + step, side="right")))
            hi = ends[b - 1]
            per = np.zeros((hi - lo + 1, len(self.langs)), np.float32)
            for bucket, ok in grams:
                at = np.flatnonzero(ok[lo:hi])
                per[at] += self.table[bucket[lo:hi][at]]
            cuts = np.stack([words.starts[a:b], ends[a:b]], 1).ravel() - lo
            out[a:b] = np.add.reduceat(per, cuts, axis=0)[0::2]
            a = b
        return out

    def scores(self, words: Words) -> np.ndarray:
        """``plain_scores``, but far below 0 where the script excludes a language and
        0 for words whose script excludes all."""
        out = self.plain_scores(words)
        allowed = self.allowed[words.script]
        out[~allowed] = -1e4
        out[~allowed.any(1)] = 0
        return out

    def guess(self, text: str) -> int:
        """The label of a text in untrained scripts."""
        sums = self.plain_scores(Words([text])).sum(0, dtype=np.float64)
        best = np.flatnonzero(sums >= sums.max() - 1e-6)
        return int(best[self.frequent[best].argmax()])


def viterbi(scores: np.ndarray, bounds: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best label of every word; texts are ``bounds[i]:bounds[i + 1]``.

    All texts advance together, longest first, so each step is a few array
    operations over the texts that have a word at it.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = bounds[:-1][order], sizes[order]
    n_labels = scores.shape[1]
    kind = np.min_scalar_type(max(n_labels - 1, 0))
    own = np.arange(n_labels, dtype=kind)
    back = np.zeros(scores.shape, kind)
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    dp = np.zeros((len(first), n_labels), np.float32)
    for t in range(longest):
        m = active[t]
        row = first[:m] + t
        now = dp[:m]
        if t:
            floor = now.max(1, keepdims=True) - np.float32(penalty)
            stay = now >= floor
            back[row] = np.where(stay, own, now.argmax(1).astype(kind)[:, None])
            np.maximum(now, floor, out=now)
        now += scores[row]
    label = dp.argmax(1).astype(kind)
    path = np.zeros(len(scores), kind)
    for t in range(longest - 1, -1, -1):
        m = active[t]
        row = first[:m] + t
        path[row] = label[:m]
        if t:
            label[:m] = back[row, label[:m]]
    return path


def _labeller(model_cast):
    def run(batches):
        model = model_cast.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = batch.column("doc_id")
            for a, b in textnum.chunks(texts, BATCH_CELLS // max(1, len(model.langs))):
                parts = [(c + a, d + a) for c, d in textnum.chunks(texts[a:b])]
                bounds, scores, starts, ends, known = [0], [], [], [], []
                for c, d in parts:
                    words = Words(texts[c:d])
                    scores.append(model.scores(words))
                    known.append(model.allowed[words.script].any(1))
                    bounds.extend(bounds[-1] + words.bounds[1:])
                    shift = np.repeat(words.offsets[:-1], np.diff(words.bounds))
                    starts.append(words.starts - shift)
                    ends.append(words.ends - shift)
                bounds = np.array(bounds)
                starts, ends, known = (np.concatenate(x) for x in (starts, ends, known))
                path = (viterbi(np.concatenate(scores), bounds) if model.langs
                        else np.zeros(len(starts), np.uint8))
                letters = ends - starts
                pred, score, spans = [], [], []
                for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
                    weight = np.bincount(path[lo:hi], letters[lo:hi] * known[lo:hi],
                                         minlength=len(model.langs) or 1)
                    best = int(weight.argmax())
                    if not weight[best] and hi > lo and model.langs:
                        lang = model.langs[model.guess(texts[a + i])]
                        pred.append(lang)
                        score.append(0.0)
                        spans.append([{"lang": lang, "start": int(starts[lo]), "end": int(ends[hi - 1])}])
                        continue
                    if not weight[best]:
                        pred.append("und")
                        score.append(0.0)
                        spans.append([])
                        continue
                    pred.append(model.langs[best])
                    score.append(float(weight[best] / letters[lo:hi].sum()))
                    cut = np.flatnonzero(np.diff(path[lo:hi])) + 1
                    begin, end = np.append(0, cut), np.append(cut, hi - lo) - 1
                    spans.append([{"lang": model.langs[path[lo + x]], "start": int(starts[lo + x]),
                                   "end": int(ends[lo + y])} for x, y in zip(begin, end)])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                     pa.array(spans, pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()),
                                                         ("end", pa.int32())])))],
                    names=["doc_id", "lang_pred", "score", "spans"])
    return run


def train(docs: DataFrame, usable: Column, per_language: int = PER_LANGUAGE) -> Model:
    """Count n-grams of a sample of the rows where ``usable`` holds."""
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((0, BUCKETS + len(SCRIPT_NAMES))))
    chance = F.lit(0.0)
    for lang in langs:
        chance = F.when(F.col("lang") == lang, per_language / sizes[lang]).otherwise(chance)
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.where(draw < chance).select("lang", F.col("text").cast("string"))
    counted = (map_arrow(sample, _counter(langs), "lang int, cell int, n long")
               .groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros((len(langs), BUCKETS + len(SCRIPT_NAMES)))
    counts[counted["lang"].to_numpy(), counted["cell"].to_numpy()] = counted["n"].to_numpy()
    return Model(langs, counts)


def label_spans(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every text; ``score`` is the share of
    its letters in words labelled ``lang_pred``; spans have character offsets."""
    cast = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(rows, _labeller(cast), "doc_id long, lang_pred string, score double, "
                     "spans array<struct<lang: string, start: int, end: int>>")
