r"""Benchmark passages in training documents, by spaced seeds.

Texts become lower-case tokens ``[\p{L}\p{N}]+``. A spaced seed is a fixed mask
over consecutive token positions; the hash of the tokens at its set positions
ignores the others, so a passage with substituted words still shares seeds.

1. All seeds of the benchmark are hashed; their bits fill a table of 2 ** 15
   words of 64 bits, whose size is fixed and which is therefore broadcast. Items
   shorter than the shortest mask have one seed, all their tokens; texts get seeds
   of their lengths only if there are such items. Items of fewer than ``SHORT``
   tokens are no passage inside a text: they match texts that are nothing else.
2. Every seed of every document is looked up in it; the few that pass are joined
   with the benchmark seeds by hash.
3. A hit fixes an alignment (document, item, diagonal). Around it, the aligned
   tokens of the whole item are compared: equal tokens score 1, unequal ones
   ``MISMATCH``, and the best-scoring run counts. A pair is reported if its best
   run reaches ``MIN_SCORE`` (for items under 20 tokens, six tenths of the item,
   so that two substitutions in 15 tokens are accepted).

All steps are DataFrame expressions.

Defined results: null or empty texts and items match nothing; rows that repeat an id and a text share
one row for each item; equal items are reported each; a null id is kept as
null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.llm.common import saved, scratch, unused

# Set positions of the masks (1: compared, 0: ignored).
MASKS = ("11011001011", "110100110101", "1110010100111")
SHORT = 5
MIN_SCORE = 12
MISMATCH = -2
TABLE_BITS = 15  # words of 64 bits in the lookup table, as a power of two


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"),
                    lambda w: w != "")


def seeds(df: DataFrame, toks: str, exact: list[int], item: bool = False) -> DataFrame:
    """``df`` without ``toks`` but with one row for each seed: ``pos``, ``seed``.
    ``exact`` are lengths at which all tokens count; an item has such a seed only
    if it is as long."""
    df = df.withColumn("_h", F.transform(toks, lambda w: F.xxhash64(w))).drop(toks)

    def masked(m: int, mask: str) -> Column:
        at = [i for i, bit in enumerate(mask) if bit == "1"]
        return F.when(F.size("_h") >= len(mask), F.transform(
            F.sequence(F.lit(0), F.size("_h") - len(mask)),
            lambda p: F.struct(p.alias("pos"), F.xxhash64(
                F.lit(m), *[F.get(F.col("_h"), p + i) for i in at]).alias("seed"))))

    def whole(n: int) -> Column:
        found = masked(len(MASKS) + n, "1" * n)
        return F.when(F.size("_h") == n, found) if item else found

    every = F.array(*[masked(m, mask) for m, mask in enumerate(MASKS)], *map(whole, exact))
    rest = [c for c in df.columns if c != "_h"]
    return (df.select(*rest, F.explode(F.flatten(F.filter(every, lambda a: a.isNotNull()))).alias("_s"))
            .select(*rest, F.col("_s.pos").alias("pos"), F.col("_s.seed").alias("seed")))


def _word(seed: str = "seed") -> Column:
    return F.col(seed).bitwiseAND(F.lit((1 << TABLE_BITS) - 1))


def _bits(seed: str = "seed") -> Column:
    """Two bits of a table word, drawn from other parts of the hash."""
    def bit(shift):
        return F.expr(f"shiftleft(1L, cast(shiftrightunsigned({seed}, {shift}) & 63 as int))")
    return bit(20).bitwiseOR(bit(40))


def same_texts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_key, item, diagonal): texts that are nothing but a tiny item."""
    def tiny(df):
        return df.where(F.size("toks").between(1, SHORT - 1))

    keyed = tiny(items).select(F.col("item"), F.array_join("toks", " ").alias("all_tokens"))
    return (tiny(docs).select("doc_id", "text_key", F.array_join("toks", " ").alias("all_tokens"))
            .distinct().join(keyed, "all_tokens")
            .select("doc_id", "text_key", "item", F.lit(0).alias("diagonal")))


def hits(docs: DataFrame, bench_seeds: DataFrame, exact: list[int]) -> DataFrame:
    """(doc_id, text_key, item, diagonal): distinct seed alignments."""
    table = bench_seeds.groupBy(_word().alias("word")).agg(F.expr("bit_or(bits)").alias("bits"))
    # at most 2 ** TABLE_BITS rows of two longs, whatever the benchmark's size
    table = F.broadcast(table)
    found = (seeds(docs, "toks", exact).withColumn("word", _word()).join(table, "word")
             .where(F.col("bits").bitwiseAND(_bits()) == _bits())
             .select("doc_id", "text_key", "pos", "seed"))
    return (found.join(bench_seeds.select("seed", "item", F.col("pos").alias("item_pos")), "seed")
            .select("doc_id", "text_key", "item", (F.col("pos") - F.col("item_pos")).alias("diagonal"))
            .distinct())


def best_run(equal: Column) -> Column:
    """Best-scoring run of an array of booleans: struct(score, start, end)."""
    def step(acc, e):
        gain = F.when(e, F.lit(1)).otherwise(MISMATCH)
        fresh = acc["run"] <= 0
        run = F.when(fresh, gain).otherwise(acc["run"] + gain)
        start = F.when(fresh, acc["i"]).otherwise(acc["from"])
        better = run > acc["score"]
        return F.struct(
            (acc["i"] + 1).alias("i"), run.alias("run"), start.alias("from"),
            F.when(better, run).otherwise(acc["score"]).alias("score"),
            F.when(better, start).otherwise(acc["start"]).alias("start"),
            F.when(better, acc["i"] + 1).otherwise(acc["end"]).alias("end"))

    zero = F.struct(*[F.lit(0).alias(c) for c in ("i", "run", "from", "score", "start", "end")])
    return F.aggregate(equal, zero, step)


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item that share a passage: doc_id, text_key
    (hash of the text), item_id, score, matched_words, run_words, start_word,
    item_start."""
    with scratch(spark):
        items = saved(spark, benchmark.select(
            "item_id", tokens(F.col("text")).alias("toks"),
            F.monotonically_increasing_id().alias("item")), "decontamination-items")
        # a handful of lengths at most
        exact = sorted(r.n for r in items.select(F.size("toks").alias("n")).where(
            F.col("n").between(SHORT, min(map(len, MASKS)) - 1)).distinct().collect())
        bench_seeds = saved(spark, seeds(items.select("item", "toks"), "toks", exact, item=True)
                            .withColumn("bits", _bits()), "decontamination-seeds")
        rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"),
                           F.col("text").cast("string"))
        toks = rows.withColumn("toks", tokens(F.col("text"))).drop("text")
        found = saved(spark, hits(toks, bench_seeds, exact).unionByName(same_texts(toks, items)),
                      "decontamination-hits")

        sized = found.join(items.select("item", F.size("toks").alias("n_item")), "item")
        first = F.greatest(F.lit(0), -F.col("diagonal"))
        per_doc = (sized.withColumn("first", first)
                   .groupBy("doc_id", "text_key")
                   .agg(F.collect_list(F.struct("item", "diagonal", "first", "n_item")).alias("hits")))
        keyed = rows.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
        around = (keyed.join(per_doc, F.col("_id").eqNullSafe(F.col("doc_id"))
                             & F.col("_key").eqNullSafe(F.col("text_key")))
                  .withColumn("toks", tokens(F.col("text")))
                  .select("doc_id", "text_key", F.explode(F.transform("hits", lambda h: F.struct(
                      h["item"].alias("item"), h["diagonal"].alias("diagonal"), h["first"].alias("first"),
                      F.slice("toks", h["diagonal"] + h["first"] + 1, h["n_item"] - h["first"]).alias("part")
                  ))).alias("h"))
                  .select("doc_id", "text_key", "h.*").dropDuplicates(
                      ["doc_id", "text_key", "item", "diagonal"]))
        scored = (around.join(items, "item")
                  .withColumn("run", best_run(F.transform("part", lambda w, i: w.eqNullSafe(
                      F.get(F.col("toks"), F.col("first") + i)))))
                  .withColumn("n_item", F.size("toks")))
        # score = matches + MISMATCH * mismatches over the run
        length = F.col("run.end") - F.col("run.start")
        scored = scored.where(F.col("run.score") >= F.least(F.lit(MIN_SCORE), F.ceil(F.col("n_item") * 6 / 10)))
        best = F.max(F.struct(
            F.col("run.score").alias("score"), length.alias("run_words"),
            (-(F.col("diagonal") + F.col("first") + F.col("run.start"))).alias("neg_start"),
            (F.col("first") + F.col("run.start")).alias("item_start")))
        out = scored.groupBy("doc_id", "text_key", "item").agg(
            best.alias("b"), F.first("item_id").alias("item_id"))
        return saved(spark, out.select(
            "doc_id", "text_key", "item_id", F.col("b.score").alias("score"),
            ((F.col("b.score") - MISMATCH * F.col("b.run_words")) / (1 - MISMATCH)).cast("int")
            .alias("matched_words"),
            F.col("b.run_words").alias("run_words"), (-F.col("b.neg_start")).alias("start_word"),
            F.col("b.item_start").alias("item_start")), "decontamination-found", keep=True)


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that share a passage with the benchmark."""
    id_, key = (unused(c, docs.columns) for c in ("_id", "_key"))
    found = contaminated(spark, docs, benchmark).select(
        F.col("doc_id").alias(id_), F.col("text_key").alias(key)).distinct()
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found[id_])
                     & F.xxhash64(docs["text"]).eqNullSafe(found[key]), "left_anti")
