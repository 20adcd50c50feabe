"""Registered queries of the training-data operators, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.llm import oracles
from cartpulse.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("op7_sharding")
def op7_sharding(spark, sf_dir):
    """Every document's shard (of 40) and slot: a uniform shuffle."""
    from cartpulse.llm.sharding import shard_documents
    return shard_documents(spark, read(spark, sf_dir, "documents"))


@register("op8_quality_rules")
def op8_quality_rules(spark, sf_dir):
    """Every document's statistics, base rules and learned verdict."""
    from cartpulse.llm.quality_rules import filter_documents
    return filter_documents(spark, read(spark, sf_dir, "documents"),
                            read(spark, sf_dir, "labels"))


@register("op3_minhash_near_dedup", oracles.NEAR_DUPLICATES)
def op3_minhash_near_dedup(spark, sf_dir):
    """Every document's near-duplicate component: 2-word shingles, 0.8 or more."""
    from cartpulse.llm.minhash_dedup import near_duplicates
    return near_duplicates(spark, read(spark, sf_dir, "documents"), shingle=2).drop("text_key")


@register("op6_best_fit_packing")
def op6_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of at most 4096 tokens."""
    import public_tokenizers
    from cartpulse.llm.packing import pack
    return pack(spark, read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op9_substring_dedup")
def op9_substring_dedup(spark, sf_dir):
    """Every span of a document that repeats an earlier place."""
    from cartpulse.llm.substring_dedup import duplicate_spans
    return duplicate_spans(spark, read(spark, sf_dir, "documents"))


@register("op10_benchmark_decontamination", oracles.DECONTAMINATION)
def op10_benchmark_decontamination(spark, sf_dir):
    """Every document and benchmark item that share a passage."""
    from cartpulse.llm.decontamination import contaminated
    return contaminated(spark, read(spark, sf_dir, "documents"),
                        read(spark, sf_dir, "benchmark")).drop("text_key")


@register("op2_language_id")
def op2_language_id(spark, sf_dir):
    """Every document's predicted language."""
    from cartpulse.llm.common import fold
    from cartpulse.llm.language_id import label_spans, train
    docs = read(spark, sf_dir, "documents")
    model = train(docs, fold(F.col("doc_id"), 4) != 2)
    return label_spans(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score",
        F.size("spans").alias("n_spans"))


@register("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    """Every document's toxicity score and decision."""
    from cartpulse.llm import toxicity
    from cartpulse.llm.common import fold
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), fold(F.col("doc_id"), 3) != 1)
    return toxicity.score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@register("op4_secret_scans")
def op4_secret_scans(spark, sf_dir):
    """Every finding that the forest keeps; the secret itself is not repeated."""
    from cartpulse.llm.secret_scan import scan
    return scan(spark, read(spark, sf_dir, "documents")).select(
        "doc_id", "word_index", "kind", F.length("core").alias("length"),
        F.crc32("core").alias("core_crc32"), "score")


@register("op1_token_counts")
def op1_token_counts(spark, sf_dir):
    """Every document's token count, and the count after its redactions."""
    import public_tokenizers
    from cartpulse.llm.token_counts import count_edited
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return count_edited(read(spark, sf_dir, "documents"), vocabulary).select(
        "doc_id", "n_tokens", "n_edits", "n_tokens_after", "encoded_pieces", "updated_nodes",
        F.size("leaf_tokens").alias("n_leaves"))


@register("op11_simhash_near_dedup")
def op11_simhash_near_dedup(spark, sf_dir):
    """Every document's fingerprint and component: 4 differing bits or fewer."""
    from cartpulse.llm.simhash_dedup import near_duplicates
    return near_duplicates(spark, read(spark, sf_dir, "documents"))


@register("op12_prefix_trie", oracles.PREFIX_TRIE)
def op12_prefix_trie(spark, sf_dir):
    """Every node of the trie of rebuilt conversations, with its subtree's sums."""
    from cartpulse.llm.prefix_trie import prefix_trie
    return prefix_trie(spark, read(spark, sf_dir, "conversations"))


@register("op13_hard_negatives", oracles.HARD_NEGATIVES)
def op13_hard_negatives(spark, sf_dir):
    """Ten hard negatives for each of five positives of every anchor."""
    from cartpulse.llm.hard_negatives import hard_negatives
    return hard_negatives(spark, read(spark, sf_dir, "embeddings"))
