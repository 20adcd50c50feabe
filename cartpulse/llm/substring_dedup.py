r"""Repeated passages by content-defined chunking.

A gear rolling hash runs over a text's word hashes: each step shifts the hash
and adds the next word's value, so its low bits depend on the last few words
only. A chunk boundary is set where the hash is a strict minimum among its
neighbours within ``reach`` words on either side. Boundaries depend only on
nearby words, so an insertion moves the boundaries around it and no others, and
equal passages are cut alike wherever they lie.

Each chunk is keyed by the digest of itself and its right neighbour (of itself
alone at a text's end), so that short chunks of common words do not match by
chance. A digest has 128 bits, as chunks are equal if their digests are. The first place of a digest in (doc_id, position) order is kept;
chunks of later places are duplicates. Touching duplicates of one text are
joined to spans, reported with the document that holds the first place.

Digests are counted with a map-side aggregate and only those seen twice or more
are joined back; a passage that a third of all texts share is counted in pieces
and its places are joined against one row.

Defined results: null, empty or white-space texts have no chunks; texts shorter
than ``min_span`` words have no spans; of equal texts one is kept, also if rows repeat an id (the later row's
spans name its own id); null ids come last; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartpulse.llm import textnum
from cartpulse.llm.common import map_arrow, saved, scratch, unused

REACH = 3
GEAR_WORDS = 4
MIN_WORDS = 8
# Gear values: word hash times this odd constant, scrambled.
_GEAR = np.uint64(0xC2B2AE3D27D4EB4F)
_SALTS = (0, 0x9AE16A3B2F90404F)


def boundaries(words: np.ndarray, bounds: np.ndarray, reach: int = REACH,
               gear_words: int = GEAR_WORDS) -> np.ndarray:
    """Positions at which a chunk begins, for all texts' words in one array.

    ``bounds`` has the texts' first words; each text begins a chunk. The gear
    hash h = 2 h + gear(word), taken modulo 2 ** gear_words, is the sum of the
    last ``gear_words`` shifted values; it is scrambled to order positions.
    """
    n = len(words)
    gear = textnum.mix(words * _GEAR) >> np.uint64(16)
    h = np.zeros(n, np.uint64)
    for j in range(min(gear_words, n)):
        h[j:] += gear[:n - j] << np.uint64(j)
    h = textnum.mix(h)
    text_of = np.zeros(n, np.int64)
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    text_of[first] = 1
    text_of = np.cumsum(text_of)
    low = np.ones(n, bool)
    # the hash at a position must depend on this text's words only
    low[:gear_words - 1] = False
    low[gear_words - 1:] &= text_of[gear_words - 1:] == text_of[:n - gear_words + 1]
    for d in range(1, min(reach, n - 1) + 1):
        same = text_of[d:] == text_of[:-d]
        low[d:] &= ~same | (h[d:] < h[:-d])
        low[:-d] &= ~same | (h[:-d] < h[d:])
    low[first] = True
    return np.flatnonzero(low)


def _chunker(batches):
    for batch in batches:
        raw = [(t or "").encode() for t in batch.column("text").to_pylist()]
        ids = batch.column("doc_id")
        rows_ids = batch.column("row_id").to_numpy()
        for a, b in textnum.chunks(raw):
            words, bounds = textnum.word_hashes(raw[a:b])
            if not len(words):
                continue
            cut = boundaries(words, bounds)
            ends = np.append(cut[1:], len(words))
            # order-dependent digests of the words of each chunk
            place = (np.arange(len(words), dtype=np.int64) - np.repeat(cut, ends - cut)).astype(np.uint64)
            text = np.searchsorted(bounds, cut, side="right") - 1
            follows = np.append(text[1:] == text[:-1], False)
            digests = [_digest(words, place, cut, ends, follows, salt) for salt in _SALTS]
            span = np.where(follows, np.append(ends[1:], 0), ends) - cut
            keep = span >= MIN_WORDS
            start = (cut - bounds[text])[keep]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(text[keep] + a)), pa.array(rows_ids[text[keep] + a]),
                 pa.array(start.astype(np.int32)), pa.array(span[keep].astype(np.int32)),
                 *[pa.array(d[keep].view(np.int64)) for d in digests]],
                names=["doc_id", "row_id", "start_word", "n_words", "digest", "digest2"])


def _digest(words: np.ndarray, place: np.ndarray, cut: np.ndarray, ends: np.ndarray,
            follows: np.ndarray, salt: int) -> np.ndarray:
    """64 bits for every chunk and its right neighbour; each salt another function."""
    salt = np.uint64(salt)
    mixed = textnum.mix((words ^ salt) + textnum.mix(place + salt))
    one = textnum.mix(np.add.reduceat(mixed, cut) + (ends - cut).astype(np.uint64))
    return textnum.mix(one * np.uint64(3) + np.where(
        follows, np.append(one[1:], np.uint64(0)), np.uint64(0x7F4A7C15)))


def chunk_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, row_id, start_word, n_words, digest, digest2) of every chunk."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                       F.monotonically_increasing_id().alias("row_id"))
    return map_arrow(rows, _chunker, "doc_id long, row_id long, start_word int, n_words int, "
                                     "digest long, digest2 long")


def duplicate_spans(spark: SparkSession, docs: DataFrame, min_span: int = 16) -> DataFrame:
    """One row for each duplicated span of ``min_span`` words or more: doc_id,
    start_word, n_words, first_doc_id. Shorter ones are stock phrases, as
    licence lines, and count only as part of a longer span.

    Words ``start_word`` (from 0) to ``start_word + n_words - 1`` of doc_id occur
    earlier, chunk by chunk; ``first_doc_id`` holds the first place of the
    span's first chunk.
    """
    with scratch(spark):
        # written, so that the ids drawn for rows are the same in both uses
        chunks = saved(spark, chunk_digests(docs), "substring-chunks")
        order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row_id", "start_word")
        firsts = (chunks.groupBy("digest", "digest2").agg(F.count("*").alias("places"), F.min(order).alias("first"))
                  .where("places > 1").select("digest", "digest2", "first"))
        met = chunks.join(firsts, ["digest", "digest2"])
        later = met.where((F.col("first.row_id") != F.col("row_id"))
                          | (F.col("first.start_word") != F.col("start_word")))
        text = Window.partitionBy("row_id").orderBy("start_word")
        reached = F.max(F.col("start_word") + F.col("n_words")).over(
            text.rowsBetween(Window.unboundedPreceding, -1))
        spans = (later.withColumn("_new", F.coalesce(F.col("start_word") > reached, F.lit(True)))
                 .withColumn("_span", F.sum(F.col("_new").cast("int")).over(text)))
        return saved(spark, spans.groupBy("row_id", "_span").agg(
            F.first("doc_id").alias("doc_id"), F.min("start_word").alias("start_word"),
            F.max(F.col("start_word") + F.col("n_words")).alias("_end"),
            F.min(F.struct("start_word", "first.doc_id")).getField("doc_id").alias("first_doc_id"))
            .select("doc_id", "start_word", (F.col("_end") - F.col("start_word")).alias("n_words"),
                    "first_doc_id").where(F.col("n_words") >= min_span),
            "substring-spans", keep=True)


def without_duplicates(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` (unique doc_id) with the words of duplicated spans removed; a
    text without spans stays as it is."""
    id_, held = (unused(c, docs.columns) for c in ("_id", "_cuts"))

    def strip(batches):
        import re
        word = re.compile(r"[^\x20\x09-\x0D]+")
        for batch in batches:
            out = []
            for text, cuts in zip(batch.column("text").to_pylist(), batch.column(held).to_pylist()):
                if text and cuts:
                    at = [m.span() for m in word.finditer(text)]
                    for c in sorted(cuts, key=lambda c: -c["start_word"]):
                        last = c["start_word"] + c["n_words"]
                        end = at[last][0] if last < len(at) else len(text)
                        text = text[:at[c["start_word"]][0]] + text[end:]
                out.append(text)
            yield batch.set_column(batch.schema.get_field_index("text"), "text",
                                   pa.array(out, pa.string())).drop_columns([held])

    cuts = (spans.groupBy(F.col("doc_id").alias(id_))
            .agg(F.collect_list(F.struct("start_word", "n_words")).alias(held)))
    joined = docs.join(cuts, docs["doc_id"] == cuts[id_], "left").drop(cuts[id_])
    return map_arrow(joined, strip, docs.schema)
