import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartpulse.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", "word", "It's WE'LL don't !!'s", "naïve Ÿ ĳ ŉ Straße ½ ²3", "İstanbul ı", "a\x85b a\xa0b",
         "日本語 text", "é combining", "<|endoftext|> in text", "\x1c control \x00 x", "ﬁ ligature",
         "long " * 9000, "same", "same"]


def ids(tok, text):
    return np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], np.uint32)


def check(rows, docs, capacity):
    tok = Tokenizer.from_file(PATH)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {i for i, _ in docs}
    for i, text in docs:
        want = ids(tok, text)
        got = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(-(-len(want) // capacity)))
        for r in got:
            part = want[r.piece * capacity:(r.piece + 1) * capacity]
            assert (r.start, r.length, r.ids_crc32) == (
                r.piece * capacity, len(part), zlib.crc32(part.tobytes()))
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_seq)


@pytest.mark.parametrize("capacity", [4096, 512])
def test_pieces_and_places(spark, capacity):
    docs = list(enumerate(TEXTS))
    df = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, piece string")
    check(packing.pack(spark, df, PATH, capacity).collect(), docs, capacity)


def test_empty_table_and_repeats(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(spark, df, PATH).count() == 0
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b")], "doc_id long, text string")
    rows = packing.pack(spark, df, PATH).collect()
    assert sorted(r.offset for r in rows) == [0, 3, 6] and len({r.sequence_id for r in rows}) == 1


def test_plan_places_everything_near_the_bound():
    rng = np.random.default_rng(3)
    for sizes in (rng.integers(1, 4097, 5000), rng.integers(1400, 2100, 3000),
                  np.minimum(4096, rng.lognormal(6, 1, 5000) + 1).astype(int), np.full(100, 3000)):
        counts = {int(n): int(c) for n, c in zip(*np.unique(sizes, return_counts=True))}
        n_seq, placed = packing.best_plan(counts)
        got, fill = dict.fromkeys(counts, 0), {}
        for length, first, count, seq, step, offset in sorted(placed):
            assert first == got[length]
            got[length] += count
            for k in range(count):
                fill.setdefault(seq + k * step, []).append((offset, length))
        assert got == counts and len(fill) == n_seq
        for parts in fill.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 4096
        if (sizes <= 2048).mean() > 0.3 and sizes.max() > 2100:
            assert n_seq <= 1.02 * sizes.sum() / 4096 + 1
