"""Packing documents into sequences by a linear grouping scheme.

Documents are tokenised, cut into pieces of at most ``capacity`` tokens, and
placed into as few sequences as the scheme finds:

1. Large lengths are sorted and split into groups of equal cardinality; every
   length is rounded up to the largest of its group.
2. Over these few sizes, configurations (how many pieces of each size fill a
   sequence) are generated: each takes the sizes still most in demand first,
   weighted by size, and is used as often as the demand allows.
3. The actual pieces replace the rounded sizes, which frees space.
4. Small pieces go best-fit, largest first, into the fullest sequence that
   still has room, then into new ones.

Lengths are integers up to ``capacity``, so all decisions are made on the table
of piece counts by length, whose size does not grow with the corpus. Several
splits into large and small and several group counts are planned, and the one
with the fewest sequences is carried out: pieces are numbered within their
length in salted runs, and each finds its sequence by its number.

Defined results: null text is an empty document and gives one piece holding
only the end token; equal documents, rows that repeat an id and null ids are packed
like any other row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartpulse.llm.common import map_arrow, saved

CAPACITY = 4096
END_TOKEN = 1
CACHE_WORDS = 800_000
SPLITS = (256, 512, 1024, 2048)  # lengths above are large
GROUPS = (16, 32, 64)

_STATE: dict = {}


class Encoder:
    """Text to the bytes of its ids.

    Ids of a text are those of its words, which white space always separates, so
    both white-space-delimited runs and the words inside them are encoded once
    and remembered (up to ``CACHE_WORDS`` each). New words are encoded together,
    as one spaced text, whose word numbers tell the ids apart. A text with
    characters outside Latin (where libraries may differ in their Unicode tables
    or the normal form matters) or with special tokens is encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.other = re.compile(r"[^\t-\r\x20-\x7e\xa0-\u012f]|<\|")
        # the pattern's classes, written out for the Latin letters let through
        letter, digit = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u012f", "0-9\xb2\xb3\xb9\xbc-\xbe"
        self.word = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{digit}]|[^\\s{letter}{digit}]+")
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def learn(self, words: list[str]) -> None:
        for a in range(0, len(words), 2000):
            part = words[a:a + 2000]
            encoding = self.tok.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(encoding.ids, np.uint32).tobytes()
            cut = np.flatnonzero(np.diff(np.array(encoding.word_ids, np.int64))) + 1
            ends = [0, *(cut * 4).tolist(), len(ids)]
            if len(ends) - 1 == len(part):
                self.words.update(zip(part, (ids[x:y] for x, y in zip(ends, ends[1:]))))
            else:
                self.words.update((w, self.whole(w)) for w in part)

    def encode(self, text: str) -> bytes:
        if self.other.search(text):
            return self.whole(text)
        runs = text.lower().split()
        new = set(runs).difference(self.runs)
        if new:
            if len(self.runs) + len(new) > CACHE_WORDS:
                self.runs.clear()
                new = set(runs)
            split = {r: self.word.findall(r) for r in new}
            found = {w for ws in split.values() for w in ws}
            if len(self.words) + len(found) > CACHE_WORDS:
                self.words.clear()
            self.learn(list(found.difference(self.words)))
            for r, ws in split.items():
                self.runs[r] = b"".join(map(self.words.__getitem__, ws))
        return b"".join(map(self.runs.__getitem__, runs))


def _encoder(path: str):
    if path not in _STATE:
        _STATE[path] = Encoder(path).encode
    return _STATE[path]


def _pieces(path: str, capacity: int):
    def run(batches):
        encode = _encoder(path)
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                data = encode(text or "") + END_TOKEN.to_bytes(4, "little")
                n = len(data) // 4
                for p, a in enumerate(range(0, n, capacity)):
                    part = data[4 * a:4 * (a + capacity)]
                    rows.append(i)
                    piece.append(p)
                    start.append(a)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [pc.take(batch.column("doc_id"), pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(rows, _pieces(tokenizer, capacity),
                     "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- planning on counts by length ---------------------------------------------

def _grouped(large: list[tuple[int, int]], n_groups: int) -> list[tuple[int, int]]:
    """(rounded size, count) of groups of equal cardinality, largest first.
    ``large`` has (length, count), largest first; a length can span groups."""
    total = sum(c for _, c in large)
    size = -(-total // n_groups)
    groups: list[tuple[int, int]] = []
    free = 0
    for length, count in large:
        while count:
            if not free:
                groups.append((length, 0))
                free = size
            n = min(free, count)
            groups[-1] = (groups[-1][0], groups[-1][1] + n)
            free -= n
            count -= n
    return groups


def _configurations(groups: list[tuple[int, int]], capacity: int) -> list[tuple[list[int], int]]:
    """[(pieces of each group, times used)] that cover all groups.

    Each configuration starts with the largest size left and is completed by
    the fill that wastes least (a bounded knapsack over the rounded sizes),
    preferring larger sizes; it is used until one of its groups runs short.
    """
    sizes = [s for s, _ in groups]
    left = [c for _, c in groups]
    out = []
    while any(left):
        first = next(g for g, c in enumerate(left) if c)
        room = capacity - sizes[first]
        # reach[r]: group last added to fill exactly r; larger sizes come first
        reach: dict[int, tuple[int, int]] = {0: (-1, 0)}
        for g in range(first, len(sizes)):
            have = left[g] - (g == first)
            if have <= 0 or sizes[g] > room:
                continue
            for r in sorted(reach):
                for k in range(1, min(have, (room - r) // sizes[g]) + 1):
                    if r + k * sizes[g] in reach:
                        break
                    reach[r + k * sizes[g]] = (g, k)
        config = [0] * len(sizes)
        config[first] = 1
        r = max(reach)
        while r:
            g, k = reach[r]
            config[g] += k
            r -= k * sizes[g]
        times = min(left[g] // n for g, n in enumerate(config) if n)
        for g, n in enumerate(config):
            left[g] -= n * times
        out.append((config, times))
    return out


class Bins:
    """Runs of sequences with equal free space: space -> [(first, count)]."""

    def __init__(self) -> None:
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.spaces: list[int] = []

    def add(self, space: int, first: int, count: int) -> None:
        if space not in self.runs:
            self.runs[space] = []
            insort(self.spaces, space)
        self.runs[space].append((first, count))

    def take(self, length: int, most: int) -> tuple[int, int, int] | None:
        """(space, first, count) of up to ``most`` of the fullest that fit."""
        i = bisect_left(self.spaces, length)
        if i == len(self.spaces):
            return None
        space = self.spaces[i]
        first, count = self.runs[space].pop()
        n = min(count, most)
        if count > n:
            self.runs[space].append((first + n, count - n))
        if not self.runs[space]:
            del self.runs[space]
            self.spaces.pop(i)
        return space, first, n


def plan(counts: dict[int, int], capacity: int, split: int, n_groups: int,
         ) -> tuple[int, list[tuple[int, int, int, int, int, int]]]:
    """(sequences, placements). A placement (length, from, count, sequence, step,
    offset): pieces from .. from + count - 1 of that length lie at ``offset`` in
    sequences sequence, sequence + step, ..."""
    placed: list[tuple[int, int, int, int, int, int]] = []
    used = dict.fromkeys(counts, 0)
    bins = Bins()
    n_seq = 0

    large = [(n, counts[n]) for n in sorted(counts, reverse=True) if n > split]
    if large:
        groups = _grouped(large, n_groups)
        # the actual lengths of each group, largest first
        stock: list[list[list[int]]] = []
        queue = [list(x) for x in large]
        for _, c in groups:
            own = []
            while c:
                n = min(c, queue[0][1])
                own.append([queue[0][0], n])
                queue[0][1] -= n
                c -= n
                if not queue[0][1]:
                    queue.pop(0)
            stock.append(own)
        for config, times in _configurations(groups, capacity):
            slots = [g for g, n in enumerate(config) for _ in range(n)]
            # sequences with the same free space so far, split as pieces differ
            runs = [(n_seq, times, 0)]
            for g in slots:
                after = []
                for first, count, filled in runs:
                    while count:
                        length, have = stock[g][0]
                        n = min(count, have)
                        placed.append((length, used[length], n, first, 1, filled))
                        used[length] += n
                        after.append((first, n, filled + length))
                        first, count = first + n, count - n
                        stock[g][0][1] -= n
                        if not stock[g][0][1]:
                            stock[g].pop(0)
                runs = after
            for first, count, filled in runs:
                if filled < capacity:
                    bins.add(capacity - filled, first, count)
            n_seq += times

    for length in sorted((n for n in counts if n <= split), reverse=True):
        left = counts[length]
        while left:
            got = bins.take(length, left)
            if got is None:
                # new sequences, each filled with as many pieces as fit
                per = capacity // length
                n = -(-left // per)
                bins.add(capacity, n_seq, n)
                n_seq += n
                continue
            space, first, n = got
            placed.append((length, used[length], n, first, 1, capacity - space))
            used[length] += n
            left -= n
            if space > length:
                bins.add(space - length, first, n)
    return n_seq, placed


def best_plan(counts: dict[int, int], capacity: int = CAPACITY):
    plans = [plan(counts, capacity, s, g) for s in SPLITS if s < capacity for g in GROUPS]
    return min(plans, key=lambda p: (p[0], len(p[1])))


# --- carrying the plan out ------------------------------------------------------

def _place(placed: dict[int, tuple[np.ndarray, ...]]):
    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            seq = np.zeros(len(length), np.int64)
            offset = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                first, sequence, step, at = placed[int(n)]
                k = np.searchsorted(first, number[rows], side="right") - 1
                seq[rows] = sequence[k] + (number[rows] - first[k]) * step[k]
                offset[rows] = at[k]
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(seq), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def numbered(rows: DataFrame, run_rows: int = 1_000_000) -> DataFrame:
    """``rows`` plus ``number``: gapless from 0 within each length. A length's
    rows are counted in salted runs, so a common length is no single task."""
    n_salts = max(16, -(-rows.count() // run_rows))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"),
                                             F.lit(n_salts)).cast("int"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = (salted.groupBy("length", "_salt").count()
            .withColumn("_base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    return (salted.withColumn("_r", F.row_number().over(own) - 1).join(base, ["length", "_salt"])
            .withColumn("number", F.col("_base") + F.col("_r")).drop("_salt", "_r", "_base"))


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    rows = saved(spark, pieces(docs, tokenizer, capacity), "packing-pieces")
    counts = {int(n): int(c) for n, c in rows.groupBy("length").count().collect()}
    _, placements = best_plan(counts, capacity)
    by_length: dict[int, list[tuple]] = {}
    for length, first, _, *rest in placements:
        by_length.setdefault(length, []).append((first, *rest))
    placed = {n: tuple(np.array(c, np.int64) for c in zip(*sorted(x))) for n, x in by_length.items()}
    return map_arrow(numbered(rows), _place(placed),
                     "doc_id long, piece int, start long, length long, ids_crc32 long, "
                     "sequence_id long, offset long")
