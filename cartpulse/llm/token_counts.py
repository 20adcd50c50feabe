r"""Token counts that follow edits.

A text is split into pre-tokens, and tokens never cross them. Runs of ``LEAF``
consecutive pre-tokens are the leaves of a segment tree that holds characters
and tokens of every subtree. An edit touches the leaves it overlaps and the
boundary before it: scanning restarts at the last leaf boundary two characters
or more before the edit (a pre-token's end depends on at most two characters
after it) and stops at the first old leaf boundary after the edit, where the
rest of the text is scanned as before. Only the pre-tokens in between are
encoded; the replaced leaves' sums change, and with them their ancestors'.

Trees and edits are rows of tables: ``build_trees`` counts whole texts,
``recount`` applies a document's edits to its tree. Both are narrow: a
document is worked on where it lies.

Defined results: null text has no tokens and an empty tree; edits are
(start, end, replacement) in characters of the old text, in any order; edits
that overlap an earlier one, or lie outside the text, or have a null bound are
ignored, a null replacement deletes; repeated rows are counted each; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.common import map_arrow

LEAF = 32
CACHE_BYTES = 16 << 20  # of remembered pre-tokens, with an entry's own ENTRY bytes
ENTRY = 150
CACHED = 32  # characters; longer pre-tokens are not remembered
PIECES = 1 << 18  # pre-tokens of a text that are held at once

# The vocabulary's own pre-token pattern (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

TREE = "n_tokens long, leaf_chars array<int>, leaf_tokens array<int>"
EDIT = "struct<start: int, end: int, replacement: string>"

_STATE: dict = {}


class Counter:
    """Pre-tokens of a text and the tokens of each, remembered by pre-token."""

    def __init__(self, path: str) -> None:
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}
        self.bytes = 0

    def tokens(self, pieces: list[str]) -> list[int]:
        known = self.known
        new = set(pieces).difference(known)
        if not new:
            return list(map(known.__getitem__, pieces))
        encode = self.encoding.encode_ordinary
        fresh = {p: len(encode(p)) for p in new}
        out = [fresh[p] if p in fresh else known[p] for p in pieces]
        short = {p: n for p, n in fresh.items() if len(p) <= CACHED}
        size = sum(map(len, short)) + ENTRY * len(short)
        if self.bytes + size > CACHE_BYTES:
            known.clear()
            self.bytes = 0
        if size <= CACHE_BYTES:
            known.update(short)
            self.bytes += size
        return out

    def blocks(self, text: str, size: int) -> Iterator[list[str]]:
        """The pre-tokens, about ``size`` at a time; of short texts all at once."""
        if len(text) <= size:
            if text:
                yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while block := list(islice(found, size)):
            yield block

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)


def counter(path: str) -> Counter:
    if path not in _STATE:
        _STATE[path] = Counter(path)
    return _STATE[path]


def leaves(pieces: list[str], tokens: list[int], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of each run of ``size`` pre-tokens."""
    if not pieces:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    at = np.arange(0, len(pieces), size)
    chars = np.add.reduceat(np.fromiter(map(len, pieces), np.int32, len(pieces)), at)
    return chars, np.add.reduceat(np.array(tokens, np.int32), at)


def leaves_of(text: str, count: Counter, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of each leaf of a whole text. A block of pre-tokens holds
    whole leaves, so the leaves do not depend on the blocks."""
    parts = [leaves(block, count.tokens(block), size)
             for block in count.blocks(text, max(1, PIECES // size) * size)]
    if not parts:
        return leaves([], [], size)
    return tuple(np.concatenate(column) for column in zip(*parts))


class Tree:
    """Segment tree over leaves, as one array: node i has children 2i and 2i + 1."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.build(np.stack([chars, tokens], 1).astype(np.int64))

    def build(self, rows: np.ndarray) -> None:
        self.n = len(rows)
        self.width = 1 << max(0, (self.n - 1).bit_length())
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width:self.width + self.n] = rows
        for level in reversed(range(self.width.bit_length() - 1)):
            a, b = 1 << level, 2 << level
            self.sums[a:b] = self.sums[2 * a:2 * b:2] + self.sums[2 * a + 1:2 * b:2]
        self.updated = 0

    def leaf_at(self, char: int) -> tuple[int, int]:
        """(leaf, its first character) of the last leaf that starts at or before
        ``char``, by descending the character sums."""
        node, leaf, start, span = 1, 0, 0, self.width
        while span > 1:
            span //= 2
            node *= 2
            left = int(self.sums[node, 0])
            if leaf + span < self.n and start + left <= char:
                node, leaf, start = node + 1, leaf + span, start + left
        return leaf, start

    def total(self) -> tuple[int, int]:
        return int(self.sums[1, 0]), int(self.sums[1, 1])

    def rows(self) -> np.ndarray:
        return self.sums[self.width:self.width + self.n]

    def replace(self, first: int, last: int, rows: np.ndarray) -> None:
        """Put ``rows`` in place of leaves first .. last - 1; the same number of
        leaves updates their ancestors only."""
        if len(rows) != last - first:
            old = self.rows()
            updated = self.updated
            self.build(np.vstack([old[:first], rows, old[last:]]))
            self.updated = updated + 2 * self.width
            return
        nodes = set()
        for i, row in enumerate(rows):
            self.sums[self.width + first + i] = row
            nodes.add((self.width + first + i) // 2)
        self.updated += len(rows)
        while nodes and 0 not in nodes:
            for node in nodes:
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]
            self.updated += len(nodes)
            nodes = {node // 2 for node in nodes}


def valid_edits(edits: list | None, length: int) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    usable = [(e["start"], e["end"], e["replacement"] or "") for e in edits or []
              if e and e["start"] is not None and e["end"] is not None]
    for start, end, new in sorted(usable, key=lambda e: e[:2]):
        if 0 <= start <= end <= length and (not out or start >= out[-1][1]):
            out.append((start, end, new))
    return out


def apply_edits(text: str, tree: Tree, edits: list[tuple[int, int, str]],
                count: Counter, leaf: int = LEAF) -> tuple[str, int]:
    """(new text, pre-tokens encoded); ``tree`` becomes the new text's tree."""
    parts, at, shifts, shift = [], 0, [], 0
    for start, end, new in edits:
        parts += [text[at:start], new]
        at = end
        shift += len(new) - (end - start)
        shifts.append(shift)
    parts.append(text[at:])
    after = "".join(parts)
    if not tree.n:
        pieces = count.split(after)
        tree.build(np.stack(leaves(pieces, count.tokens(pieces), leaf), 1).astype(np.int64))
        return after, len(pieces)

    old = np.concatenate([[0], np.cumsum(tree.rows()[:, 0])]).tolist()
    regions, k = [], 0
    while k < len(edits):
        first, begin = tree.leaf_at(max(0, edits[k][0] - 2))
        before = shifts[k - 1] if k else 0
        pieces: list[str] = []
        last = tree.n
        for m in count.pattern.finditer(after, begin + before):
            pieces.append(m.group())
            here = m.end()
            # edits that the scan has reached are part of this region
            while k + 1 < len(edits) and edits[k + 1][0] + shifts[k] - 2 < here:
                k += 1
            back = here - shifts[k]
            if back >= edits[k][1]:
                i = bisect_left(old, back)
                if i < len(old) and old[i] == back:
                    last = max(first, i)
                    break
        else:
            k = len(edits) - 1
        regions.append((first, last, pieces))
        k += 1
    encoded = 0
    for first, last, pieces in reversed(regions):
        encoded += len(pieces)
        tokens = count.tokens(pieces)
        have = max(1, last - first)
        size = -(-len(pieces) // have) if pieces else 1
        # the same number of leaves, unless they would grow to twice their size
        same = size <= 2 * leaf
        rows = np.stack(leaves(pieces, tokens, max(1, size if same else leaf)), 1).astype(np.int64)
        if same and len(rows) < have:
            rows = np.vstack([rows, np.zeros((have - len(rows), 2), np.int64)])
        tree.replace(first, last, rows)
    return after, encoded


def _builder(path: str, leaf: int):
    def run(batches):
        count = counter(path)
        for batch in batches:
            total, chars, tokens = [], [], []
            for text in batch.column("text"):
                c, t = leaves_of(text.as_py() or "", count, leaf)
                chars.append(c)
                tokens.append(t)
                total.append(int(t.sum()))
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(total, pa.int64()), pa.array(chars, ints),
                 pa.array(tokens, ints)],
                names=[*batch.schema.names, "n_tokens", "leaf_chars", "leaf_tokens"])
    return run


def build_trees(docs: DataFrame, vocabulary: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, text, n_tokens and the leaves of every document's tree."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(rows, _builder(vocabulary, leaf), f"doc_id long, text string, {TREE}")


COUNTS = ("n_tokens long, n_edits int, n_tokens_after long, encoded_pieces long, "
          "updated_nodes long, leaf_chars array<int>, leaf_tokens array<int>")


def _counts(columns: list[list]) -> list[pa.Array]:
    ints = pa.list_(pa.int32())
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), ints, ints]
    return [pa.array(c, t) for c, t in zip(columns, types)]


def _edited(text: str, chars: np.ndarray, tokens: np.ndarray, n: int, edits: list | None,
            count: Counter, leaf: int) -> tuple[str, list]:
    """(new text, its COUNTS)."""
    edits = valid_edits(edits, len(text))
    if not edits:
        return text, [n, 0, n, 0, 0, chars, tokens]
    tree = Tree(chars.astype(np.int64), tokens.astype(np.int64))
    after, encoded = apply_edits(text, tree, edits, count, leaf)
    rows = tree.rows().astype(np.int32)
    return after, [n, len(edits), tree.total()[1], encoded, tree.updated, rows[:, 0], rows[:, 1]]


def _recounter(path: str, leaf: int):
    def run(batches):
        count = counter(path)
        for batch in batches:
            texts, rows = [], []
            columns = [batch.column(c) for c in ("text", "leaf_chars", "leaf_tokens", "n_tokens", "edits")]
            for text, chars, tokens, n, edits in zip(*columns):
                chars, tokens = (np.array(x.as_py() or [], np.int32) for x in (chars, tokens))
                new, counts = _edited(text.as_py() or "", chars, tokens, n.as_py(), edits.as_py(), count, leaf)
                texts.append(new if text.is_valid or counts[1] else None)
                rows.append(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()),
                 *_counts(list(zip(*rows)) if rows else [[]] * 7)],
                names=["doc_id", "text", *(c.split()[0] for c in COUNTS.split(", "))])
    return run


def _whole(path: str, leaf: int, edits_of):
    def run(batches):
        count = counter(path)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                chars, tokens = leaves_of(text, count, leaf)
                rows.append(_edited(text, chars, tokens, int(tokens.sum()), edits_of(text), count, leaf)[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *_counts(list(zip(*rows)) if rows else [[]] * 7)],
                names=["doc_id", *(c.split()[0] for c in COUNTS.split(", "))])
    return run


def count_edited(docs: DataFrame, vocabulary: str, edits_of=None, leaf: int = LEAF) -> DataFrame:
    """``build_trees`` and ``recount`` in one pass over ``docs``: the counts before and
    after the edits that ``edits_of`` (by default ``redactions``) finds in a text,
    without the texts."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(rows, _whole(vocabulary, leaf, edits_of or redactions), f"doc_id long, {COUNTS}")


def recount(trees: DataFrame, vocabulary: str, leaf: int = LEAF) -> DataFrame:
    """Apply the column ``edits`` (array of EDIT) of a table of trees: the new text
    and tree, the count before and after, and how much was encoded and updated."""
    rows = trees.select("doc_id", "text", "n_tokens", "leaf_chars", "leaf_tokens", "edits")
    return map_arrow(rows, _recounter(vocabulary, leaf), f"doc_id long, text string, {COUNTS}")


# Edits of the query: personal data and keys give way to marks, runs of
# exclamation marks shrink to one.
REDACTIONS = [
    (r"[A-Za-z0-9._]+@[A-Za-z0-9.]+", "<EMAIL>"),
    (r"\b[0-9a-f]{32,}\b|\bAKIA[0-9A-Z]{16}\b", "<KEY>"),
    (r"\b\d{16}\b", "<CARD>"),
    (r"!{2,}", "!"),
]


# letters of any script are word characters at \\b, as in the expressions
_ANY = re.compile("|".join(f"({p})" for p, _ in REDACTIONS).replace(r"\d", "[0-9]"))
_WITHOUT_AT = re.compile("|".join(f"({p})" for p, _ in REDACTIONS[1:]).replace(r"\d", "[0-9]"))
_MARKS = [new for _, new in REDACTIONS]


def redactions(text: str) -> list[dict]:
    """The edits of REDACTIONS in a text."""
    first, pattern = (1, _ANY) if "@" in text else (2, _WITHOUT_AT)
    return [{"start": m.start(), "end": m.end(), "replacement": _MARKS[m.lastindex + first - 2]}
            for m in pattern.finditer(text)]


def with_redactions(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``edits``: those of REDACTIONS, null for texts without any.

    Built-in functions give no offsets of matches, so the text is split at the
    matches and the offsets are summed up.
    """
    pattern = "|".join(f"({p})" for p, _ in REDACTIONS)
    text = F.col("text")
    # what every match holds; a plain search is far cheaper than the pattern
    some = (text.contains("@") | text.contains("!!") | text.contains("AKIA")
            | text.rlike("[0-9]") | text.rlike("[a-f]{32}")) & text.rlike(pattern)

    def mark(m):
        case = F
        for p, new in REDACTIONS:
            case = case.when(m.rlike(f"^(?:{p})$"), F.lit(new))
        return case.otherwise(F.lit(""))

    def step(acc, i):
        start = acc["at"] + F.length(F.get(F.col("_between"), i))
        end = start + F.length(F.get(F.col("_found"), i))
        edit = F.array(F.struct(start.alias("start"), end.alias("end"),
                                mark(F.get(F.col("_found"), i)).alias("replacement")))
        return F.struct(end.alias("at"),
                        F.concat(acc["edits"], edit).cast(f"array<{EDIT}>").alias("edits"))

    zero = F.expr(f"struct(0 as at, cast(array() as array<{EDIT}>) as edits)")
    def kept(df: DataFrame, name: str, value) -> DataFrame:
        """``df`` with a column that is computed once: a generator is a barrier, behind
        which the optimizer does not repeat the expression wherever it is used."""
        return df.select(F.inline(F.array(F.struct(*df.columns, value.alias(name)))))

    out = kept(docs, "_found", F.when(some, F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(1))))
    out = kept(out, "_between", F.when(F.col("_found").isNotNull(), F.split("text", pattern)))
    return out.withColumn("edits", F.when(F.col("_found").isNotNull(), F.aggregate(
        F.sequence(F.lit(0), F.size("_found") - 1), zero, step, lambda acc: acc["edits"]))) \
        .drop("_found", "_between")
