"""Periodic runs of words: maximal pairs of an LCP-interval tree, found bottom-up in each document."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fathom.llm.chunks import by_bytes
from fathom.llm.common import pick

MIN_WORDS = 12
#: Bytes of text handled at once, and positions in a block of a sorted list.
SLICE, BLOCK = 4 << 20, 1024

RUNS = "array<struct<start: long, length: long, period: long>>"


def _suffix_order(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order, levels): all suffixes in order, and ``levels[k]``: rank of the 2^k words at each position.

    Prefix doubling that goes on only where ranks are still tied.  Each
    document ends with a word of its own, so that no tie reaches beyond it.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    ordered = words[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    levels, h = [rank.astype(np.int32)], 1
    slots = np.arange(n)
    while True:
        # Slots of the order whose rank is shared with a neighbour.
        r = rank[order[slots]]
        tied = np.zeros(len(r), bool)
        same = r[1:] == r[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        slots = slots[tied]
        if not len(slots):
            return order, levels
        at = order[slots]
        key = rank[at] * n + rank[at + h]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        # Slots of one old rank follow each other, so a group's first slot is its new rank.
        rank[at] = slots[np.flatnonzero(new)][np.cumsum(new) - 1]
        levels.append(rank.astype(np.int32))
        h *= 2


def _common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at a and b have in common, from the longest steps down."""
    shared = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        shared += (levels[k][a + shared] == levels[k][b + shared]).astype(np.int64) << k
    return shared


class _Positions:
    """Positions in order, in blocks, so that adding one moves few others."""

    def __init__(self, first: int):
        self.blocks, self.size = [[first]], 1

    def add(self, x: int) -> None:
        i = self._block(x)
        block = self.blocks[i]
        block.insert(bisect_left(block, x), x)
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[i : i + 1] = [block[:BLOCK], block[BLOCK:]]

    def _block(self, x: int) -> int:
        """The last block that begins at or before x, else the first one."""
        return max(0, bisect_right(self.blocks, x, key=lambda block: block[0]) - 1)

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def from_(self, x: int) -> Iterator[int]:
        """The positions from x on."""
        i = self._block(x)
        j = bisect_left(self.blocks[i], x)
        while i < len(self.blocks):
            yield from self.blocks[i][j:] if j else self.blocks[i]
            i, j = i + 1, 0


def _pairs(at: list[int], shared: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, d): maximal pairs of d words at i < j with j - i <= d, for suffixes in order.

    ``shared[k]`` words are common to the suffixes at[k] and at[k + 1], and
    left[k] is the class of the word before at[k].  The LCP intervals close
    from the deepest up; each holds its positions in order, and the smaller
    list goes into the larger one.  Two positions of different children with
    different words to their left are a maximal pair as they stand.

    Occurrences of the same d words within distance d of each other lie whole
    periods apart.  So all that follow a position within d have the same word
    to their left: the nearest one tells whether they pair with it.  Likewise
    all that precede it, but for the farthest, have the word that is to its
    own left: only the farthest one can pair.
    """
    word = dict(zip(at, left))

    def joined(a: _Positions, b: _Positions, depth: int) -> Iterator[tuple[int, int, int]]:
        small, large = (a, b) if a.size < b.size else (b, a)
        for x in small:
            own = word[x]
            for y in large.from_(x):
                if y - x > depth or word[y] == own:
                    break
                if depth + y - x >= least:
                    yield x, y, depth
            first = next(large.from_(x - depth), x)
            if first < x and word[first] != own and depth + x - first >= least:
                yield first, x, depth
        for x in small:
            large.add(x)
        return large

    # Open intervals, the deepest last: (words in common, positions).
    stack: list[tuple[int, _Positions]] = []
    held = _Positions(at[0])
    for x, depth in zip([*at[1:], None], [*shared, 0]):
        while stack and stack[-1][0] > depth:
            below, other = stack.pop()
            held = yield from joined(other, held, below)
        if x is None:
            return
        if stack and stack[-1][0] == depth:
            held = yield from joined(stack.pop()[1], held, depth)
        stack.append((depth, held))
        held = _Positions(x)


def find_runs(words: np.ndarray, ends: np.ndarray, min_words: int = MIN_WORDS) -> list[dict[tuple[int, int], int]]:
    """For each document {(start, length): period}; ``words`` are codes, document k ends before ``ends[k]``.

    A run is a stretch of at least ``min_words`` words and two periods that
    no neighbouring word extends.  With its smallest period p it is the
    maximal pair (start, start + p, length - p).  The pairs of the period's
    multiples have the same start and length; the smallest distance stays.
    """
    found: list[dict[tuple[int, int], int]] = [{} for _ in ends]
    sizes = np.diff(ends, prepend=0)
    # A pair of a run has at least this many words in common.
    least = (min_words + 1) // 2
    doc = np.repeat(np.arange(len(ends)), sizes)
    if len(words) < 2 * least:
        return found
    # Only documents in which so many words occur twice in a row are looked at; the hash may let more pass.
    with np.errstate(over="ignore"):
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        gram = doc[: len(words) - least + 1].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(least):
            gram = (gram ^ mixed[k : len(words) - least + 1 + k]) * np.uint64(0xBF58476D1CE4E5B9)
            gram ^= gram >> np.uint64(29)
    gram = gram[doc[: len(gram)] == doc[least - 1 :]]
    of = doc[: len(doc) - least + 1][doc[: len(doc) - least + 1] == doc[least - 1 :]]
    by = np.argsort(gram, kind="stable")
    twice = gram[by[1:]] == gram[by[:-1]]
    some = np.unique(of[by[1:][twice]])
    if not len(some):
        return found

    # Those documents one after the other, each with a last word of its own; equal words of two are told apart.
    width = int(words.max()) + 2
    text = np.concatenate([
        np.append(words[ends[d] - sizes[d] : ends[d]].astype(np.int64), width - 1) + k * width
        for k, d in enumerate(some.tolist())
    ])
    starts = np.cumsum(sizes[some] + 1) - sizes[some] - 1
    order, levels = _suffix_order(text)
    shared = _common_prefix(levels, order[:-1], order[1:])
    # Stretches of suffixes with enough words in common: no interval of interest reaches beyond one.
    deep = shared >= least
    first = np.flatnonzero(deep & ~np.concatenate([[False], deep[:-1]]))
    last = np.flatnonzero(deep & ~np.concatenate([deep[1:], [False]])) + 1
    before = np.where(np.isin(order, starts), -1, text[order - 1])
    for a, b in zip(first.tolist(), last.tolist()):
        at, left, depths = order[a : b + 1], before[a : b + 1], shared[a:b]
        # One word to the left of all, or all too far apart: no pair.
        if (left[0] == left).all() or np.diff(np.sort(at)).min() > depths.max():
            continue
        k = int(np.searchsorted(starts, at[0], "right")) - 1
        runs, zero = found[some[k]], int(starts[k])
        for i, j, d in _pairs(at.tolist(), depths.tolist(), left.tolist(), min_words):
            stretch = (i - zero, d + j - i)
            runs[stretch] = min(j - i, runs.get(stretch, j - i))
    return found


def runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, runs (by start, then period), collapsed.

    Words are what stands between bytes 0x20 and 0x09 to 0x0D.  A run (start,
    length, period, in words) is a stretch with smallest period ``period``
    and at least ``min_words`` words and two periods that no word beside it
    extends.  ``collapsed`` is the text, words joined by one blank, without
    the words that a run holds behind its first period.

    Null and empty texts have no words, no runs and an empty ``collapsed``.
    Null doc_ids and repeated rows are documents like any other.  A document
    is never divided, so the longest one bounds a task's memory.  An empty
    table gives no rows; further columns are ignored.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, 1, SLICE):
                yield _batch(batch, min_words)

    return pick(docs, doc_id="long", text="string").mapInArrow(
        read, f"doc_id long, n_words long, runs {RUNS}, collapsed string"
    )


def _batch(batch: pa.RecordBatch, min_words: int) -> pa.RecordBatch:
    # bytes.split() divides at exactly the bytes that separate words here.
    split = [b"" if t is None else t for t in batch.column(1).cast(pa.binary()).to_pylist()]
    split = [t.split() for t in split]
    ends = np.cumsum([len(ws) for ws in split], dtype=np.int64)
    codes = pa.array([w for ws in split for w in ws], pa.binary()).dictionary_encode().indices.to_numpy()
    out, collapsed = [], []
    for words, found in zip(split, find_runs(codes, ends, min_words)):
        out.append([{"start": s, "length": n, "period": p} for (s, n), p in sorted(found.items(), key=lambda r: (r[0][0], r[1]))])
        if found:
            gone = np.zeros(len(words) + 1, np.int64)
            for (start, length), period in found.items():
                gone[start + period] += 1
                gone[start + length] -= 1
            words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
        collapsed.append(b" ".join(words))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array([len(ws) for ws in split], pa.int64()), pa.array(out, kind),
         pa.array(collapsed, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )
