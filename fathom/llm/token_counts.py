"""Token counts of a sentence-piece BPE vocabulary by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from fathom.llm.chunks import PIECES, by_bytes, default_path, distinct_chunks, tokenizer_file
from fathom.llm.common import pick

BLANK = "▁"
#: Characters of a pre-token beyond which its pairs wait by rank: reading all of it in every step costs its square.
LONG = 4096
#: Places below which a step by rank takes them singly.
FEW = 64
#: No pair.
_NONE = np.iinfo(np.int32).max


def _fields(data: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """(number, wire type, value) of each field of a serialized protocol message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = varint()
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            yield number, wire, varint()
        else:
            n = {1: 8, 5: 4}.get(wire) or varint()
            yield number, wire, data[at : at + n]
            at += n


class PieceMerger:
    """Counts the pieces of texts, as ``sentencepiece`` does for a BPE model.

    Symbols are the characters; of all adjacent symbols of a pre-token whose
    join is a piece, the pair with the best score (lowest rank, leftmost
    first) is joined, until none is left.  A symbol that is no piece counts
    one for each of its UTF-8 bytes (byte fallback).

    Pre-tokens are held in one flat array.  In each step every pre-token's
    lowest rank is found and all its pairs of that rank are joined at once,
    from left to right.  That equals joining one at a time as long as all
    pieces made from one of that rank rank after it; of ranks where that
    does not hold only the leftmost pair is joined in a step.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = {}  # what the model says of its text normalization
        kind, fallback = 1, False
        for number, _, value in _fields(model):
            if number == 2:
                for n, _, v in _fields(value):
                    kind = v if n == 3 else kind
                    fallback = bool(v) if n == 35 else fallback
            elif number == 3:
                plain |= {n: v for n, _, v in _fields(value)}
        sp = self.library
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        normal = [p for i, p in enumerate(pieces) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        #: Models with other rules go through the library itself.
        self.simple = (
            kind == 2
            and fallback
            and not plain.get(2)
            and plain.get(3, 1) == 1
            and plain.get(4, 1) == 0
            and plain.get(5, 1) == 1
            and not any(sp.is_unused(i) for i in range(len(pieces)))
            and not any(BLANK in p.lstrip(BLANK) for p in normal)
        )
        if not self.simple:
            return
        score = {p: -sp.get_score(sp.piece_to_id(p)) for p in normal}
        chars = sorted({c for p in normal for c in p})
        self.symbol = {p: i for i, p in enumerate([*chars, *sorted(p for p in normal if len(p) > 1)])}
        self.names = list(self.symbol)
        self.is_piece = np.array([p in score for p in self.names])
        self.code = np.full(0x110000, -1, np.int32)
        self.code[[ord(c) for c in chars]] = np.arange(len(chars))
        ranks = {s: r for r, s in enumerate(sorted({score[p] for p in normal}))}
        keys, rank, joined = [], [], []
        self.one_by_one = np.zeros(len(ranks), bool)
        for p in normal:
            for i in range(1, len(p)):
                a, b = self.symbol.get(p[:i]), self.symbol.get(p[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    rank.append(ranks[score[p]])
                    joined.append(self.symbol[p])
                    for part in (p[:i], p[i:]):
                        if len(part) > 1 and ranks[score[part]] >= ranks[score[p]]:
                            self.one_by_one[ranks[score[part]]] = True
        order = np.argsort(np.array(keys, np.int64))
        self._index(np.array(keys, np.int64)[order], np.array(rank, np.int32)[order], np.array(joined, np.int32)[order])

    def _index(self, keys: np.ndarray, rank: np.ndarray, joined: np.ndarray) -> None:
        """An open hash table of the pairs; the last slot is no pair."""
        self.bits = max(4, int(len(keys) * 4).bit_length())
        size = 1 << self.bits
        self.t_key = np.full(size + 1, -1, np.int64)
        self.t_rank = np.full(size + 1, _NONE, np.int32)
        self.t_join = np.full(size + 1, -1, np.int32)
        slots, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            _, first = np.unique(slots[todo], return_index=True)
            free = first[self.t_key[slots[todo[first]]] < 0]
            put = todo[free]
            self.t_key[slots[put]], self.t_rank[slots[put]], self.t_join[slots[put]] = keys[put], rank[put], joined[put]
            todo = np.delete(todo, free)
            slots[todo] = (slots[todo] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each pair of symbols in the table; the last slot for no pair."""
        size = 1 << self.bits
        keys = a.astype(np.int64) << 32 | b.astype(np.int64)
        slots = self._slot(keys)
        at = np.where((a >= 0) & (b >= 0), slots, size)
        todo = np.flatnonzero((self.t_key[at] != keys) & (self.t_key[at] >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & (size - 1)
            k = self.t_key[at[todo]]
            todo = todo[(k != keys[todo]) & (k >= 0)]
        return np.where(self.t_key[at] == keys, at, size)

    @cached_property
    def _apart(self) -> np.ndarray:
        """Whether two characters, by code, are never next to each other in a piece."""
        n = int(self.code.max()) + 1
        apart = np.ones((n + 1, n + 1), bool)
        for p in self.names:
            for x, y in zip(p, p[1:]):
                apart[self.code[ord(x)], self.code[ord(y)]] = False
        return apart

    def counts(self, pretokens: list[str]) -> np.ndarray:
        """How many pieces each pre-token has."""
        sizes = np.array([len(p) for p in pretokens], np.int64)
        points = np.frombuffer("".join(pretokens).encode("utf-32-le", "surrogatepass"), "<u4")
        syms = self.code[points].copy()
        owner = np.repeat(np.arange(len(sizes)), sizes)
        extra = np.where(syms < 0, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), 1)
        result = np.zeros(len(sizes), np.int64)
        np.add.at(result, owner[syms < 0], extra[syms < 0])
        # Where no piece has the two characters side by side, both sides are merged on their own.
        new = np.ones(len(syms), bool)
        new[1:] = (owner[1:] != owner[:-1]) | self._apart[syms[1:] * 0 + syms[:-1], syms[1:]]
        group = np.cumsum(new) - 1
        known = syms >= 0
        syms, owner, group = syms[known], owner[known], group[known]
        long = sizes[owner] > LONG
        if long.any():
            left, its = self._by_rank(syms[long], group[long])
            np.add.at(result, owner[long][its], self._pieces(left))
            syms, owner, group = syms[~long], owner[~long], group[~long]
        while len(syms):
            pair = np.full(len(syms), len(self.t_key) - 1, np.int64)
            inside = np.flatnonzero(group[1:] == group[:-1])
            pair[inside] = self._pairs(syms[inside], syms[inside + 1])
            rank = self.t_rank[pair]
            heads = np.flatnonzero(np.diff(group, prepend=-1))
            least = np.minimum.reduceat(rank, heads)
            done = least == _NONE
            lengths = np.diff(heads, append=len(syms))
            if done.any():
                gone = np.repeat(done, lengths)
                np.add.at(result, owner[gone], self._pieces(syms[gone]))
            hit = (rank == np.repeat(least, lengths)) & (rank != _NONE)
            hit = self._disjoint(np.flatnonzero(hit), group, rank)
            keep = ~np.repeat(done, lengths)
            syms[hit] = self.t_join[pair[hit]]
            keep[hit + 1] = False
            syms, owner, group = syms[keep], owner[keep], group[keep]
        return result

    def _pieces(self, syms: np.ndarray) -> np.ndarray:
        """How many pieces each symbol counts: one, or its bytes where it is none."""
        pieces = np.where(self.is_piece[syms], 1, 0)
        odd = np.flatnonzero(pieces == 0)
        pieces[odd] = [len(self.names[s].encode()) for s in syms[odd]]
        return pieces

    @cached_property
    def _pair(self) -> dict[int, tuple[int, int]]:
        """Rank and joined symbol of each pair, for steps of a few places."""
        used = self.t_key >= 0
        return dict(zip(self.t_key[used].tolist(), zip(self.t_rank[used].tolist(), self.t_join[used].tolist())))

    def _by_rank(self, syms: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that merging leaves, and where each starts; for long groups.

        The same steps as in ``counts``, but places of pairs wait by rank and
        symbols are linked to their neighbours, so that a step touches the
        pairs of its rank only.  A step of few places, or of a rank whose
        pairs are joined one at a time, takes them from the left.
        """
        n = len(syms)
        syms = syms.astype(np.int64)
        ends = np.append(group[1:] != group[:-1], True)
        after = np.where(ends, -1, np.arange(1, n + 1))
        before = np.where(np.append(True, ends[:-1]), -1, np.arange(-1, n - 1))
        alive = np.ones(n, bool)
        many: dict[int, list[np.ndarray]] = {}
        few: dict[int, list[int]] = {}
        ranks: list[int] = []

        def announce(rank: int) -> None:
            if rank not in many and rank not in few:
                heapq.heappush(ranks, rank)

        def slots(at: np.ndarray) -> np.ndarray:
            """The slot of the pair that starts at each place."""
            found = np.full(len(at), len(self.t_key) - 1, np.int64)
            inside = np.flatnonzero(alive[at] & (after[at] >= 0))
            found[inside] = self._pairs(syms[at[inside]], syms[after[at[inside]]])
            return found

        def wait(at: np.ndarray) -> None:
            rank = self.t_rank[slots(at)]
            at, rank = at[rank != _NONE], rank[rank != _NONE]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            heads = np.flatnonzero(np.diff(rank, prepend=-1))
            for r, places in zip(rank[heads].tolist(), np.split(at, heads[1:])):
                announce(r)
                many.setdefault(r, []).append(places)

        def pair(at: int) -> tuple[int, int] | None:
            if at < 0 or not alive[at] or after[at] < 0:
                return None
            return self._pair.get(int(syms[at]) << 32 | int(syms[after[at]]))

        wait(np.arange(n))
        while ranks:
            r = heapq.heappop(ranks)
            places, queue = many.pop(r, []), few.pop(r, [])
            if self.one_by_one[r] or sum(map(len, places)) + len(queue) < FEW:
                for at in (at for some in places for at in some.tolist()):
                    heapq.heappush(queue, at)
                while queue and not (ranks and ranks[0] < r):
                    at = heapq.heappop(queue)
                    found = pair(at)
                    if found is None or found[0] != r:
                        continue
                    gone = int(after[at])
                    syms[at], alive[gone], after[at] = found[1], False, after[gone]
                    if after[at] >= 0:
                        before[after[at]] = at
                    for next_at in (at, int(before[at])):
                        new = pair(next_at)
                        if new is not None and new[0] == r:
                            heapq.heappush(queue, next_at)
                        elif new is not None:
                            announce(new[0])
                            heapq.heappush(few.setdefault(new[0], []), next_at)
                if queue:
                    announce(r)
                    few[r] = queue
                continue
            at = np.unique(np.concatenate([*places, np.array(queue, np.int64)]))
            at = at[self.t_rank[slots(at)] == r]
            # In a run of overlapping pairs every second one is joined.
            run = np.maximum.accumulate(np.where(after[np.roll(at, 1)] != at, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            gone = after[at]
            syms[at] = self.t_join[slots(at)]
            alive[gone] = False
            after[at] = after[gone]
            linked = after[at] >= 0
            before[after[at[linked]]] = at[linked]
            wait(np.unique(np.concatenate([at, before[at][before[at] >= 0]])))
        left = np.flatnonzero(alive)
        return syms[left], left

    def _disjoint(self, at: np.ndarray, group: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Of the pairs ``at`` those to join now: from left to right, none that shares a symbol with one before."""
        first = np.diff(group[at], prepend=-1) != 0
        # In a run of overlapping pairs every second one is joined.
        run = np.maximum.accumulate(np.where(first | (np.diff(at, prepend=-2) != 1), np.arange(len(at)), 0))
        return at[first | ~self.one_by_one[rank[at]] & ((np.arange(len(at)) - run) % 2 == 0)]

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """How many pieces each text has (null: none)."""
        if not self.simple:
            ids = self.library.encode([t or "" for t in texts.to_pylist()], num_threads=1)
            return np.array([len(x) for x in ids], np.int64)
        texts = pc.replace_substring(pc.fill_null(texts, ""), BLANK, " ")
        chunks, index, offsets = distinct_chunks(texts, PIECES)
        words = chunks.to_pylist()
        counts = self.counts([BLANK + w.replace(" ", BLANK) for w in words])
        per_text = np.add.reduceat(counts[index], offsets[:-1]) if len(texts) else np.zeros(0, np.int64)
        per_text[pc.equal(texts, "").to_numpy(zero_copy_only=False)] = 0
        return per_text


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 4096) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``).

    Tokens are those ``sentencepiece`` gives for the whole text, without
    begin, end or added special tokens.  One pass over the scan without a
    shuffle; a task holds the distinct chunks of a bounded slice of a batch.

    Null texts count as empty: no bytes, no tokens.  Null doc_ids and
    repeated rows are kept.  An empty table gives no rows; further columns
    are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(tokenizer_file(path or default_path("piece_bpe_32k.model")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = None
        for whole in batches:
            merger = merger or PieceMerger(model.value)
            for batch in by_bytes(whole, 1):
                n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
                tokens = merger(batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), n_bytes, pa.array(tokens), pa.array(tokens > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return pick(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
