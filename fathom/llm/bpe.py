"""Byte-level BPE: ranked merges folded by Spark's higher-order functions, and decoding."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm.chunks import BYTE_LEVEL, by_bytes, default_path, distinct_chunks, ragged, tokenizer_file
from fathom.llm.common import pick

#: Words that a task remembers before it starts anew, and bytes of text handled at once.
REMEMBERED, SLICE = 700_000, 4 << 20
#: Chunks that begin with a blank of any kind (other control characters are none), or are empty.
_BLANK_FIRST = r"^([\x09-\x0d\x1c-\x20\x{85}\p{Z}]|$)"
#: A merge is stored as first id << 20 | rank, so ids must be below 2^20; NO_MERGE is above all merges.
BITS = 20
IDS, NO_MERGE = 1 << BITS, 1 << 44
#: Where a place's rank begins, behind the id and the 10 bits of the first byte's number.
RANK_AT = BITS + 10
#: Pieces of more bytes are merged by a heap: each step of the fold reads the whole piece.
LONG_WORD = 512
#: Bytes of a token that are looked up where words are cut, and bits of the table's slots.
GRAM, SLOT_BITS = 8, 22
#: Bytes of words that are cut at once.
BLOCK = 1 << 18


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, tokenizer_file(path).splitlines())}


@lru_cache(maxsize=4)
def rank_map(path: str) -> tuple[str, str]:
    """The ranks of all pairs of adjacent symbols as two literals, comma-separated: bases and slots.

    The pair (a, b) is at slot bases[a] + b, where the merge is stored with
    ``a`` to tell it from other pairs: a sparse table whose rows are shifted
    until none overlap.  A symbol is a token's id, and the rank of a pair is
    the id of the token with their joined bytes.
    """
    ranks = read_ranks(path)
    if max(ranks.values()) >= IDS:
        raise ValueError(f"ids of {IDS} and above don't fit the rank map")
    rows: dict[int, list[tuple[int, int]]] = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                rows.setdefault(a, []).append((b, rank))
    size = max(ranks.values()) + 1 + 8 * sum(map(len, rows.values()))
    used, slots = np.zeros(size, bool), np.full(size, NO_MERGE, np.int64)
    bases = np.zeros(max(ranks.values()) + 1, np.int64)
    at = 0
    for a in sorted((a for a in rows if len(rows[a]) > 1), key=lambda a: (-len(rows[a]), a)):
        b, rank = np.array(rows[a]).T
        shape = b - b.min()
        while True:
            tries = np.arange(at, at + 4096)
            free = np.flatnonzero(~used[tries[:, None] + shape[None, :8]].any(axis=1))
            fits = next((i for i in free if not used[at + i + shape].any()), None)
            if fits is not None:
                break
            at += 4096
        put = at + int(fits) + shape
        used[put], slots[put] = True, a << BITS | rank
        bases[a] = put[0] - b[0]
        at = max(0, put.min() - 4096) if len(b) > 4 else int(put.min())
    holes = iter(np.flatnonzero(~used).tolist())
    for a in sorted(a for a in rows if len(rows[a]) == 1):
        ((b, rank),) = rows[a]
        put = next(holes)
        used[put], slots[put] = True, a << BITS | rank
        bases[a] = put - b
    end = int(np.flatnonzero(used)[-1]) + 1
    return ",".join(map(str, bases.tolist())), ",".join(map(str, slots[:end].tolist()))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def merged(places: Column, path: str) -> Column:
    """``places`` after all merges: lowest rank first, leftmost of equals, until none is left.

    A place is the rank of the symbol's pair with the next one (IDS: none),
    its first byte's number in the piece (below 1024) and its id, by bits.  So
    the least place is the next merge, whose rank is the new symbol's id, and
    a step looks up two ranks: those on both sides of the new symbol.
    """
    bases, slots = (F.split(F.lit(x), ",") for x in rank_map(path))
    long = lambda x: F.lit(x).cast("long")

    def fold(slot: Column, base: Column) -> Column:
        def symbol(place: Column) -> Column:
            return place.bitwiseAND(long(IDS - 1))

        def rank(a: Column, b: Column) -> Column:
            # The rank where the slot is the pair's, else a number of IDS or above; null beside the ends.
            found = F.get(slot, (F.get(base, a.cast("int")) + b).cast("int")).bitwiseXOR(F.shiftleft(a, BITS))
            return F.shiftleft(F.least(found, long(IDS)), RANK_AT)

        def step(word: Column, _: Column) -> Column:
            def found(least: Column) -> Column:
                def put(before: Column) -> Column:
                    new, left = F.shiftright(least, RANK_AT), F.get(word, before)
                    at = least.bitwiseAND(long((1 << RANK_AT) - IDS)) + new
                    at = rank(new, symbol(F.get(word, before + 3))) + at
                    left = rank(symbol(left), new) + left.bitwiseAND(long((1 << RANK_AT) - 1))
                    rest = F.slice(word, before + 4, F.lit(LONG_WORD))
                    inside = F.flatten(F.array(F.slice(word, F.lit(1), before), F.array(left, at), rest))
                    return F.when(before < 0, F.flatten(F.array(F.array(at), rest))).otherwise(inside)

                more = _let((F.array_position(word, least) - 2).cast("int"), put)
                return F.when(least < IDS << RANK_AT, more).otherwise(word)

            return _let(F.array_min(word), found)

        return F.aggregate(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(places))), places, step)

    # Each table stands once in the plan: every task reads it anew.
    return _let(slots.cast("array<long>"), lambda slot: _let(bases.cast("array<int>"), lambda base: fold(slot, base)))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """What ``merged`` gives, for words of any length in n log n steps: the same merges from a heap of pairs."""
    n = len(word)
    # Each symbol by where it begins: where it ends is where the next one begins.
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank = lambda a, b: ranks.get(word[a:b])
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(i, i + 2)) is not None]
    heapq.heapify(heap)
    while heap:
        _, a, end = heapq.heappop(heap)
        b = after[a]
        # Gone: a symbol that was joined to the one before it, or a pair whose symbols have grown.
        if b < 0 or b >= n or after[b] != end:
            continue
        after[a], after[b] = end, -1
        if end < n:
            before[end] = a
            if (r := rank(a, after[end])) is not None:
                heapq.heappush(heap, (r, a, after[end]))
        if before[a] >= 0 and (r := rank(before[a], end)) is not None:
            heapq.heappush(heap, (r, before[a], end))
    out, a = [], 0
    while a < n:
        out.append(ranks[word[a : after[a]]])
        a = after[a]
    return out


class Words:
    """The pattern's matches in texts, found once in each distinct chunk."""

    def __init__(self, pattern: str):
        import regex

        self.find = regex.compile(pattern).findall

    def __call__(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(words, index, offsets): distinct words, each text's words as indices, where a text begins."""
        chunks, index, offsets = distinct_chunks(texts, BYTE_LEVEL)
        heads = chunks.take(pa.array(index[offsets[:-1]])).to_pylist()
        # All chunks in one string, as none's matches reach into the next one; those that are
        # empty or begin with a blank only stand at texts' beginnings and are found below.
        parts = pc.if_else(pc.match_substring_regex(chunks, _BLANK_FIRST), "-", chunks)
        found = self.find(" " + " ".join(parts.to_pylist()))
        sizes = pc.utf8_length(pa.array(found, pa.string())).to_numpy()
        ends = np.searchsorted(np.cumsum(sizes), np.cumsum(pc.utf8_length(parts).to_numpy() + 1)) + 1
        # Chunks at the end stand for texts' beginnings, which have no blank before them.
        firsts = [self.find(c) for c in heads]
        ends = np.concatenate([ends, len(found) + np.cumsum([len(f) for f in firsts], dtype=np.int64)])
        index = index.copy()
        index[offsets[:-1]] = len(chunks) + np.arange(len(heads))
        coded = pa.array([*found, *[w for f in firsts for w in f]], pa.string()).dictionary_encode()
        sizes = np.diff(ends, prepend=0)
        of_chunk = sizes[index]
        words = coded.indices.to_numpy()[ragged((ends - sizes)[index], of_chunk)]
        return coded.dictionary.to_pylist(), words, np.concatenate([[0], np.cumsum(of_chunk)])[offsets]


class Cuts:
    """Cuts words where no merge can reach across, so that their pieces are merged on their own.

    A merge across a place makes a token that lies across it.  Where no
    stretch of the word across a place is a token (of a token of over 8 bytes:
    any 8 bytes in a row), both sides end as they would alone.  Stretches are
    looked up by hash alone: one that is taken for a token by mistake only
    leaves a place uncut.
    """

    def __init__(self, tokens: Iterable[bytes]):
        tokens = list(tokens)
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        sizes = np.array([len(t) for t in tokens], np.int64)
        left, size = self._left(sizes), np.repeat(sizes, sizes)
        self.known = np.zeros(1 << SLOT_BITS, bool)
        for n, slots in self._grams(raw):
            m = len(slots)
            self.known[slots[(left[:m] >= n) & ((size[:m] == n) | (n == GRAM))]] = True

    @staticmethod
    def _left(sizes: np.ndarray) -> np.ndarray:
        """How many bytes each byte's word has from there on."""
        return np.repeat(np.cumsum(sizes), sizes) - np.arange(sizes.sum())

    @staticmethod
    def _grams(raw: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(n, slots) for n from 2: the slot of the n bytes from each byte on."""
        key = raw.astype(np.uint64)
        for n in range(2, min(GRAM, len(raw)) + 1):
            key = key[:-1] | raw[n - 1 :].astype(np.uint64) << np.uint64(8 * n - 8)
            mixed = (key ^ key >> np.uint64(29) ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            yield n, (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def _cut(self, raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether a piece begins at each byte of the words."""
        left = self._left(sizes)
        # Across a place lie the stretches that begin before it less those that end at it or before.
        across = np.zeros(len(raw) + 1, np.int32)
        for n, slots in self._grams(raw):
            at = np.flatnonzero(self.known[slots] & (left[: len(slots)] >= n))
            across[at + 1] += 1
            across[at + n] -= 1
        return np.cumsum(across[:-1]) == 0

    def __call__(self, words: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(pieces, index, counts): distinct pieces, all words' pieces as indices, how many each word has."""
        sizes = pc.binary_length(pa.array(words, pa.string())).to_numpy().astype(np.int64)
        raw = np.frombuffer("".join(words).encode(), np.uint8)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        # Some words at a time, as each byte takes many while stretches are looked up.
        blocks = np.unique(np.append(np.searchsorted(begins, np.arange(0, len(raw), BLOCK)), len(sizes)))
        cut = [self._cut(raw[begins[a] : begins[b]], sizes[a:b]) for a, b in zip(blocks[:-1], blocks[1:])]
        cut = np.concatenate([np.zeros(0, bool), *cut])
        ends = np.append(np.flatnonzero(cut), len(raw)).astype(np.int32)
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(raw)])
        coded = pieces.dictionary_encode()
        upto = np.concatenate([[0], np.cumsum(cut)])[begins]
        return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.diff(upto)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per document: doc_id, ids (unsigned 32-bit, little-endian), n_tokens, decoded (bytes).

    ids are those of ``tiktoken`` for the rank file: every match of the
    pattern on its own, no special tokens.  In one pass over the scan, without
    a shuffle: a task cuts the distinct words of its documents where no merge
    can reach across (``Cuts``), names each distinct piece ahead of them, and
    the documents as numbers of pieces; Spark folds the merges over the
    pieces' bytes (``merged``), and the task puts the documents together from
    the pieces' ids.  Words that are tokens need no merge, and pieces of more
    than 512 bytes take the same merges from a heap in the task
    (``merge_long``), as the fold's time grows with the square of a piece's
    length.  ``decoded`` joins the ids' byte strings again.

    Null texts count as empty: no ids.  Null doc_ids and repeated rows are
    documents like any other.  An empty table gives no rows; further columns
    are ignored.
    """
    import public_tokenizers

    path = path or default_path("byte_bpe_multi_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    spec = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    arrow = pa.schema([
        ("doc_id", pa.int64()), ("pieces", pa.binary()), ("first", pa.bool_()), ("places", pa.list_(pa.int64())),
        ("merged", pa.bool_()),
    ])

    def name_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, find, number = spec.value, Words(pattern), {}
        cuts = Cuts(ranks)
        byte_id = np.array([ranks[bytes((b,))] for b in range(256)], np.int64)
        pair_rank = np.full((256, 256), IDS, np.int64)
        for t, rank in ranks.items():
            if len(t) == 2:
                pair_rank[t[0], t[1]] = rank
        # Bytes that are no text are no word either.
        tokens = {t.decode(): rank for t, rank in ranks.items() if t.decode(errors="ignore").encode() == t}

        def places(pieces: list[bytes], sizes: np.ndarray) -> np.ndarray:
            raw, ends = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes)
            rank = np.full(len(raw), IDS, np.int64)
            rank[:-1] = pair_rank[raw[:-1], raw[1:]]
            rank[ends - 1] = IDS
            return rank << RANK_AT | (np.arange(len(raw)) - np.repeat(ends - sizes, sizes)) << BITS | byte_id[raw]

        def named(batch: pa.RecordBatch, number: dict) -> tuple[pa.RecordBatch, pa.RecordBatch]:
            first = len(number)
            words, index, offsets = find(batch.column(1))
            is_token = np.array([w in tokens for w in words], bool)
            whole = [w for w in words if w in tokens]
            pieces, of_words, counts = cuts([w for w in words if w not in tokens])
            # Words that are tokens are named by their text, pieces by their bytes.
            new_whole = [w for w in whole if w not in number]
            new = [p for p in pieces if p not in number]
            short, long = [p for p in new if len(p) <= LONG_WORD], [p for p in new if len(p) > LONG_WORD]
            names = [*short, *new_whole, *long]
            number.update(zip(names, range(first, first + len(names))))
            # A word that is a token is its only place; pieces begin as their bytes, and long ones are done.
            done = [merge_long(p, ranks) for p in long]
            sizes = np.array([len(p) for p in short], np.int64)
            flat = [places(short, sizes), np.array([tokens[w] for w in new_whole], np.int64), *[np.array(d, np.int64) for d in done]]
            sizes = np.concatenate([sizes, np.ones(len(new_whole), np.int64), np.array([len(d) for d in done], np.int64)])
            # The first of all pieces of this task, or after it forgot, says so.
            pieces_named = pa.RecordBatch.from_arrays(
                [pa.nulls(len(names), pa.int64()), pa.nulls(len(names), pa.binary()),
                 pa.array(np.arange(first, first + len(names)) == 0),
                 pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(np.concatenate(flat))),
                 pa.array(np.arange(len(names)) >= len(short))],
                schema=arrow,
            )
            # The numbers of all words' pieces, those of tokens first, and where a word's begin.
            numbers = np.concatenate([
                np.array([number[w] for w in whole], "<i4"), np.array([number[p] for p in pieces], "<i4")[of_words],
            ])
            counts = np.concatenate([np.ones(len(whole), np.int64), counts])
            place = np.empty(len(words), np.int64)
            place[is_token], place[~is_token] = np.arange(len(whole)), np.arange(len(whole), len(words))
            index = place[index]
            known = numbers[ragged((np.cumsum(counts) - counts)[index], counts[index])]
            ends = np.concatenate([[0], np.cumsum(counts[index])])[offsets].tolist()
            return pieces_named, pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([known[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                 pa.nulls(batch.num_rows, pa.bool_()), pa.nulls(batch.num_rows, pa.list_(pa.int64())),
                 pa.nulls(batch.num_rows, pa.bool_())],
                schema=arrow,
            )

        for whole in batches:
            for batch in by_bytes(whole, 1, SLICE):
                if len(number) > REMEMBERED:
                    number = {}
                yield from named(batch, number)

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = sorted((rank, token) for token, rank in spec.value.items())
        bytes_of = np.zeros(tokens[-1][0] + 1, np.int64)
        bytes_of[[rank for rank, _ in tokens]] = [len(token) for _, token in tokens]
        raw = np.frombuffer(b"".join(token for _, token in tokens), np.uint8)
        flat, ends = np.zeros(0, np.int32), np.zeros(0, np.int64)
        for batch in batches:
            is_doc = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            turns = np.concatenate([[0], np.flatnonzero(np.diff(is_doc)) + 1, [len(is_doc)]])
            for a, b in zip(turns[:-1].tolist(), turns[1:].tolist()):
                rows = batch.slice(a, b - a)
                if a < b and is_doc[a]:
                    for part in by_bytes(rows, 1, SLICE // 4):
                        yield documents(part, flat, ends, raw, bytes_of)
                elif a < b:
                    if rows.column(2)[0].as_py():
                        flat, ends = flat[:0], ends[:0]
                    ids = rows.column(3)
                    ends = np.concatenate([ends, len(flat) + np.cumsum(ids.value_lengths().to_numpy(), dtype=np.int64)])
                    flat = np.concatenate([flat, (ids.flatten().to_numpy() & IDS - 1).astype(np.int32)])

    def documents(rows: pa.RecordBatch, flat: np.ndarray, ends: np.ndarray, raw: np.ndarray, bytes_of: np.ndarray) -> pa.RecordBatch:
        packed = rows.column(1)
        piece = np.frombuffer(b"".join(packed.to_pylist()), "<i4")
        of_rows = np.concatenate([[0], np.cumsum(pc.binary_length(packed).to_numpy() // 4, dtype=np.int64)])
        sizes = ends[piece] - np.where(piece > 0, ends[piece - 1], 0)
        ids = flat[ragged(ends[piece] - sizes, sizes)]
        of_rows = np.concatenate([[0], np.cumsum(sizes)])[of_rows]
        long = bytes_of[ids]
        decoded = raw[ragged((np.cumsum(bytes_of) - bytes_of)[ids], long)]

        def cells(upto: np.ndarray, values: np.ndarray) -> pa.Array:
            buffers = [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(values)]
            return pa.BinaryArray.from_buffers(pa.binary(), len(upto) - 1, buffers)

        return pa.RecordBatch.from_arrays(
            [rows.column(0), cells(4 * of_rows, ids.astype("<u4")), pa.array(np.diff(of_rows), pa.int64()),
             cells(np.concatenate([[0], np.cumsum(long)])[of_rows], decoded)],
            ["doc_id", "ids", "n_tokens", "decoded"],
        )

    named = pick(docs, doc_id="long", text="string").mapInArrow(
        name_pieces, "doc_id long, pieces binary, first boolean, places array<long>, merged boolean"
    )
    # Null for documents, whose places are null, too.
    ids = F.when(F.col("merged"), F.col("places")).when(~F.col("merged"), merged(F.col("places"), path))
    return named.select("doc_id", "pieces", "first", ids.alias("ids")).mapInArrow(
        put_together, "doc_id long, ids binary, n_tokens long, decoded binary"
    )
