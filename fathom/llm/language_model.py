"""Scoring by a weighted backoff automaton of smoothed word pairs, gathered from the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm.common import pick

#: Keys of the end of a text and of the state before its first word.
END, BEGIN = 0, 1
#: Bytes of text of a block, and of a part of the model's counts.
BLOCK_BYTES, PART_BYTES = 12 << 20, 8 << 20
#: Kinds of rows that travel between blocks and parts.
WORDS, PAIRS, CONTEXTS, TOTALS = 0, 1, 2, 3
_ROW = "part long, block long, kind int, body binary"


@dataclass(frozen=True)
class Smoothing:
    """Absolute discounts of words and pairs; pairs seen less than ``cutoff`` times have no arc.

    With a cutoff of 1 every pair that was learned has one, those seen once
    in the whole corpus as well.
    """

    word: float = 0.75
    pair: float = 0.75
    cutoff: int = 1
    #: Added to counts in the plain word model that scores are compared with.
    added: float = 0.1


class Block:
    """The words and word pairs of a block of texts, in an order that depends on its set of texts alone.

    ``key`` has the 64-bit hashes of the distinct words in rising order (of
    END and BEGIN as well), ``word`` the index of each token's word, and
    ``before`` that of the word before it; texts' tokens are contiguous, from
    ``starts``, and end with END.  ``pair`` is each token's (before, word) as
    an index to the distinct pairs, which are ``first`` and ``second``.
    """

    def __init__(self, texts: pa.Array, learned: np.ndarray):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        flat = lists.flatten()
        real = pc.not_equal(flat, "")
        counts = np.add.reduceat(
            np.append(real.to_numpy(zero_copy_only=False).astype(np.int64), 0), lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        )
        counts[pc.list_value_length(lists).to_numpy(zero_copy_only=False) == 0] = 0
        coded = flat.filter(real).dictionary_encode()
        hashes = [xxhash.xxh3_64_intdigest(w.encode()) for w in coded.dictionary.to_pylist()]
        self.key, place = np.unique(np.array([END, BEGIN, *hashes], np.uint64), return_inverse=True)
        place = place.astype(np.int32)
        end, begin = int(place[0]), int(place[1])
        ends = np.cumsum(counts)
        self.starts = ends - counts + np.arange(len(counts))
        self.sizes = counts + 1
        self.word = np.insert(place[2:][coded.indices.to_numpy()], ends, end)
        self.before = np.empty_like(self.word)
        self.before[1:] = self.word[:-1]
        self.before[self.starts] = begin
        both, pair = np.unique(self.before.astype(np.int64) * len(self.key) + self.word, return_inverse=True)
        self.pair = pair.astype(np.int32)
        self.first, self.second = (x.astype(np.int32) for x in np.divmod(both, len(self.key)))
        del both, pair
        of_token = np.repeat(learned, self.sizes)
        self.pair_count = np.bincount(self.pair, of_token, len(self.first)).astype(np.int64)
        self.word_count = np.bincount(self.word, of_token, len(self.key)).astype(np.int64)
        self.word_count[begin] = learned.sum()

    def word_parts(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """(order, part): the words by part, by key within a part."""
        part = (self.key % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        return order, part[order]

    def pair_parts(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """(order, part): the pairs by part, by keys within a part.

        The pairs of a first word are dealt by their second word over an eighth
        of all parts: few enough that the first word is not repeated in each,
        enough that a frequent word's pairs are no part's burden.
        """
        spread = max(1, parts // 8)
        second = _mixed(self.key[self.second], self.key[self.second]) % np.uint64(spread)
        at = self.key[self.first] % np.uint64(parts) + second * np.uint64(parts // spread)
        part = (at % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        return order, part[order]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (b >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    return x * np.uint64(0x165667B19E3779F9) >> np.uint64(3)


def _runs(part: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(part, start, stop) of each run of equal numbers."""
    at = np.flatnonzero(np.diff(part, prepend=-1))
    yield from zip(part[at].tolist(), at.tolist(), [*at[1:].tolist(), len(part)])


def _pack(*columns: np.ndarray) -> bytes:
    """Columns, one after the other, behind their lengths in bytes."""
    raw = [np.ascontiguousarray(c).tobytes() for c in columns]
    return np.array([len(r) for r in raw], "<u4").tobytes() + b"".join(raw)


def _unpack(body: bytes, *kinds: str) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(body, "<u4", len(kinds)), 4 * len(kinds), []
    for kind, n in zip(kinds, sizes.tolist()):
        out.append(np.frombuffer(body, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


def _table(rows: list[tuple], more: tuple[str, ...] = ()) -> pa.Table:
    kinds = [("part", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("body", pa.binary())]
    kinds += [(n, pa.int64()) for n in more]
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], names=[n for n, _ in kinds])


def _rows(table: pa.Table, kind: int) -> list[tuple[int, int, bytes]]:
    """(part, block, body) of the rows of a kind, in a fixed order."""
    rows = table.filter(pc.equal(table.column("kind"), kind))
    return sorted(zip(*(rows.column(n).to_pylist() for n in ("part", "block", "body"))))


def _counts(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts as bytes, and those of 255 and above once more as numbers: most pairs are rare."""
    return np.minimum(count, 255).astype("u1"), count[count >= 255].astype("<u4")


def _read_counts(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    count = small.astype("<u4")
    count[small == 255] = large
    return count


def _pair_body(h: np.ndarray, w: np.ndarray, count: np.ndarray) -> bytes:
    """Pairs sorted by their first word, which is written once; of the second word's key, 48 bits."""
    new = np.flatnonzero(np.diff(h, prepend=h[:1] + np.uint64(1)) != 0) if len(h) else np.zeros(0, np.int64)
    sizes = np.diff(new, append=len(h)).astype("<u4")
    low = w.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return _pack(h[new].astype("<u8"), sizes, low, *_counts(count))


def _read_pairs(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, sizes, low, small, large = _unpack(body, "<u8", "<u4", "u1", "u1", "<u4")
    w = np.zeros((len(low) // 6, 8), np.uint8)
    w[:, :6] = low.reshape(-1, 6)
    return np.repeat(h, sizes), w.view("<u8").ravel(), _read_counts(small, large)


def gather(block: int, found: Block, parts: int) -> pa.Table:
    """What a block tells the model's parts: its words and pairs and how often it learned from them."""
    rows = []
    order, part = found.word_parts(parts)
    key, count = found.key[order], found.word_count[order]
    rows += [(p, block, WORDS, _pack(key[a:b].astype("<u8"), count[a:b].astype("<u4"))) for p, a, b in _runs(part)]
    order, part = found.pair_parts(parts)
    h, w, count = found.key[found.first[order]], found.key[found.second[order]], found.pair_count[order]
    rows += [(p, block, PAIRS, _pair_body(h[a:b], w[a:b], count[a:b])) for p, a, b in _runs(part)]
    return _table(rows)


def sum_pairs(table: pa.Table, parts: int, how: Smoothing) -> pa.Table:
    """A part's pairs summed over all blocks.

    To each block that has some: which of its pairs have an arc, and their
    counts.  To the part of each first word: its arcs' counts and number.
    """
    rows = _rows(table, PAIRS)
    if not rows:
        return _table([])
    read = [_read_pairs(body) for _, _, body in rows]
    h, w, count = (np.concatenate(c) for c in zip(*read))
    order = np.lexsort((w, h))
    new = np.ones(len(order), bool)
    new[1:] = (h[order[1:]] != h[order[:-1]]) | (w[order[1:]] != w[order[:-1]])
    heads = np.flatnonzero(new)
    total = np.add.reduceat(count[order].astype(np.int64), heads)
    own = np.empty(len(order), np.int64)
    own[order] = np.cumsum(new) - 1
    arc = total >= max(1, how.cutoff)
    out, at = [], 0
    for (part, block, _), (rh, _, _) in zip(rows, read):
        mine = own[at : at + len(rh)]
        at += len(rh)
        has = arc[mine]
        out.append((part, block, PAIRS, _pack(np.packbits(has), *_counts(total[mine[has]]))))
    first = h[order[heads]][arc]
    if len(first):
        to = (first % np.uint64(parts)).astype(np.int64)
        by = np.lexsort((first, to))
        first, to, total = first[by], to[by], total[arc][by]
        heads = np.flatnonzero(np.diff(first, prepend=first[:1] + np.uint64(1)) != 0)
        sums = np.add.reduceat(total, heads)
        numbers = np.diff(heads, append=len(first))
        keys, to = first[heads], to[heads]
        for p, a, b in _runs(to):
            body = _pack(keys[a:b].astype("<u8"), sums[a:b].astype("<u8"), numbers[a:b].astype("<u4"))
            out.append((p, -1, CONTEXTS, body))
    return _table(out)


def sum_words(asked: pa.Table, contexts: pa.Table) -> pa.Table:
    """A part's words summed over all blocks, with the arcs that leave them; to each block, its words' figures."""
    rows = _rows(asked, WORDS)
    if not rows:
        return _table([], ("tokens", "words"))
    read = [_unpack(body, "<u8", "<u4") for _, _, body in rows]
    keys, own = np.unique(np.concatenate([k for k, _ in read]), return_inverse=True)
    count = np.bincount(own, np.concatenate([c for _, c in read]), len(keys)).astype(np.int64)
    arcs, number = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for _, _, body in _rows(contexts, CONTEXTS):
        k, total, n = _unpack(body, "<u8", "<u8", "<u4")
        at = np.searchsorted(keys, k)
        np.add.at(arcs, at, total.astype(np.int64))
        np.add.at(number, at, n.astype(np.int64))
    out, at = [], 0
    for (part, block, _), (k, _) in zip(rows, read):
        mine = own[at : at + len(k)]
        at += len(k)
        body = _pack(count[mine].astype("<u8"), arcs[mine].astype("<u8"), number[mine].astype("<u4"))
        out.append((part, block, WORDS, body))
    real = (keys != BEGIN) & (count > 0)
    totals = (rows[0][0], -1, TOTALS, b"", int(count[real].sum()), int(real.sum()))
    return _table([*[(*row, 0, 0) for row in out], totals], ("tokens", "words"))


class Automaton:
    """The smoothed model of one block's words and pairs.

    A state for each word (the context) with arcs for the pairs that were
    kept; a failure arc leads from each state to the root, whose arcs are the
    words.  Weights are log10: an arc's is the pair's interpolated
    probability, a failure arc's the weight that the discount left over, so
    the probabilities behind every state add up to one.
    """

    def __init__(self, found: Block, answers: pa.Table, parts: int, tokens: int, words: int, how: Smoothing):
        self.count, arcs, number = np.zeros((3, len(found.key)), np.int64)
        order, part = found.word_parts(parts)
        spans = {p: (a, b) for p, a, b in _runs(part)}
        for p, _, body in _rows(answers, WORDS):
            a, b = spans[p]
            at = order[a:b]
            self.count[at], arcs[at], number[at] = _unpack(body, "<u8", "<u8", "<u4")
        pairs = np.zeros(len(found.first), np.int64)
        order, part = found.pair_parts(parts)
        spans = {p: (a, b) for p, a, b in _runs(part)}
        for p, _, body in _rows(answers, PAIRS):
            a, b = spans[p]
            has, small, large = _unpack(body, "u1", "u1", "<u4")
            pairs[order[a:b][np.unpackbits(has, count=b - a).astype(bool)]] = _read_counts(small, large)
        seen = np.maximum(self.count, 1)
        root = np.where(self.count > 0, (self.count - how.word) / max(tokens, 1), how.word * words / tokens if tokens else 1.0)
        left = np.where(self.count > 0, 1 - (arcs - how.pair * number) / seen, 1.0)
        self.root, self.failure = np.log10(root), np.log10(left)
        with np.errstate(divide="ignore"):
            own = np.maximum(pairs - how.pair, 0) / seen[found.first]
            self.arc = np.log10(own + left[found.first] * root[found.second])
        self.has_arc = pairs > 0

    def traverse(self, found: Block) -> np.ndarray:
        """The log10 probability of each text, read from left to right.

        The state is the word before; where it has an arc for the next word
        the arc's weight is taken, else that of the failure arc and of the
        root's arc.  Either way the next state is the word read.
        """
        backed_off = self.failure[found.before] + self.root[found.word]
        step = np.where(self.has_arc[found.pair], self.arc[found.pair], backed_off)
        return np.add.reduceat(step, found.starts)


def score(docs: DataFrame, learn: Column, how: Smoothing = Smoothing()) -> DataFrame:
    """One row per document: doc_id, learned, n_tokens, n_known, train_tokens, base_score, score.

    Words are runs of other than blanks, A-Z in lower case; a text ends with
    an end token.  The model learns from all documents for which ``learn`` (a
    condition on doc_id) holds.  base_score is the log10 probability under
    words alone with ``added`` counts, score that of the automaton.

    Documents are dealt into blocks.  Each block tells the parts of the model
    which words and pairs it has and how often it learned from them, in
    arrays; the parts add them up and answer with the counts of just those;
    then the block builds its automaton and reads its texts.  So counts cover
    the whole corpus, nothing grows with the corpus in one place, and a
    frequent word's pairs are spread over all parts.  Words are told apart by
    64 bits of hash, the second word of a pair by 48 of them.

    Null texts count as empty: the end token alone.  For null doc_ids
    ``learn`` decides; repeated rows are documents like any other.  Without
    a document to learn from, all words share the one unknown word's
    probability.  An empty table gives no rows; further columns are ignored.
    """
    rows = pick(docs, doc_id="long", text="string")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, parts = max(1, ceil(size / BLOCK_BYTES)), max(1, ceil(size / PART_BYTES))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))
    rows = rows.select(block.alias("block"), "doc_id", "text", F.coalesce(learn, F.lit(False)).alias("learned"))
    rows = rows.mapInArrow(_deal, "block long, documents binary")

    def tell(table: pa.Table) -> pa.Table:
        return gather(table.column("block")[0].as_py(), _block(_documents(table)), parts)

    def add_pairs(table: pa.Table) -> pa.Table:
        return sum_pairs(table, parts, how)

    def add_words(asked: pa.Table, contexts: pa.Table) -> pa.Table:
        return sum_words(asked, contexts)

    told = rows.groupBy("block").applyInArrow(tell, _ROW)
    pairs = told.groupBy("part").applyInArrow(add_pairs, _ROW)
    contexts = pairs.filter(F.col("kind") == CONTEXTS)
    words = told.groupBy("part").cogroup(contexts.groupBy("part")).applyInArrow(
        add_words, _ROW + ", tokens long, words long"
    )
    total = F.struct(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"))
    totals = words.filter(F.col("kind") == TOTALS).agg(total).scalar()
    answers = words.filter(F.col("kind") == WORDS).drop("tokens", "words").unionByName(pairs.filter(F.col("kind") == PAIRS))
    answers = answers.select("*", totals["tokens"].alias("tokens"), totals["words"].alias("words"))

    def read(texts: pa.Table, answered: pa.Table) -> pa.Table:
        texts = _documents(texts)
        found = _block(texts)
        tokens, n_words = (answered.column(n)[0].as_py() for n in ("tokens", "words"))
        automaton = Automaton(found, answered, parts, tokens, n_words, how)
        known = automaton.count[found.word]
        base = np.log10(known + how.added) - np.log10(tokens + how.added * (n_words + 1))
        return pa.table({
            "doc_id": texts.column("doc_id"),
            "learned": texts.column("learned"),
            "n_tokens": found.sizes.astype(np.int64),
            "n_known": np.add.reduceat((known > 0).astype(np.int64), found.starts),
            "train_tokens": np.full(len(found.sizes), tokens, np.int64),
            "base_score": np.add.reduceat(base, found.starts),
            "score": automaton.traverse(found),
        })

    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        read,
        "doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each block in a batch as one compressed value: half of what is shuffled otherwise."""
    how = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        order = np.argsort(blocks, kind="stable")
        out = []
        for block, a, b in _runs(blocks[order]):
            sink = pa.BufferOutputStream()
            part = batch.take(pa.array(order[a:b]))
            with pa.ipc.new_stream(sink, part.schema, options=how) as writer:
                writer.write_batch(part)
            out.append((block, sink.getvalue().to_pybytes()))
        if out:
            block, documents = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(documents, pa.binary())], ["block", "documents"])


def _documents(table: pa.Table) -> pa.Table:
    """The documents of a block; their order doesn't matter."""
    return pa.concat_tables([pa.ipc.open_stream(d.as_buffer()).read_all() for d in table.column("documents")])


def _block(table: pa.Table) -> Block:
    return Block(table.column("text").combine_chunks(), table.column("learned").to_numpy().astype(bool))
