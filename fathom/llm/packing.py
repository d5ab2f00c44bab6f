"""Packing by powers of two: no sequence crosses documents and none needs padding."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm.chunks import BYTE_LEVEL, by_bytes, default_path, distinct_chunks, ragged, tokenizer_file
from fathom.llm.common import pick

MAX_LENGTH = 1024
END_ID = 0
#: Chunks that are encoded in one call.
JOINED = 20_000
#: Characters that go to ``tokenizers``; the classes of all others are the same in all Unicode versions in use.
_UNSURE = "[^\\x00-\\x7f\\x{c0}-\\x{24f}]"
#: Chunks that only stand at texts' beginnings; behind another chunk they might join it.
_FIRST = "^([\\x00-\\x20]|$)"


def binary_lengths(n: int, most: int) -> list[int]:
    """``n`` as powers of two, ``most`` at most, in falling order."""
    out = [most] * (n // most)
    rest = n % most
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    """Ids of whole texts, equal to ``tokenizers``' for a byte-level BPE file.

    A batch's distinct chunks are encoded once.  Those of ASCII and Latin
    letters without an added token's string are joined and go through the
    same merges as ranks (``tiktoken``, several times faster); where one
    chunk's ids end is seen from the bytes they stand for.  All others go
    through ``tokenizers`` itself, as do all texts if the file's merges are
    not in the order of its ids.
    """

    def __init__(self, spec: bytes):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_str(spec.decode())
        model = json.loads(spec)
        self.added = [t["content"] for t in model.get("added_tokens", [])]
        self.whole = any(" " in a for a in self.added)
        self.fast = self._ranked(model["model"])

    def _ranked(self, model: dict):
        import public_tokenizers
        import tiktoken

        alphabet, vocab = _byte_alphabet(), model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = [vocab.get(a + b) for a, b in merges]
        if None in ids or ids != sorted(set(ids)):
            return None
        names = [c for c in vocab if len(c) == 1 and c in alphabet] + [a + b for a, b in merges]
        ranks = {bytes(alphabet[c] for c in name): vocab[name] for name in names}
        self.n_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.n_bytes[rank] = len(token)
        return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _slow(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self.full.encode(t, add_special_tokens=False).ids for t in texts]
        return np.array([i for x in ids for i in x], "<u4"), np.array([len(x) for x in ids], np.int64)

    def _quick(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids and how many each chunk has, with the blank before it."""
        ids, sizes = [], []
        for i in range(0, len(chunks), JOINED):
            part = chunks[i : i + JOINED]
            found = np.array(self.fast.encode_ordinary(" " + " ".join(part.to_pylist())), "<u4")
            ends = np.cumsum(pc.binary_length(part).to_numpy() + 1)
            at = np.searchsorted(np.cumsum(self.n_bytes[found]), ends) + 1
            ids.append(found)
            sizes.append(np.diff(at, prepend=0))
        return np.concatenate(ids or [np.zeros(0, "<u4")]), np.concatenate(sizes or [np.zeros(0, np.int64)])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of all texts, and where each text's begin."""
        if self.whole or not self.fast:
            ids, sizes = self._slow([t or "" for t in texts.to_pylist()])
            return ids, np.concatenate([[0], np.cumsum(sizes)])
        chunks, index, offsets = distinct_chunks(texts, BYTE_LEVEL)
        odd = pc.match_substring_regex(chunks, _UNSURE).to_numpy(zero_copy_only=False)
        odd |= pc.match_substring_regex(chunks, _FIRST).to_numpy(zero_copy_only=False)
        for a in self.added:
            odd |= pc.match_substring(chunks, a).to_numpy(zero_copy_only=False)
        # In this order: chunks for the quick way, other chunks, first chunks (no blank before them).
        heads = index[offsets[:-1]]
        parts = (
            self._quick(chunks.filter(pa.array(~odd))),
            self._slow([" " + c for c in chunks.filter(pa.array(odd)).to_pylist()]),
            self._slow(chunks.take(pa.array(heads)).to_pylist()),
        )
        ids, sizes = (np.concatenate(x) for x in zip(*parts))
        starts = np.cumsum(sizes) - sizes
        place = np.empty(len(chunks), np.int64)
        place[np.argsort(odd, kind="stable")] = np.arange(len(chunks))
        at = place[index]
        at[offsets[:-1]] = len(chunks) + np.arange(len(heads))
        per_chunk = sizes[at]
        ends = np.concatenate([[0], np.cumsum(per_chunk)])
        return ids[ragged(starts[at], per_chunk)], ends[offsets]


def pieces(docs: DataFrame, path: str | None = None, max_length: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset, bucket.

    A document's ids (``tokenizers`` on the whole text, no special tokens,
    then ``end_id``) are cut into pieces whose lengths are its count in
    powers of two, ``max_length`` at most.  Each piece is a sequence of its
    own: it crosses no document, and as its length is a power of two it needs
    no padding.  ``bucket`` is that power: batches are made of one bucket's
    sequences (``write_buckets``).  ids are unsigned 32-bit integers,
    little-endian.  sequence_id is unique, in the order of the scan; offset
    is 0.

    Null and empty texts have one id, the end.  Null doc_ids and repeated
    rows are documents like any other.  An empty table gives no rows; further
    columns are ignored.  Texts are encoded by their distinct chunks, a batch
    of bounded bytes (or one text) at a time.
    """
    if max_length & (max_length - 1) or max_length < 1:
        raise ValueError("max_length must be a power of two")
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(tokenizer_file(path or default_path("byte_bpe_50k.json")))
    end = array("I", [end_id]).tobytes()
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long"
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    arrow = pa.schema(list(zip(("doc_id", "start", "length", "ids", "doc_tokens"), kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for whole in batches:
            encode = encode or Encoder(spec.value)
            for batch in by_bytes(whole, 1):
                ids, offsets = encode(batch.column(1))
                out = []
                for doc_id, a, b in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    own, total, start = ids[a:b].tobytes() + end, b - a + 1, 0
                    for n in binary_lengths(total, max_length):
                        out.append((doc_id, start, n, own[4 * start : 4 * (start + n)], total))
                        start += n
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], schema=arrow)

    cut = pick(docs, doc_id="long", text="string").mapInArrow(run, schema)
    return cut.select(
        "*",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
    )


def write_buckets(packed: DataFrame, folder: str) -> None:
    """Sequences as Parquet, one folder for each length: what a loader batches together."""
    packed.write.partitionBy("bucket").parquet(folder)
