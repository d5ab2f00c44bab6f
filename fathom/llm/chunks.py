"""Texts as chunks that tokenizers treat independently, a whole batch at a time."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Where a text may be cut, and which texts may not simply be cut at each blank.
#: Byte-level patterns never match across the left side of a blank before a
#: visible character; sentence pieces never go on behind a visible character
#: with a blank, but runs of blanks (also with the one put before a text) join.
BYTE_LEVEL = (re.compile(r" (?=\S)"), re.compile(r" (?:\s|\Z)"))
PIECES = (re.compile(r"(?<=[^ ]) "), re.compile(r"(?:\A| ) "))


def distinct_chunks(
    texts: pa.Array, rule: tuple[re.Pattern, re.Pattern]
) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(chunks, index, offsets): distinct chunks, each text's chunks as indices, where a text begins.

    A text's chunks, each but the first with one blank before it, are the
    text again.  Nulls count as empty texts, which are one empty chunk.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    odd = [i for i, t in enumerate(texts.to_pylist()) if rule[1].search(t)]
    if odd:
        rest = np.setdiff1d(np.arange(len(texts)), odd)
        lists = pa.concat_arrays([
            pc.split_pattern(texts.take(pa.array(rest)), " "),
            pa.array([rule[0].split(texts[i].as_py()) for i in odd], pa.list_(pa.string())),
        ]).take(pa.array(np.argsort(np.concatenate([rest, odd]), kind="stable")))
    else:
        lists = pc.split_pattern(texts, " ")
    coded = lists.flatten().dictionary_encode()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return coded.dictionary, coded.indices.to_numpy(), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def by_bytes(batch: pa.RecordBatch, column: int, most: int = 12 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes in a text column, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i] + 1, ... (sizes[i] of them) for all i, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


@lru_cache(maxsize=8)
def tokenizer_file(path: str) -> bytes:
    """A vocabulary file, read on the driver and shipped by broadcast (fixed size)."""
    with open(path, "rb") as f:
        return f.read()


def default_path(name: str) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
