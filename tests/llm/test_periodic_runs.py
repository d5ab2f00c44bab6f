"""Periodic runs against their definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.llm import periodic_runs, queries
from fathom.llm.common import pick
from tests.llm.helpers import LONG, documents, nothing


def plain_runs(words, least=12):
    """{(start, length): smallest period}, by comparing words each period apart."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                found.setdefault((start, i - start + q), q)
    return found


def some_words(rng):
    words = [rng.randrange(rng.choice([1, 2, 2, 3, 30])) for _ in range(rng.randint(0, 70))]
    if words and rng.random() < 0.6:
        a, p = rng.randrange(len(words)), rng.randint(1, 8)
        words = [words[a + (i - a) % p] if i >= a and a + p <= len(words) else w for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("least", [12, 5, 2])
def test_runs_by_brute_force(least):
    rng = random.Random(least)
    for _ in range(200):
        docs = [some_words(rng) for _ in range(rng.randint(1, 5))]
        codes = np.array([w for d in docs for w in d], np.int32)
        got = periodic_runs.find_runs(codes, np.cumsum([len(d) for d in docs]), least)
        assert got == [plain_runs(d, least) for d in docs]


def test_words_rich_in_runs():
    """Fibonacci words hold runs of very many periods, Thue-Morse words none of exponent above 2."""
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert periodic_runs.find_runs(np.array(b, np.int32), np.array([len(b)])) == [plain_runs(b)]
    morse = [i.bit_count() % 2 for i in range(512)]
    assert periodic_runs.find_runs(np.array(morse, np.int32), np.array([512])) == [plain_runs(morse)]


@pytest.mark.parametrize("words, want", [
    ([0] * 60_000, {(0, 60_000): 1}),
    ([i % 1000 for i in range(50_000)], {(0, 50_000): 1000}),
    ([0, 1] * 10_000 + [2] + [0] * 5000, {(0, 20_000): 2, (20_001, 5000): 1}),
])
def test_long_repeats(words, want):
    assert periodic_runs.find_runs(np.array(words, np.int32), np.array([len(words)])) == [want]


def test_odd_documents(spark):
    rows = periodic_runs.runs(documents(spark)).collect()
    assert len(rows) == 13
    by_id = {r.doc_id: r for r in rows}
    assert all(r.runs == [] for r in rows if r.doc_id != 9)
    assert (by_id[1].n_words, by_id[1].collapsed) == (by_id[2].n_words, by_id[2].collapsed) == (0, "")
    assert by_id[7].collapsed == "The quick brown fox jumps over the lazy dog"
    assert [tuple(r) for r in by_id[9].runs] == [(0, LONG.count("wort"), 1)] and by_id[9].collapsed == "wort ende"
    assert periodic_runs.runs(nothing(spark)).count() == 0


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    with_runs = 0
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 1200:
            continue  # the definition takes too long
        found = sorted(((s, k, p) for (s, k), p in plain_runs(words).items()), key=lambda r: (r[0], r[2]))
        gone = {i for s, k, p in found for i in range(s + p, s + k)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if found else None
        listed = "".join(f"{s},{k},{p}\n" for s, k, p in found)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert got[doc_id] == (len(found), *best, milli, sha(listed), sha(kept))
        with_runs += bool(found)
    assert len(got) == len(docs) and with_runs > 5


def test_planted_repeats_of_odd_documents(spark):
    """Ids whose hash plants a repeat: a null id counts as the empty text, hash 0."""
    docs = documents(spark, ["a b c d e f", None, "", "x"], [None, None, None, None])
    docs = pick(docs, doc_id="long", text="string")
    rows = docs.select(queries.with_repeats(F.col("doc_id"), F.col("text")).alias("t")).collect()
    assert sorted(map(str, (r.t for r in rows))) == ["", "None", "a b c a b c", "x"]
