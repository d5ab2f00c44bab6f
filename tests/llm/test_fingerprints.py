"""Paragraph sketches against sets of paragraphs, and neighbours against a sorted list."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fathom.llm import fingerprints, queries
from fathom.llm.common import hash128
from tests.llm.helpers import LONG, documents, nothing

BLANKS = " \t\n\x0b\x0c\r"


def plain_paragraphs(text):
    return set(collections.Counter(p for p in text.split("\n") if p.strip(BLANKS)).items())


def plain_likeness(a, b):
    a, b = plain_paragraphs(a), plain_paragraphs(b)
    return 1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0


def sets(spark, seed):
    """Pairs of digest sets of many sizes: equal, disjoint, one in the other, empty."""
    rng = random.Random(seed)
    rows = [([], []), ([5], [5]), ([5], []), ([], [-5])]
    for n in (1, 3, 20, 150, 700, 3000):
        a = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(n)]
        b = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(n)]
        rows += [(a, a[::-1]), (a, b), (a, a[: n // 2]), (a[: n // 3], a + b), (a, a[:-1] + b[:1])]
    return rows, spark.createDataFrame(rows, "a array<long>, b array<long>").repartition(4)


@pytest.mark.parametrize("cells", [64, 2])
def test_peeling_recovers_the_difference(spark, monkeypatch, cells):
    monkeypatch.setattr(fingerprints, "CELLS", cells)
    rows, df = sets(spark, cells)
    got = df.select("a", "b", fingerprints.difference(F.col("a"), F.col("b")).alias("d")).collect()
    assert len(got) == len(rows)
    for a, b, d in got:
        assert (sorted(d.plus), sorted(d.minus)) == (sorted(set(a) - set(b)), sorted(set(b) - set(a)))
        assert d.tries < fingerprints.TRIES  # never by comparing sets
    assert max(d.tries for _, _, d in got) > 1 and min(d.tries for _, _, d in got) == 1


def test_sketches_too_small_for_any_try(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "CELLS", 1)
    monkeypatch.setattr(fingerprints, "TRIES", 3)
    _, df = sets(spark, 3)
    for a, b, d in df.select("a", "b", fingerprints.difference(F.col("a"), F.col("b")).alias("d")).collect():
        assert (set(d.plus), set(d.minus)) == (set(a) - set(b), set(b) - set(a))


def test_equal_sets_leave_no_cell_and_small_differences_few(spark):
    a = list(range(500))
    df = spark.createDataFrame([(a, a[::-1]), (a, a[3:])], "a array<long>, b array<long>")
    left = fingerprints.subtract(fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b")))
    none, few = sorted((r.s for r in df.select(left.alias("s")).collect()), key=len)
    assert none == [] and 3 <= len(few) <= 9 and sum(c.n for c in few) == 9


def test_numbers_of_a_paragraph_count(spark):
    texts = ["a\nb\na", "b\na\na", "a\nb", "a\n \nb\n\n", "", " \n\t"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    print_of = dict(df.select("i", fingerprints.fingerprint(fingerprints.paragraphs(F.col("t")))).collect())
    assert print_of[0] == print_of[1] and print_of[2] == print_of[3] and print_of[4] == print_of[5]
    assert len(set(print_of.values())) == 3 and all(len(p) == 32 for p in print_of.values())


def plain_next(spark, rows):
    """Counter of (doc_id, text, next): by descending doc_id (null last), then the texts' hashes."""
    texts = spark.createDataFrame([(t,) for t in {t or "" for _, t in rows}], "t string")
    h = {t: (a, b) for t, a, b in texts.select("t", *hash128(F.col("t"))).collect()}
    up = sorted(((i is not None, i or 0, h[t or ""], i, t or "") for i, t in rows))
    down = [(i, t) for *_, i, t in up][::-1]
    return collections.Counter((i, t, down[(k + 1) % len(down)][1]) for k, (i, t) in enumerate(down))


@pytest.mark.parametrize("rows", [
    [(1, "one")], [(1, "same")] * 7, [(1, None), (1, ""), (None, "x"), (None, "x"), (2, "y")],
    [(i, f"t{i % 40}") for i in range(900)] + [(7, f"u{i}") for i in range(500)] + [(8, "hot")] * 9000 + [(None, "n")] * 5,
])
def test_neighbours_by_sorting(spark, monkeypatch, rows):
    monkeypatch.setattr(fingerprints, "NEIGHBOURS", 32)
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    found = fingerprints.copies(fingerprints.with_next(docs), "copies")
    assert collections.Counter(tuple(r) for r in found.collect()) == plain_next(spark, rows)


@pytest.mark.parametrize("source", ["sf0.001", "odd"])
def test_query_by_brute_force(spark, monkeypatch, source):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    if source == "odd":
        docs = documents(spark)
        monkeypatch.setattr(queries, "_table", lambda *_: docs)
    rows = [(r[0], r[1]) for r in docs.collect()]
    want = collections.Counter()
    of = {}
    for (doc_id, text, after), n in plain_next(spark, rows).items():
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        want[doc_id, len(text), sha, round(plain_likeness(text, edited), 9), round(plain_likeness(text, after), 9)] += n
        of[doc_id] = text
    got = queries.op11_fingerprints(spark, sf).collect()
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want
    by_text = collections.defaultdict(set)
    for r in got:
        by_text[frozenset(plain_paragraphs(of[r.doc_id]))].add(r.fingerprint)
    assert all(len(p) == 1 for p in by_text.values()) and len(set.union(*by_text.values())) == len(by_text)
    for r in got:
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1)


def test_long_texts_and_empty_tables(spark):
    text = "\n".join(f"{i} {LONG[:50]}" for i in range(20_000))
    rows = spark.createDataFrame([(text, text[: len(text) // 2], None)], "text string, edited string, next string")
    r = fingerprints.compare(rows).first()
    only = plain_paragraphs(text) - plain_paragraphs(text[: len(text) // 2])
    assert len(r.from_edited.plus) == len(only) > 9000 and r.from_edited.tries > 3 and r.near_next is None
    assert fingerprints.with_next(nothing(spark)).count() == 0
    assert fingerprints.compare(rows.limit(0)).count() == 0
