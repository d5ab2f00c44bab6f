"""Operators over the whole corpus: scores, shards, searches, embeddings, components, pipeline."""

import collections
import math
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.llm import components as cc
from fathom.llm import embedding_dedup, language_model, sharding, topk
from fathom.llm.common import id_crc32
from tests.llm.helpers import components, crc, documents, nothing, random_texts

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


# ------------------------------------------------------------------ language model
def plain_scores(rows, how):
    """doc_id -> (n_tokens, n_known, N, base_score, score), from the definition."""
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    learned = [ts for i, ts in tokens if crc(i) % 10]
    count = collections.Counter(w for ts in learned for w in ts)
    n, v = sum(count.values()), len(count)
    pairs = collections.Counter(p for ts in learned for p in zip(["^"] + ts, ts))
    contexts = count + collections.Counter({"^": len(learned)})
    arcs, number = collections.Counter(), collections.Counter()
    for (h, _), c in pairs.items():
        if c >= how.cutoff:
            arcs[h] += c
            number[h] += 1

    def root(w):
        return (count[w] - how.word) / n if count[w] else how.word * v / n if n else 1.0

    def step(h, w):
        if not contexts[h]:
            return root(w)
        left = 1 - (arcs[h] - how.pair * number[h]) / contexts[h]
        kept = pairs[h, w] - how.pair if pairs[h, w] >= how.cutoff else 0
        return kept / contexts[h] + left * root(w)

    out = []
    for i, ts in tokens:
        base = sum(math.log10((count[w] + how.added) / (n + how.added * (v + 1))) for w in ts)
        score = sum(math.log10(step(h, w)) for h, w in zip(["^"] + ts, ts))
        out.append((i, len(ts), sum(count[w] > 0 for w in ts), n, base, score))
    return out, (count, v, root, step)


@pytest.mark.parametrize("block, cutoff", [(1 << 24, 1), (2000, 1), (2000, 2)])
def test_scores_by_brute_force(spark, monkeypatch, block, cutoff):
    monkeypatch.setattr(language_model, "BLOCK_BYTES", block)
    monkeypatch.setattr(language_model, "PART_BYTES", max(500, block // 10))
    texts = [t.replace("\xa0", " ") for t in random_texts(80, 9, words=80)] + [None, "", " \n", "The THE the", "x " * 3000, " lead", "lead "]
    ids = [*range(len(texts) - 3), 5, 5, None]
    how = language_model.Smoothing(cutoff=cutoff)
    got = language_model.score(documents(spark, texts, ids), id_crc32(F.col("doc_id")) % 10 != 0, how).collect()
    want, _ = plain_scores(list(zip(ids, texts)), how)
    key = lambda r: (r[0] is None, r[0], r[1], round(r[4], 6))
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=key)):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9) and math.isclose(a[5], b[5], rel_tol=1e-9)


def test_counts_of_any_size_travel():
    count = np.array([0, 1, 254, 255, 256, 70_000, 3, 255])
    assert language_model._read_counts(*language_model._counts(count)).tolist() == count.tolist()


def test_pairs_seen_once_are_known(spark):
    """Copies of learned texts score far above their words alone, though no pair occurs twice."""
    rng = random.Random(4)
    texts = [" ".join(rng.sample([f"w{i}" for i in range(400)], 30)) for _ in range(60)]
    learned = [i for i in range(2000) if crc(i) % 10][:60]
    copies = [i for i in range(2000) if not crc(i) % 10][:20]
    docs = documents(spark, texts + texts[:20] + [" ".join(rng.sample(t.split(), 30)) for t in texts[:20]], [*learned, *copies, *[-i for i in range(20)]])
    rows = language_model.score(docs, F.col("doc_id").isin(learned)).collect()
    gain = {r.doc_id: r.score - r.base_score for r in rows}
    assert min(gain[i] for i in copies) > max(gain[-i] for i in range(1, 20)) + 10


def test_probabilities_behind_a_state_add_up_to_one():
    rows = [(i, t) for i, t in enumerate(random_texts(50, 10))]
    _, (count, _, root, step) = plain_scores(rows, language_model.Smoothing())
    for h in ["^", b"the", b"of", b"never seen"]:
        assert math.isclose(sum(step(h, w) for w in count) + step(h, b"unknown word"), 1, rel_tol=1e-9)


def test_scores_without_anything_to_learn_from(spark):
    docs = documents(spark, ["a b", None])
    rows = language_model.score(docs, F.lit(False)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in rows} == {(0, 3, 0, 0), (1, 1, 0, 0)}
    assert all(r.score == 0 and r.base_score == 0 for r in rows)
    assert language_model.score(nothing(spark), F.lit(True)).count() == 0


def test_model_beats_words_alone_on_held_out_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_model.score(table, id_crc32(F.col("doc_id")) % 10 != 0).filter("not learned").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


# ------------------------------------------------------------------ shards
@pytest.mark.parametrize("texts", [
    ["same"] * 500 + [f"t{i}" for i in range(300)] + ["pair"] * 2 + [None, ""],
    ["same"] * 97,
    [f"t{i}" for i in range(7)],
    [f"g{i % 60}" for i in range(600)],
])
def test_shards_are_even_and_keep_copies_together(spark, texts):
    docs = documents(spark, texts)
    rows = sharding.assign(docs, shards=8).collect()
    assert len(rows) == len(texts)
    slots = collections.defaultdict(list)
    spread = collections.defaultdict(collections.Counter)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.size == len(text.encode()) + 16 and r.text_crc32 == zlib.crc32(text.encode())
        slots[r.shard].append(r.slot)
        spread[text][r.shard] += 1
    counts = [len(slots[s]) for s in range(8)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    small = [c for c in spread.values() if 1 < sum(c.values()) <= len(texts) // 32]
    together = sum(max(c.values()) for c in small)
    # Without single documents to make room, not all groups find a place of their own.
    assert together >= (0.98 if len(spread) > 100 else 0.5) * sum(sum(c.values()) for c in small)


def test_shards_of_odd_tables(spark):
    assert sharding.assign(nothing(spark), shards=4).count() == 0
    rows = sharding.assign(documents(spark), shards=4).collect()
    assert sorted(collections.Counter(r.shard for r in rows).values()) == [3, 3, 3, 4]
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)


# ------------------------------------------------------------------ exact search
def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<float>, label int, LABEL string, n_links int"
    )


@pytest.mark.parametrize("block", [4096, 16])
def test_top_k_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "LEAF", 4)
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 8))
    points = [(centers[i % 6] + 0.2 * rng.normal(size=8)).astype(np.float32).tolist() for i in range(300)]
    rows = [(i, v, 0) for i, v in enumerate(points)]
    rows += [(300, points[0], 1), (301, points[0], 1), (302, [0.0] * 8, 1), (350, [0.0] * 8, 0), (400, [1.0, 2.0], 0), (401, [3.0, 4.0], 0)]
    rows += [(500, None, 0), (550, [1.0, None], 0), (600, [float("nan")] * 8, 0), (650, [float("inf")] * 8, 0), (700, [], 0), (None, points[1], 0)]
    rows.append(rows[5])
    got = topk.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0, k=5).collect()
    able = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in able if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(able[q], v)), i) for i, v in able.items() if i != q and len(v) == len(able[q]))
        want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1)}
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == want and len(got) == len(want)


def test_top_k_of_large_components_is_exact(spark):
    rows = [(0, [2.0**20, 1.0], 0), (1, [2.0**20, 3.0], 0), (2, [2.0**20, -3.0], 0), (3, [-(2.0**20), 0.5], 0)]
    got = topk.top_k(vectors(spark, rows), F.col("vec_id") == 0, k=2).collect()
    score = lambda v: sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(rows[0][1], v))
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1, score(rows[1][1])), (2, 2, score(rows[2][1]))]


def test_top_k_of_nothing(spark):
    assert topk.top_k(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(vectors(spark, [(50, [1.0], 0)]), F.col("vec_id") % 50 == 0).count() == 0


def test_cover_trees_cover_and_hold_every_point():
    points = np.random.default_rng(1).normal(size=(500, 3))
    points[100:200] = points[0]
    tree, seen, todo = topk.CoverTree(points), [], None
    todo = [tree.root]
    while todo:
        node = todo.pop()
        far = np.linalg.norm(points[node.members] - points[node.center], axis=1)
        assert far.max() <= node.radius + 1e-9
        todo += node.children
        if not node.children:
            seen += node.members.tolist()
    assert sorted(seen) == list(range(500))


# ------------------------------------------------------------------ embeddings
def test_e8_decodes_to_the_nearest_point():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8)) * 2
    found = embedding_dedup.decode_e8(x)
    assert len({tuple(v) for v in embedding_dedup.NEIGHBOURS}) == 240
    assert ((found % 2 == found[:, :1] % 2).all(axis=1)).all() and (found.sum(axis=1) % 4 == 0).all()
    near = ((x[:, None] - (found[:, None] + embedding_dedup.NEIGHBOURS) / 2) ** 2).sum(axis=2).min(axis=1)
    assert (((x - found / 2) ** 2).sum(axis=1) <= near + 1e-12).all()


def near_pairs(seed, n=150, dim=64, cosine=0.94):
    """n random unit vectors, each with a partner at the cosine."""
    rng = np.random.default_rng(seed)
    x = embedding_dedup.unit_rows(rng.normal(size=(n, dim)))
    off = rng.normal(size=(n, dim))
    off = embedding_dedup.unit_rows(off - (off * x).sum(axis=1, keepdims=True) * x)
    return np.concatenate([x, cosine * x + math.sqrt(1 - cosine**2) * off])


@pytest.mark.parametrize("block", [1024, 8])
def test_links_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(6)
    x = near_pairs(1).astype(np.float32)
    crowd = (x[0] + 0.01 * rng.normal(size=(60, 64))).astype(np.float32)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(np.concatenate([x, crowd]))]
    rows += [(1000, x[0].tolist(), 0), (1001, (3 * x[0]).tolist(), 0), (1002, x[0].tolist(), None)]
    rows += [(1003, None, 0), (1004, [0.0] * 64, 0), (1005, [float("nan")] * 64, 0), (1006, [None], 0), (1007, [], 0), (1008, [1.0, 0.0], 0), (1009, [1.0, 0.1], 0)]
    v = {}
    for i, e, label in rows:
        if label is not None and e and all(c is not None and math.isfinite(c) for c in e) and any(e):
            v[i] = (label, np.array(e, np.float64) / np.linalg.norm(np.array(e, np.float64)))
    ids = [i for i, _, _ in rows]

    def linked(a, b):
        a, b = ids[a], ids[b]
        if a not in v or b not in v or v[a][0] != v[b][0] or len(v[a][1]) != len(v[b][1]):
            return False
        return float(v[a][1] @ v[b][1]) >= 0.93

    want = components(len(ids), linked)
    degree = [sum(linked(a, b) for b in range(len(ids)) if a != b) for a in range(len(ids))]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors(spark, rows), cosine=0.93).collect()}
    assert len(got) == len(rows)
    for at, i in enumerate(ids):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (degree[at], ids[want[at]], ids[want[at]] == i), i


@pytest.mark.parametrize("dim", [8, 16, 64, 384])
def test_recall_at_the_threshold(spark, dim):
    x = near_pairs(2, n=750, dim=dim, cosine=0.931)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    links = (x @ x.T >= 0.93).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(table).collect()}
    assert all(got[i] <= links[i] for i in got)
    assert sum(got.values()) >= 0.99 * links.sum()


@pytest.mark.parametrize("cosine", [0.5, 0.8, 0.99])
def test_recall_holds_at_other_thresholds(cosine):
    x = near_pairs(4, n=2000, dim=32, cosine=cosine + 0.001)
    lattice = embedding_dedup.Lattice(
        32, cosine, embedding_dedup.TABLES, embedding_dedup.PROBES, embedding_dedup.SCALE, embedding_dedup.SEED
    )
    met = np.zeros(2000, bool)
    for t in range(embedding_dedup.TABLES):
        own, probed = lattice.cells(t, x)
        a, b = own[:2000], own[2000:]
        met |= (a == b) | (probed[:2000] == b[:, None]).any(axis=1) | (probed[2000:] == a[:, None]).any(axis=1)
    assert met.mean() >= 0.99


def test_links_of_nothing(spark):
    assert embedding_dedup.near_duplicates(vectors(spark, [])).count() == 0


# ------------------------------------------------------------------ components
def test_components_of_random_graphs_and_a_hub(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000, i) for i in range(1001, 1400)] + [(i, i + 1) for i in range(2000, 2060)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in cc.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if None not in (a, b) and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root}
    assert cc.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


# ------------------------------------------------------------------ pipeline and registration
def test_pipeline_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline
    from fathom.llm.common import cut

    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame(
        [(9001, None, "en", "s", 0), (9002, "1234 !?", "en", "s", 7), (9003, "", "en", "s", 0)], table.schema
    )
    docs = table.unionByName(extra)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, before, sf), "test-stage")
        assert docs.columns == table.columns
        if name == "language_id":
            assert {r.doc_id for r in before.join(docs, "doc_id", "left_anti").collect()} == {9001, 9002, 9003}
        if name == "line_dedup":
            assert docs.count() == before.count() and docs.filter("n_chars <> char_length(text)").isEmpty()
        if name == "simhash_dedup":
            from fathom.llm import simhash

            want = {r.component_id for r in simhash.near_duplicates(before).collect()}
            assert {r.doc_id for r in docs.select("doc_id").collect()} == want
        before = docs
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("rows", [
    [],
    [(1, None, None, None, None), (None, "12 !?", None, "s", 1), (3, "", "en", "s", 0)],
    [(1, "one line of a text that is told twice", None, "s", 1), (2, "one line of a text that is told twice", "en", "s", 1),
     (None, "a text of nobody", "en", None, None), (None, "x" * 40_000, "en", "s", 1), (7, None, "en", "s", 0)],
])
def test_pipeline_runs_on_odd_and_empty_tables(spark, tmp_path, rows):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, start long"
    case = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        table = spark.createDataFrame([(*r, "other", 5) for r in rows], schema)
        table.write.parquet(f"{tmp_path}/documents.parquet")
        packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.caseSensitive", case)
    want = {1, None} if len(rows) == 5 else set()
    assert {r.doc_id for r in packed} == want
    assert all(r.length > 0 and r.length & (r.length - 1) == 0 and r.length <= 1024 for r in packed)


def test_all_queries_are_registered_without_a_session():
    code = "import __spark_entry__ as e; print(*sorted(k for k in e.queries() if k.startswith('op') or k == 'pipeline'))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    names = {n.split("_")[0] for n in done.stdout.split()}
    assert names == {"pipeline"} | {f"op{n}" for n in range(1, 14)}, done.stderr[-500:]
