"""Operators that read texts one by one: packing, token counts, BPE, language, near-duplicates, lines."""

import base64
import collections
import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fathom.llm import bpe, language, line_dedup, packing, simhash, token_counts
from tests.llm.helpers import components, crc, documents, nothing, random_texts

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = public_tokenizers.path
ODD = list(" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　abcXYZ012'.,!$#éßñ日本​\U0001f600ǅª²½▁\x00") + [
    "'s", "'ll", " the", "<|endoftext|>", "<s>", "  ", "    ", " \n", "\n ", "aaaa", "한국",
]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(n)]


# ------------------------------------------------------------------ packing
@pytest.fixture(scope="module")
def byte_level():
    return Tokenizer.from_file(PATH("byte_bpe_50k.json"))


def test_encoder_equals_tokenizers(byte_level):
    texts = [*odd_texts(1500, 1), *random_texts(60, 2), "", None, "a b\n", "x\n \n y"]
    with open(PATH("byte_bpe_50k.json"), "rb") as f:
        ids, offsets = packing.Encoder(f.read())(pa.array(texts))
    for text, a, b in zip(texts, offsets[:-1], offsets[1:]):
        assert ids[a:b].tolist() == byte_level.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_binary_lengths():
    assert packing.binary_lengths(2500, 1024) == [1024, 1024, 256, 128, 64, 4]
    for n in range(1, 300):
        parts = packing.binary_lengths(n, 64)
        assert sum(parts) == n and all(p & (p - 1) == 0 and p <= 64 for p in parts)


def test_pieces_hold_every_id_once(spark, byte_level):
    docs = documents(spark)
    rows = packing.pieces(docs).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.offset == 0 for r in rows)
    got = {}
    for r in rows:
        assert r.length <= 1024 and r.length & (r.length - 1) == 0 and len(r.ids) == 4 * r.length
        got.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    for doc_id, text in {(1, ""), (2, ""), (4, "one"), (10, "x" * 5000), (None, "no id")}:
        want = byte_level.encode(text, add_special_tokens=False).ids + [0]
        parts = sorted(got[doc_id, len(want)])
        assert np.frombuffer(b"".join(p for _, p in parts), "<u4").tolist() == want
        assert [s for s, _ in parts] == np.cumsum([0, *[len(p) // 4 for _, p in parts]])[:-1].tolist()
    assert len(got[11, len(byte_level.encode("repeated row").ids) + 1]) == 2 * len(
        packing.binary_lengths(len(byte_level.encode("repeated row").ids) + 1, 1024)
    )
    assert packing.pieces(nothing(spark)).count() == 0


def test_buckets_are_written_by_length(spark, tmp_path):
    packing.write_buckets(packing.pieces(documents(spark)), str(tmp_path / "packed"))
    for bucket, length in spark.read.parquet(str(tmp_path / "packed")).select("bucket", "length").distinct().collect():
        assert 1 << bucket == length


# ------------------------------------------------------------------ token counts
@pytest.fixture(scope="module")
def merger():
    with open(PATH("piece_bpe_32k.model"), "rb") as f:
        return token_counts.PieceMerger(f.read())


def test_pieces_equal_sentencepiece(merger):
    assert merger.simple
    texts = [*odd_texts(3000, 3), *random_texts(60, 4), "", None, " " * 300, "a" * 3000, "er" * 700, "ab" * 9000]
    want = [len(merger.library.encode(t or "")) for t in texts]
    assert merger(pa.array(texts)).tolist() == want


def test_long_pretokens_are_merged_by_rank(merger, monkeypatch):
    """Long pre-tokens wait by rank: the counts are the library's, in time that doesn't grow with the square."""
    rng = random.Random(5)
    texts = [
        "aaab" * 30_000, "x" * 30_001, "ab" * 10_000 + " word " + "ha" * 7000, "=-" * 5000 + "é😀" * 3000,
        "".join(rng.choice("日本語の文章を長く書く") for _ in range(20_000)),
        "".join(rng.choice(["theq", "uick", "brow", "nfox", "jump"]) for _ in range(20_000)), "0123456789" * 3000, "",
    ]
    monkeypatch.setattr(merger, "library", None)
    got = merger(pa.array(texts)).tolist()
    monkeypatch.undo()
    assert got == [len(merger.library.encode(t)) for t in texts]


def test_both_layouts_of_pretokens_agree(merger, monkeypatch):
    monkeypatch.setattr(token_counts, "LONG", 5)
    for seed in range(60):
        rng = random.Random(seed)
        letters = rng.choice(["ab", "abc", "etaoin", "01", "the ing", "日本語a"])
        monkeypatch.setattr(token_counts, "FEW", rng.choice([1, 3, 64]))
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(6)]
        assert merger(pa.array(texts)).tolist() == [len(merger.library.encode(t)) for t in texts]


def test_token_counts_of_documents(spark, merger):
    docs = documents(spark)
    rows = token_counts.count_tokens(docs, limit=10).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 13 and by_id[1][1:] == (0, 0, False) and by_id[2][1:] == (0, 0, False)
    assert by_id[9].n_tokens == len(merger.library.encode("wort " * 30_000 + "ende")) and by_id[9].over_limit
    assert by_id[None].n_bytes == 5 and sum(r.doc_id == 11 for r in rows) == 2
    assert token_counts.count_tokens(nothing(spark)).count() == 0


# ------------------------------------------------------------------ byte-level BPE
def test_long_words_equal_tiktoken(spark):
    """Words of many sizes around the change to a heap, and of 200,000 letters."""
    rng = random.Random(12)
    ranks = bpe.read_ranks(PATH("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    letters = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    texts = [letters(n, of) for n in (400, 511, 512, 513, 700, 5000) for of in ("a", "ab", "etaoin", "éßñaé")]
    texts += ["x" * 200_000, letters(200_000, "etaoinshrdlu"), "the " + letters(3000, "the") + " the\n" + letters(600, "日本語")]
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in bpe.encode(documents(spark, texts)).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_words_are_cut_where_no_merge_reaches():
    """Pieces merged on their own give the word's ids, and words of few tokens across a place are cut there."""
    ranks = bpe.read_ranks(PATH("byte_bpe_multi_50k.tiktoken"))
    cuts = bpe.Cuts(ranks)
    rng = random.Random(8)
    of = ["etaoin", "zqxj", "éßñaé", "日本語の", "thering", "0123456789", "\x00\x7f\x80 "]
    words = ["".join(rng.choice(rng.choice(of)) for _ in range(rng.randint(1, 40))) for _ in range(3000)] + ["qx" * 300_000]
    pieces, index, counts = cuts(words)
    ends = np.concatenate([[0], np.cumsum(counts)])
    assert len(pieces) == len(set(pieces)) < len(index) == ends[-1] and counts.min() == 1 and counts.max() > 1
    for word, a, b in zip(words[:-1], ends, ends[1:]):
        own = [pieces[i] for i in index[a:b]]
        assert b"".join(own).decode() == word
        assert [i for p in own for i in bpe.merge_long(p, ranks)] == bpe.merge_long(word.encode(), ranks)
    pieces, index, counts = cuts([])
    assert pieces == [] and len(index) == len(counts) == 0
    # Tokens of over 8 bytes join across places where no shorter one lies.
    few = {bytes((b,)): b for b in range(256)} | {b"abcdefghij": 256}
    pieces, index, _ = bpe.Cuts(few)(["abcdefghijk", "abcabc"])
    assert [pieces[i] for i in index] == [b"abcdefghij", b"k", *[bytes((b,)) for b in b"abcabc"]]


def test_heap_merges_in_the_order_of_ranks():
    ranks = bpe.read_ranks(PATH("byte_bpe_multi_50k.tiktoken"))
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choice("aabet é") for _ in range(rng.randint(1, 30))).encode()
        parts = [bytes((b,)) for b in word]
        while True:
            best = min(((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 60, 0))
            if best[0] == 1 << 60:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        assert bpe.merge_long(word, ranks) == [ranks[p] for p in parts]


def test_ids_above_two_bytes(spark, tmp_path):
    """A rank file whose ids all lie above 65,536."""
    ranks = {t: r + 70_000 for t, r in bpe.read_ranks(PATH("byte_bpe_multi_50k.tiktoken")).items()}
    path = tmp_path / "shifted.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + f" {r}\n".encode() for t, r in ranks.items()))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = random_texts(20, 5) + odd_texts(10, 6)
    rows = bpe.encode(documents(spark, texts), str(path)).collect()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(texts[r.doc_id])
        assert r.decoded.decode() == texts[r.doc_id]


def test_encode_equals_tiktoken_and_decodes(spark):
    ranks = bpe.read_ranks(PATH("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*odd_texts(700, 5), *random_texts(30, 6), "", None, "a" * 400, "wort " * 20_000]
    rows = bpe.encode(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode_ordinary(text) and len(ids) == r.n_tokens, repr(text[:60])
        assert bytes(r.decoded) == text.encode()
    assert bpe.encode(nothing(spark)).count() == 0
    assert bpe.encode(documents(spark)).filter("doc_id is null or doc_id = 11").count() == 3


# ------------------------------------------------------------------ language
def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = language.ByteGru.fresh(["a", "b", "c"], 4, rng)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    x, y = rng.integers(97, 100, (5, 6)).astype(np.uint8), rng.integers(0, 3, 5)
    _, grads = net.gradients(x, y)
    for name, weights in net.weights.items():
        for at in [tuple(rng.integers(0, n) for n in weights.shape) for _ in range(4)]:
            if name[0] == "E":
                at = (97, at[1])
            kept, step = weights[at], 1e-3
            weights[at] = kept + step
            above = net.gradients(x, y)[0]
            weights[at] = kept - step
            below = net.gradients(x, y)[0]
            weights[at] = kept
            assert abs((above - below) / (2 * step) - grads[name][at]) < 1e-3, name


def test_languages_are_told_apart_on_held_out_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(rows).join(rows.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in found)
    assert len(found) > 100 and right / len(found) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_documents(spark):
    texts = [None, "", "123 !? \n", "²½", "aab abba aab", "xyx yxy xxy", "aab " * 3000] * 3
    table = documents(spark, texts).withColumn("lang", F.when(F.length(F.lit("")) == 0, F.lit("one")))
    rows = language.identify(table).collect()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {i for i, t in enumerate(texts) if not any(c.isalpha() for c in t or "")}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) for r in rows)
    unknown = language.identify(table.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unknown} == {"und"}
    assert language.identify(nothing(spark)).count() == 0


def test_languages_of_long_texts_are_learned(spark):
    long = [("123 456 " * 5000 + "aab abba baab " * 2000, "one"), ("xyx yxy xxy " * 4000, "two"), ("zwz" * 20_000, "three")]
    rows = [(i, *long[i % 3]) for i in range(60)] + [(i, "12 34 " * 9, "four") for i in range(60, 90)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language.training_rows(table, language.Training())
    assert {lang for lang, _ in sample} == {"one", "two", "three"}
    assert all(len(t.encode()) <= 20_000 for _, t in sample)
    found = {r.doc_id: r.lang_pred for r in language.identify(table).collect()}
    assert all(found[i] == lang for i, _, lang in rows[:60]) and all(found[i] == "und" for i in range(60, 90))


def test_sample_of_many_labels_is_bounded(spark):
    rows = [(i, f"aab abba {i}", f"dirty {i}") for i in range(400)]
    rows += [(i, "xyx yxy", "two") for i in range(400, 460)] + [(i, "zwz wzw", "three") for i in range(460, 520)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    how = language.Training(languages=8, docs=24, words=16, epochs=1)
    sample = language.training_rows(table, how)
    held = collections.Counter(lang for lang, _ in sample)
    assert len(held) == 8 and held["two"] == held["three"] == 3 and len(sample) <= how.docs
    assert language.train(sample, how).languages == sorted(held)
    few = language.training_rows(table.filter("doc_id >= 400"), language.Training())
    assert len(few) == sum(crc(i) % 5 > 0 for i in range(400, 520))


def test_stage_rejects_no_text_with_a_letter(spark):
    texts = ["aab abba", "xyx yxy", "qqqq zzzz 1", "12 !?", None]
    rows = [(i, texts[i % 5], ["one", "und"][i % 5 == 1]) for i in range(50)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in language.without_unknown(table).collect()} == {i for i in range(50) if i % 5 < 3}


def test_stage_fills_a_missing_language(spark):
    rows = [(i, ["aab abba baab", "xyx yxy yyxx"][i % 2], [["one", "two"][i % 2], None][i >= 60]) for i in range(80)]
    rows.append((80, "aab aab", "kept"))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang for r in language.without_unknown(table).collect()}
    assert got == {i: ["one", "two"][i % 2] for i in range(80)} | {80: "kept"}


@pytest.mark.parametrize("lang, ids", [(None, range(6)), ("en", [None] * 6)])
def test_stage_keeps_all_letters_with_nothing_to_learn_from(spark, lang, ids):
    texts = ["aab abba", "x" * 30_000, "日本", "123 !?", "", None]
    table = spark.createDataFrame([(i, t, lang) for i, t in zip(ids, texts)], "doc_id long, text string, lang string")
    assert language.training_rows(table, language.Training()) == []
    kept = language.without_unknown(table)
    assert kept.columns == table.columns and {r.text for r in kept.collect()} == set(texts[:3])


# ------------------------------------------------------------------ near-duplicates
def plain_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components_by_brute_force(spark):
    rng = random.Random(7)
    texts = random_texts(40, 8, words=200)
    for t in texts[:20]:
        words = t.split(" ")
        for _ in range(3):
            changed = list(words)
            changed[rng.randrange(len(changed))] = "other"
            texts.append(" ".join(changed))
    texts += [None, "", " ", texts[0], texts[0], "one", "One"]
    prints = [plain_fingerprint(t) for t in texts]
    want = components(len(texts), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    rows = simhash.near_duplicates(documents(spark, texts)).withColumn("hex", simhash.hex16(F.col("fp"))).collect()
    assert {r.doc_id: (r.hex, r.component_id) for r in rows} == {
        i: (f"{p:016x}", want[i]) for i, p in enumerate(prints)
    }
    kept = simhash.keep_one(documents(spark, texts)).select("doc_id").collect()
    assert {r.doc_id for r in kept} == set(want)


def test_one_row_of_each_component_is_kept(spark):
    texts = [*random_texts(3, 21, words=300), "a b c d", "all of this is alone"]
    copy, other, nulls, same, alone = texts
    rows = [(1, copy), (2, copy), (2, other), (None, copy), (3, same), (3, same), (3, same + " "), (7, alone), (7, None)]
    rows += [(None, nulls)] * 40 + [(None, nulls + " ")] * 2 + [(None, "")]
    table = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    got = sorted(((r[0], (r[1] or "").rstrip()) for r in kept.collect()), key=repr)
    want = [(1, copy), (2, other), (3, same), (7, alone), (7, ""), (None, nulls)]
    assert got == sorted(((i, t.rstrip()) for i, t in want), key=repr)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_crowded_buckets_lose_no_link(spark, monkeypatch, distance):
    monkeypatch.setattr(simhash, "CROWD", 3)
    rng = random.Random(distance)
    prints = set()
    for _ in range(4):
        center = rng.getrandbits(64)
        prints |= {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(40)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), distance).collect()
    want = {
        (max(a, b), min(a, b)) for a in signed for b in signed
        if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance
    }
    assert {(r.src, r.dst) for r in found} == want and len(found) == len(want)


def test_near_duplicates_of_odd_documents(spark):
    rows = simhash.near_duplicates(documents(spark)).collect()
    assert len(rows) == 13
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert [r.component_id for r in rows if r.doc_id == 11] == [11, 11]
    assert simhash.near_duplicates(nothing(spark)).count() == 0


# ------------------------------------------------------------------ lines
def plain_line_dedup(rows, min_chars=20, min_docs=3):
    blanks = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(blanks).translate(lower)
    of = lambda i: -(1 << 63) if i is None else i
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(of(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(held.get(key(x), ())) < min_docs or max(held[key(x)]) == of(i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_by_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [f"a passage number {i} that many documents share" for i in range(6)]
    pool += ["  A PASSAGE number 1 that many documents share\t", "short", "", "É" * 20, "é" * 20, "x" * 19, "y" * 20 + "\x0b"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9))) for _ in range(60)] + [None, "", "\n\n"]
    ids = [*range(len(texts) - 4), 3, 3, None, None]
    rows = list(zip(ids, texts))
    got = line_dedup.dedup_lines(documents(spark, texts, ids)).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, plain_line_dedup(rows)))


def test_lines_of_odd_tables(spark):
    assert line_dedup.dedup_lines(nothing(spark)).count() == 0
    rows = line_dedup.dedup_lines(documents(spark)).collect()
    assert len(rows) == 13 and {r.kept for r in rows if r.doc_id in (1, 2)} == {""}


def test_runs_are_levelled(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for b in range(5):
        rows = [(k, k, 10 * b + k) for k in range(3)] + [(100 + b, 0, b)]
        runs.add(spark.createDataFrame(rows, "k1 long, k2 long, doc_id long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    found = {r.k1: (r.n_docs, r.keeper) for r in runs.rows().collect()}
    assert found == {k: (5, 40 + k) for k in range(3)} | {100 + b: (1, b) for b in range(5)}


@pytest.mark.parametrize("fanout", [2, 3])
def test_a_run_holds_no_key_of_an_older_run(spark, fanout):
    rng = random.Random(fanout)
    runs, older, held = line_dedup.LineRuns(spark, fanout=fanout), set(), {}
    for b in range(7):
        rows = [(rng.randrange(40), 0, 100 * b + rng.randrange(30)) for _ in range(25 if b != 4 else 0)]
        for k, _, i in rows:
            held.setdefault(k, set()).add(i)
        runs.add(spark.createDataFrame(rows, "k1 long, k2 long, doc_id long"))
        stood = [r.k1 for level in runs.levels for part in level for r in part.collect()]
        assert len(stood) == len(set(stood)) and set(stood) == older | {k for k, _, _ in rows}
        again = {r.k1 for level in runs.updates for part in level for r in part.collect()}
        assert again <= older
        older |= set(stood)
    assert {r.k1: (r.n_docs, r.keeper) for r in runs.rows().collect()} == {k: (len(v), max(v)) for k, v in held.items()}


def test_digests_of_queries(spark):
    """The queries' digest columns are those of the operators' real outputs."""
    from fathom.llm import queries

    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id: hashlib.sha256(r.kept.encode()).hexdigest() for r in line_dedup.dedup_lines(table).collect()}
    assert {r.doc_id: r.kept_sha256 for r in queries.op9_line_dedup(spark, sf).collect()} == kept
    coded = {r.doc_id: hashlib.sha256(r.ids).hexdigest() for r in bpe.encode(table).collect()}
    assert {r.doc_id: r.ids_sha256 for r in queries.op6_byte_bpe(spark, sf).collect()} == coded
