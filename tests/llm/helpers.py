"""Rows with everything that may turn up in ``documents``, and brute-force twins."""

import random
import zlib

SCHEMA = "doc_id long, text string, lang string, TEXT string, source string, fp long, score double"

LONG = "wort " * 30_000 + "ende"


def documents(spark, texts=None, ids=None):
    """A table with columns whose names clash with ``text`` and with results."""
    if texts is None:
        texts = [
            None, "", "  \n\t ", "one", "One two", "the quick brown fox jumps over the lazy dog",
            "The quick  brown fox\njumps over the lazy dog", "été ist größer als 日本 \U0001f600 <|endoftext|>",
            LONG, "x" * 5000, "repeated row", "repeated row",
        ]
        ids = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 11]
        texts.append("no id")
        ids.append(None)
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "other text", "s", 1, 0.5) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def crc(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def random_texts(n: int, seed: int, words: int = 60) -> list[str]:
    rng = random.Random(seed)
    pool = ["the", "of", "and", "Ärger", "straße", "que", "niño", "l'été", "x1", "don't", "日本語", "foo,", "bar.", "42"]
    pool += ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(80)]
    glue = [" "] * 12 + ["\n", "  ", "\t", " \n", "\n\n", " ", "　"]
    return ["".join(rng.choice(pool) + rng.choice(glue) for _ in range(rng.randint(0, words))) for _ in range(n)]


def components(n: int, linked) -> list[int]:
    """The smallest index reachable from each of n, given a test of two indices."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
