"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, then the Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm.common import cut, hash128, pick
from fathom.llm.components import connected_components

SEED = 42
#: Shingles whose bits are counted at once.
STEP = 1 << 16
#: Blocks of the first split, and of the finer one for crowded buckets.
COARSE, FINE = 4, 16
#: Distinct fingerprints in a bucket up to which they are compared directly.
CROWD = 64


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of UTF-8 text (unsigned); 0 without words."""
    words = (text or b"").lower().split()  # bytes: A-Z and [\x20\x09-\x0D] only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    ends = ends[shingle - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(ends)
    for i in range(0, n, STEP):
        h = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(starts[i : i + STEP], ends[i : i + STEP])),
            np.uint64,
        )
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keys, fp): one row per document; keys are long columns, fp is the fingerprint as a signed long."""
    names = ["doc_id", *keys, "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(fps.view(np.int64))], names)

    rows = pick(docs, doc_id="long", text="binary", **{k: "long" for k in keys})
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _masks(blocks: int, distance: int) -> list[int]:
    """Signed masks, each leaving out ``distance`` of the ``blocks`` equal bit blocks."""
    width = 64 // blocks
    full = (1 << 64) - 1
    out = []
    for gone in combinations(range(blocks), distance):
        mask = full
        for b in gone:
            mask &= ~(((1 << width) - 1) << (b * width))
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _buckets(fps: DataFrame, blocks: int, distance: int) -> DataFrame:
    keys = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
            for t, m in enumerate(_masks(blocks, distance))
        ]
    )
    return fps.select("fp", F.inline(keys))


def _verified(members: DataFrame, distance: int) -> DataFrame:
    a, b = members.alias("a"), members.alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    same = (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key"))
    return a.join(b, same & (F.col("a.fp") < F.col("b.fp")) & near).select(
        F.col("b.fp").alias("src"), F.col("a.fp").alias("dst")
    )


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """(src, dst): all pairs of distinct fingerprints that differ in at most ``distance`` bits.

    Two fingerprints that differ in at most d bits agree on all but d of any
    set of blocks.  The first split (4 blocks) joins on those that agree.
    Fingerprints of a bucket with more than ``CROWD`` members are joined on a
    finer split (16 blocks of 4 bits) instead, where a bucket has at most
    2^(4 d) distinct fingerprints whatever the data; so no bucket is
    quadratic in the input and no link is lost.
    """
    if not 0 < distance < COARSE:
        raise ValueError(f"distance must be 1 to {COARSE - 1}")
    buckets = _buckets(fps, COARSE, distance)
    sizes = buckets.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    members = cut(buckets.join(sizes, ["t", "key"]), "simhash-buckets")
    direct = _verified(members.filter(F.col("n") <= CROWD), distance)
    crowded = members.filter(F.col("n") > CROWD).select("fp").distinct()
    finer = _buckets(crowded, FINE, distance)
    shared = finer.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    return direct.unionByName(_verified(cut(finer.join(shared, ["t", "key"]), "simhash-finer"), distance)).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id.

    component_id is the smallest doc_id that links reach, the document's own
    included.  Copies share a fingerprint and meet in one row before any
    join; they are never expanded into pairs.  Null and empty texts, and
    texts of blanks only, have fingerprint 0 and are linked like any other;
    texts under ``shingle`` words are one shingle.  Rows with a null doc_id
    are fingerprinted but never name a component (their component_id is null
    if no other row is reached).  Repeated rows give repeated rows.  An empty
    table gives no rows; further columns are ignored.
    """
    fps = cut(fingerprints(docs, shingle), "simhash-fps")
    rooted = _rooted(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), distance)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(ids, "root").select("fp", "component_id")
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def _rooted(distinct: DataFrame, distance: int) -> DataFrame:
    """(fp, least, root): distinct fingerprints with the smallest one that links reach."""
    roots = connected_components(links(distinct.select("fp"), distance))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """The first row of each component; columns as given.

    Rows are in order of doc_id, null ids last, then of 128 bits of hash over
    all columns.  Rows that are equal in all columns are one row: they meet
    in one before they are dealt out, so that no task gets all of a row that
    is repeated very often.
    """
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    every = F.struct(*[F.struct(F.col(c), F.col(c).isNull()) for c in plain.columns])
    k1, k2 = hash128(every)
    keyed = plain.select("*", k1.alias("_k1"), k2.alias("_k2"))
    fps = cut(fingerprints(keyed.toDF(*names, "_k1", "_k2"), shingle, ("_k1", "_k2")), "simhash-fps")
    row = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "_k1", "_k2")
    rooted = _rooted(fps.groupBy("fp").agg(F.min(row).alias("least")), distance)
    first = rooted.groupBy("root").agg(F.min("least").alias("first")).select("first._k1", "first._k2")
    kept = keyed.dropDuplicates(["_k1", "_k2"]).join(first, ["_k1", "_k2"], "left_semi")
    return kept.select(*plain.columns).toDF(*names)


def hex16(fp) -> F.Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
