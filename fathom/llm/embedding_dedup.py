"""Near-duplicate embeddings: E8 lattice hashing in several tables, then the cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fathom.llm.common import cut, hash128, pick
from fathom.llm.components import connected_components

#: Tables, lattice cells probed besides a vector's own, and the lattice's scale
#: as a multiple of the projected distance of a pair right at the threshold.
TABLES, PROBES, SCALE, SEED = 4, 3, 2.27, 2024
#: Rows of a cell that are compared in one task.
BLOCK = 1024


def _decode_d8(x: np.ndarray) -> np.ndarray:
    """The nearest point of D8 (integers with an even sum) to each row."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8 = D8 + (D8 + 1/2) to each row, doubled so that it is whole numbers."""
    whole, half = _decode_d8(x), _decode_d8(x - 0.5) + 0.5
    nearer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], half, whole)).astype(np.int64)


def _minimal_vectors() -> np.ndarray:
    """The 240 neighbours of the origin in E8, doubled."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (-2, 2):
                for b in (-2, 2):
                    v = [0] * 8
                    v[i], v[j] = a, b
                    out.append(v)
    for bits in range(256):
        if bits.bit_count() % 2 == 0:
            out.append([1 - 2 * (bits >> k & 1) for k in range(8)])
    return np.array(out, np.int64)


NEIGHBOURS = _minimal_vectors()


def _key(points: np.ndarray) -> np.ndarray:
    """A 64-bit key of each lattice point."""
    mixed = np.zeros(points.shape[:-1], np.uint64)
    for k in range(8):
        mixed = (mixed ^ points[..., k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


class Lattice:
    """Cells of unit vectors in ``tables`` random projections to eight dimensions.

    A projection keeps about 8 of ``dim`` parts of a squared distance, so the
    cells shrink with the length as the distances do: recall and the share of
    rows in a cell's neighbourhood don't depend on the length.
    """

    def __init__(self, dim: int, cosine: float, tables: int, probes: int, scale: float, seed: int):
        rng = np.random.default_rng([seed, dim])
        apart = np.sqrt(max(2 - 2 * cosine, 1e-6) * min(1.0, 8 / dim))
        self.probes, self.scale = probes, scale * apart
        self.frames = []
        for _ in range(tables):
            frame = rng.normal(size=(max(dim, 8), 8))
            # Orthonormal directions, so that projected distances never exceed the real ones.
            self.frames.append(np.linalg.qr(frame)[0][:dim])
        self.shift = rng.uniform(0, 1, (tables, 8))

    def cells(self, table: int, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(own, probed): the key of each vector's cell and of the ``probes`` neighbouring cells nearest to it."""
        x = unit @ self.frames[table] / self.scale + self.shift[table]
        own = decode_e8(x)
        if not self.probes:
            return _key(own), np.zeros((len(x), 0), np.int64)
        # Of the neighbours, those whose direction fits best with where x lies in its cell.
        fit = (x - own / 2) @ NEIGHBOURS.T
        best = np.argpartition(-fit, self.probes, axis=1)[:, : self.probes]
        return _key(own), _key(own[:, None, :] + NEIGHBOURS[best])


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (first by their largest component, so that squares don't overflow)."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten(), np.float64).reshape(len(column), -1)


def able() -> Column:
    """Whether a vector can link at all."""
    good = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return F.coalesce(F.col("label").isNotNull() & good, F.lit(False))


def class_key() -> Column:
    """128 bits of hash of label and vector, as 16 bytes."""
    return F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in hash128(F.struct("label", "v"))]))


def classes_of(vectors: DataFrame) -> DataFrame:
    """(cls, dim, label, v, copies, least): equal vectors of one label in one row.

    Only what can link: labels and vectors that are not null, without null
    or non-finite components, not empty and not zero.
    """
    found = vectors.filter(able()).groupBy("label", "v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    return found.select(class_key().alias("cls"), F.size("v").alias("dim"), "label", "v", "copies", "least")


def links(classes: DataFrame, cosine: float, tables: int, probes: int, scale: float, seed: int) -> DataFrame:
    """(src, dst, n): for classes, links to roots of what was found together, and how many rows link.

    Every class stands in its own cell of each table and probes neighbouring
    cells; classes of a cell are compared with those that stand in it or
    probe it.  Of a cell with many rows, blocks of ``BLOCK`` meet pairwise in
    tasks of their own, so no task or group grows with a cell.  Pairs are not
    emitted: a task returns for each class how many rows it links with in
    this cell and one edge to the first class of its kind.  A pair that meets
    in several cells counts in the first only, which either side's cells
    tell without a shuffle.
    """
    spread = classes.mapInArrow(
        _Spread(cosine, tables, probes, scale, seed),
        StructType(classes.schema.fields[:5]).add("tab", "integer").add("cell", "long").add("own", "boolean"),
    )
    spread = cut(spread, "lattice-cells")
    place = ["dim", "label", "tab", "cell"]
    sizes = spread.groupBy(*place).agg(F.count("*").alias("rows"), F.max("own").alias("stood")).filter(
        (F.col("rows") > 1) & F.col("stood")
    )
    blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
    placed = spread.join(sizes.select(*place, blocks.alias("blocks")), place)
    mine = F.pmod(F.xxhash64("cls", "tab"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, F.col("mine")).alias("i"), F.greatest(k, F.col("mine")).alias("j")),
    )
    met = placed.withColumn("mine", mine).withColumn("pair", F.explode(pairs))
    met = met.select(*place, "pair.i", "pair.j", "mine", "cls", "v", "copies", "own")
    compare = _Compare(cosine, tables, probes, scale, seed)

    def run(cell: pa.Table) -> pa.Table:
        return compare(cell)

    return met.groupBy(*place, "i", "j").applyInArrow(run, "src binary, dst binary, n long")


class _Spread:
    """Each class in its own cell of every table and in those that it probes."""

    def __init__(self, *how):
        self.how = how

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = self.how[1]
        lattices: dict[int, Lattice] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                dims = batch.column(1).to_numpy()
                for dim in np.unique(dims).tolist():
                    rows = batch.filter(pa.array(dims == dim))
                    lattice = lattices.setdefault(dim, Lattice(dim, *self.how))
                    unit = unit_rows(_matrix(rows.column(3)))
                    for t in range(tables):
                        own, probed = lattice.cells(t, unit)
                        cell = np.concatenate([own[:, None], probed], axis=1)
                        at = pa.array(np.repeat(np.arange(len(own)), cell.shape[1]))
                        taken = pa.table(rows.columns[:5], ["cls", "dim", "label", "v", "copies"]).take(at)
                        n = len(at)
                        is_own = np.tile(np.arange(cell.shape[1]) == 0, len(own))
                        yield from (
                            taken.append_column("tab", pa.array(np.full(n, t, np.int32)))
                            .append_column("cell", pa.array(cell.ravel()))
                            .append_column("own", pa.array(is_own))
                            .combine_chunks()
                            .to_batches()
                        )


class _Compare:
    """The links between two blocks of a cell (or within one), each where its pair meets first."""

    def __init__(self, cosine, *how):
        self.cosine, self.how = cosine, (cosine, *how)

    def __call__(self, table: pa.Table) -> pa.Table:
        rows = {n: table.column(n).combine_chunks() for n in ("cls", "v", "copies", "mine", "own")}
        cls, copies, mine, own = (rows[n].to_numpy(zero_copy_only=False) for n in ("cls", "copies", "mine", "own"))
        names, place = np.unique(cls, return_inverse=True)
        first = {n: table.column(n)[0].as_py() for n in ("dim", "tab", "cell", "i", "j")}
        unit = unit_rows(_matrix(rows["v"]))
        near = unit @ unit.T >= self.cosine
        # One of the two stands in the cell; in a task of two blocks they are of different blocks.
        near &= own[:, None] | own[None, :]
        near &= np.tri(len(cls), k=-1, dtype=bool)
        if first["i"] != first["j"]:
            near &= mine[:, None] != mine[None, :]
        a, b = np.nonzero(near)
        if len(a):
            fresh = ~self._met_before(unit, a, b, first)
            a, b = a[fresh], b[fresh]
        count = np.bincount(a, copies[b], len(cls)) + np.bincount(b, copies[a], len(cls))
        root = place.copy()
        while len(a):
            before = root.copy()
            np.minimum.at(root, a, before[b])
            np.minimum.at(root, b, before[a])
            if (root == before).all():
                break
        linked = np.flatnonzero(count)
        return pa.table({
            "src": pa.array(cls[linked], pa.binary()),
            "dst": pa.array(names[root[linked]], pa.binary()),
            "n": count[linked].astype(np.int64),
        })

    def _met_before(self, unit: np.ndarray, a: np.ndarray, b: np.ndarray, here: dict) -> np.ndarray:
        """Of pairs that meet in this cell, those that also meet in an earlier table or a smaller cell of this one."""
        used = np.unique(np.concatenate([a, b]))
        a, b, unit = np.searchsorted(used, a), np.searchsorted(used, b), unit[used]
        lattice = Lattice(here["dim"], *self.how)
        before = np.zeros(len(a), bool)
        for t in range(here["tab"] + 1):
            own, probed = lattice.cells(t, unit)
            at_a = (probed[b] == own[a, None]).any(axis=1)
            at_b = (probed[a] == own[b, None]).any(axis=1)
            if t < here["tab"]:
                before |= (own[a] == own[b]) | at_a | at_b
            else:
                before |= (at_a & (own[a] < here["cell"])) | (at_b & (own[b] < here["cell"]))
        return before


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.93,
    tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors (vec_id, embedding, label) link if their labels are equal and not
    null, their lengths are equal and their cosine in double precision is at
    least ``cosine``.  n_links counts the other rows linked directly,
    component_id is the smallest vec_id that links reach, kept whether it is
    the row's own.  Every link reported is verified; which are found depends
    on the lattice, whose cells follow from the vectors' length and ``cosine``
    (the README has measured recall).  Equal vectors of a label are one class
    (128-bit hash) and always linked.

    Vectors that are null, empty or zero or that hold null or non-finite
    components, and those without a label, link with nothing: no links, a
    component of their own.  Repeated rows are vectors like any other.  A
    null vec_id is never a component's name unless all are null.  An empty
    table gives no rows; further columns are ignored.
    """
    kind = {n.lower(): t for n, t in vectors.dtypes}["embedding"]
    rows = pick(vectors, vec_id="long", embedding=kind, label="string").select(
        "vec_id", "label", F.transform("embedding", lambda x: x + F.lit(0).cast(kind[6:-1])).alias("v")
    )
    classes = cut(classes_of(rows), "vector-classes")
    found = cut(links(classes, cosine, tables, probes, scale, seed), "vector-links")
    degree = found.groupBy(F.col("src").alias("cls")).agg(F.sum("n").alias("others"))
    roots = connected_components(found.select("src", "dst"))
    rooted = classes.select("cls", "copies", "least").join(roots, F.col("cls") == F.col("node"), "left").select(
        "cls", "copies", "least", F.coalesce("root", "cls").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(ids, "root").join(degree, "cls", "left").select(
        "cls", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    return (
        rows.select("vec_id", F.when(able(), class_key()).alias("cls"))
        .join(known, "cls", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
        )
    )
