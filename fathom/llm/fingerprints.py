"""Document fingerprints: invertible Bloom lookup sketches of paragraphs (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.llm.common import BLANKS, hash128, let, pick
from fathom.operators.ranges import cuts, with_rank

#: Cells of each of a sketch's three parts at first; a failed try is followed by one of four times as many.
CELLS, GROWTH, TRIES = 64, 4, 12
#: Rounds of peeling in a try.
ROUNDS = 48
#: Rows of a range of neighbouring documents.
NEIGHBOURS = 1 << 13

_CELL = "struct<c: int, n: int, k: bigint, x: bigint>"
_STATE = f"struct<cells: array<{_CELL}>, plus: array<bigint>, minus: array<bigint>, stuck: boolean>"


def _run_starts(values: Column, same: Column | None = None) -> Column:
    """Where runs of equal values of a sorted array begin."""
    key = (lambda v: v[same]) if same else (lambda v: v)
    first = lambda v, i: F.when((i == 0) | (key(v) != key(F.get(values, i - 1))), i)
    return F.filter(F.transform(values, first), lambda i: i.isNotNull())


def _run_length(starts: Column, j: Column, values: Column) -> Column:
    return F.coalesce(F.get(starts, j + 1), F.size(values)) - F.get(starts, j)


def paragraphs(text: Column) -> Column:
    """The digests of a text's paragraphs (lines that aren't blank), each with how often it stands there.

    A paragraph that stands there twice has another digest than one that
    stands there once, so that a difference in number is a difference, too.
    """
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    hashes = F.sort_array(F.transform(lines, lambda line: F.xxhash64(line)))

    def numbered(values: Column) -> Column:
        digest = lambda starts: F.transform(
            starts, lambda at, j: F.xxhash64(F.get(values, at), _run_length(starts, j, values))
        )
        return let(_run_starts(values), digest)

    return let(hashes, numbered)


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(-1))


def _entries(keys: Column, n: int, cells: Column) -> Column:
    """What each key adds to its cell of each part: number, key and check."""

    def of(key: Column) -> Column:
        at = lambda part: F.lit(part) * cells + F.pmod(F.xxhash64(key, F.lit(part)), cells).cast("int")
        cell = lambda part: F.struct(
            at(part).cast("int").alias("c"), F.lit(n).alias("n"), key.alias("k"), _check(key).alias("x")
        )
        return F.array(*[cell(part) for part in range(3)])

    return F.flatten(F.transform(keys, of))


def _merged(entries: Column) -> Column:
    """One row per cell that isn't empty: numbers added up, keys and checks joined by XOR."""
    zero = F.struct(F.lit(0).alias("c"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("x"))
    add = lambda a, b: F.struct(
        b["c"].alias("c"), (a["n"] + b["n"]).alias("n"), a["k"].bitwiseXOR(b["k"]).alias("k"), a["x"].bitwiseXOR(b["x"]).alias("x")
    )

    def grouped(values: Column) -> Column:
        def cells(starts: Column) -> Column:
            def cell(at: Column, j: Column) -> Column:
                size = _run_length(starts, j, values)
                return F.when(size == 1, F.get(values, at)).otherwise(F.aggregate(F.slice(values, at + 1, size), zero, add))

            return F.filter(F.transform(starts, cell), lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["x"] != 0))

        return let(_run_starts(values, "c"), cells)

    return let(F.sort_array(entries), grouped)


def sketch(digests: Column, cells: Column | int = CELLS) -> Column:
    """The sketch of a set of digests: (c)ell, (n)umber, (k)eys and checks (x) of the cells that aren't empty."""
    cells = F.lit(cells) if isinstance(cells, int) else cells
    return _merged(_entries(digests, 1, cells))


def subtract(a: Column, b: Column) -> Column:
    """The sketch of what differs: what both have falls out of every cell."""
    minus = lambda c: F.struct(c["c"].alias("c"), (-c["n"]).alias("n"), c["k"].alias("k"), c["x"].alias("x"))
    return _merged(F.concat(a, F.transform(b, minus)))


def peel(difference: Column, cells: Column) -> Column:
    """(cells, plus, minus, stuck): the digests that a subtracted sketch gives up, and the cells that are left.

    A cell with a single digest names it; the digest is taken out of its
    other cells, which leaves further cells with one.  Done when no cell is
    left, stuck when none has a single digest.
    """
    none = F.array().cast("array<bigint>")
    start = F.struct(difference.alias("cells"), none.alias("plus"), none.alias("minus"), F.lit(False).alias("stuck"))

    def single(state: Column, n: int) -> Column:
        found = F.filter(state["cells"], lambda c: (c["n"] == n) & (c["x"] == _check(c["k"])))
        return F.array_distinct(F.transform(found, lambda c: c["k"]))

    def round_(state: Column, _: Column) -> Column:
        def taken(found: Column) -> Column:
            plus, minus = found["plus"], found["minus"]
            left = _merged(F.concat(state["cells"], _entries(plus, -1, cells), _entries(minus, 1, cells)))
            return F.struct(
                left.alias("cells"),
                F.concat(state["plus"], plus).alias("plus"),
                F.concat(state["minus"], minus).alias("minus"),
                (F.size(plus) + F.size(minus) == 0).alias("stuck"),
            ).cast(_STATE)

        found = F.struct(single(state, 1).alias("plus"), single(state, -1).alias("minus"))
        return F.when(state["stuck"] | (F.size(state["cells"]) == 0), state).otherwise(let(found, taken))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start.cast(_STATE), round_)


def difference(a: Column, b: Column) -> Column:
    """(plus, minus, tries): the digests that only ``a``, and only ``b`` has, from their subtracted sketches.

    A try whose peeling fails is followed by one with larger sketches, whose
    cells fit any difference in the end.  Should all fail, the digests are
    compared as sets, so the result is whole in any case.
    """
    kind = "struct<plus: array<bigint>, minus: array<bigint>, tries: int>"

    def try_(found: Column, t: Column) -> Column:
        def with_cells(cells: Column) -> Column:
            peeled = peel(subtract(sketch(a, cells), sketch(b, cells)), cells)
            whole = lambda s: F.when(
                F.size(s["cells"]) == 0, F.struct(s["plus"].alias("plus"), s["minus"].alias("minus"), t.alias("tries"))
            )
            return let(peeled, whole).cast(kind)

        return F.when(found.isNotNull(), found).otherwise(let((F.lit(CELLS) * F.pow(F.lit(GROWTH), t - 1)).cast("int"), with_cells))

    tried = F.aggregate(F.sequence(F.lit(1), F.lit(TRIES - 1)), F.lit(None).cast(kind), try_)
    by_sets = F.struct(F.array_except(a, b).alias("plus"), F.array_except(b, a).alias("minus"), F.lit(TRIES).alias("tries"))
    return F.when(a.isNotNull() & b.isNotNull(), F.coalesce(tried, by_sets.cast(kind)))


def likeness(a: Column, b: Column, found: Column) -> Column:
    """The share of both texts' paragraphs that both have: 1 for equal ones, also for two without any."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise(1 - (F.size(found["plus"]) + F.size(found["minus"])) / both)


def fingerprint(digests: Column) -> Column:
    """32 hex digits of a text's sketch: the same paragraphs, the same fingerprint."""
    return let(sketch(digests), lambda cells: F.lower(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in hash128(cells)])))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next, copies): different rows and the text that follows, by descending doc_id.

    Null texts are empty.  Null doc_ids come last, rows of one doc_id stand by
    a hash of their texts, and after the last row comes the first.  Equal
    rows follow each other: of n, n - 1 are followed by their own text.  They
    are counted before they are ordered, and one row says each of both.

    The rows are divided into ranges of their order, each ordered on its own;
    the last row of a range is sent to the next one as well.
    """
    rows = pick(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    key = F.struct(F.col("doc_id").alias("id"), *[h.alias(f"h{i}") for i, h in enumerate(hash128(F.col("text")))])
    keys = rows.select(key.alias("key")).distinct()
    # The greatest key of each range that has one: a row's range is the number of those below it.
    ends = with_rank(keys, cuts(keys, F.col("key"), NEIGHBOURS), F.col("key"), "at").groupBy("at").agg(F.max("key").alias("key"))
    ends = ends.agg(F.sort_array(F.collect_list("key")).alias("e")).scalar()

    counted = rows.groupBy("doc_id", "text", key.alias("key")).agg(F.count("*").alias("copies"))
    placed = with_rank(counted, ends, F.col("key"), "upto", "last")
    at = F.col("upto") - F.col("last").cast("int")
    own = F.struct(at.alias("at"), F.lit(False).alias("sent"))
    sent = F.struct(((at + 1) % F.size(ends)).alias("at"), F.lit(True).alias("sent"))
    both = placed.select("doc_id", "text", "copies", "key", F.explode(F.when(F.col("last"), F.array(own, sent)).otherwise(F.array(own))).alias("to"))
    below = F.lag("text").over(Window.partitionBy("to.at").orderBy(F.col("to.sent").desc(), "key"))
    found = both.select("doc_id", "text", "copies", "to", below.alias("below")).filter("not to.sent")
    once = F.struct(F.col("below").alias("next"), F.lit(1).cast("long").alias("copies"))
    again = F.struct(F.col("text").alias("next"), (F.col("copies") - 1).alias("copies"))
    ways = F.when(F.col("copies") > 1, F.array(once, again)).otherwise(F.array(once))
    return found.select("doc_id", "text", F.explode(ways).alias("w")).select("doc_id", "text", "w.next", "w.copies")


def copies(rows: DataFrame, number: str) -> DataFrame:
    """Each row as often as its ``number`` says, by way of rows for at most 4,096 copies each."""
    most = 4096
    n = F.col(number)
    blocks = F.transform(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / most)), lambda b: F.least(F.lit(most).cast("long"), n - b * most))
    others = [c for c in rows.columns if c != number]
    return rows.select(*others, F.explode(blocks).alias("_n")).select(
        *others, F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int"))).alias("_copy")
    ).drop("_copy")


def compare(rows: DataFrame) -> DataFrame:
    """``rows`` (text, edited, next and others) with fingerprints, differences and likeness.

    Adds fingerprint, edited_fingerprint, from_edited and from_next (plus,
    minus: the digests of the paragraphs that only the text, or only the other
    one has, and the tries it took), near_edited and near_next.  Each row is
    compared by itself, without a shuffle.  Texts without paragraphs (empty,
    blanks only) are alike; null texts give nulls.
    """
    digests = rows.withColumns({f"_{c}": paragraphs(F.col(c)) for c in ("text", "edited", "next")})
    found = digests.withColumns({f"from_{c}": difference(F.col("_text"), F.col(f"_{c}")) for c in ("edited", "next")})
    return found.withColumns({
        "fingerprint": fingerprint(F.col("_text")),
        "edited_fingerprint": fingerprint(F.col("_edited")),
        **{f"near_{c}": likeness(F.col("_text"), F.col(f"_{c}"), F.col(f"from_{c}")) for c in ("edited", "next")},
    }).drop("_text", "_edited", "_next")
