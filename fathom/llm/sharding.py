"""Shards of even row counts by balanced label propagation (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.llm.common import cut, hash128, pick

#: Rounds of propagation at most.
ROUNDS = 6
#: Parts into which every running count is split, so that none is one task's work.
SALTS = 256
#: Rows that a part of a shard's room has at least, if the room has them.
ROOM = 1024


def _by_shard(values: list[int], shard: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), shard.cast("int") + 1)


def _salt(*cols: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), *cols), F.lit(SALTS)).cast("int")


def _running(rows: DataFrame, by: list[str], value: str, order: list[str], name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the rows before, within ``by``.

    Two levels: sums of the salted parts first (at most ``SALTS`` a group),
    then a running sum within each part.  ``salt`` must be a column.
    """
    parts = rows.groupBy(*by, "salt").agg(F.sum(value).alias("_part"))
    before = F.sum("_part").over(Window.partitionBy(*by).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(*by, "salt", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.sum(value).over(
        Window.partitionBy(*by, "salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    counted = rows.withColumn("_within", F.coalesce(within, F.lit(0)))
    return (
        counted.join(parts, [*by, "salt"])
        .withColumn(name, F.col("_before") + F.col("_within"))
        .drop("_before", "_within")
    )


def _loads(state: DataFrame, shards: int) -> list[int]:
    """Rows by shard: one number for each of the fixed number of shards."""
    found = dict(state.groupBy("shard").agg(F.sum("n")).collect())
    return [found.get(s, 0) for s in range(shards)]


def flows(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many rows may move from shard to shard: as many as asked, but no shard gains more than its room.

    Moves out of a shard make room in it.  Where more come in than go out and
    there is room for, all of its incoming flows are cut in proportion, again
    and again, until no shard is over.
    """
    flow = {pair: float(n) for pair, n in asked.items()}
    for _ in range(200):
        over = False
        for s, free in enumerate(room):
            into = sum(n for (_, to), n in flow.items() if to == s)
            out = sum(n for (come, _), n in flow.items() if come == s)
            if into > max(0.0, free + out) + 0.5:
                over, share = True, max(0.0, free + out) / into
                flow = {pair: n * share if pair[1] == s else n for pair, n in flow.items()}
        if not over:
            break
    return {pair: int(n) for pair, n in flow.items()}


def propagate(state: DataFrame, quota: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Move linked rows towards the shard that holds most of their group.

    ``state`` has (g1, g2, shard, n): n linked rows of a group in a shard.
    Rows of a group are linked with each other and otherwise alike, so only
    their counts move.  In a round every group names the shard where it has
    most rows, and the rows it has elsewhere ask to move there.  How many may
    go from shard to shard is settled on the sums (``flows``: a number for
    each pair of shards) so that gains stay within ``quota``; each pair's
    number is split by salt, and the largest pieces go first, in part if need
    be.  A round is a join and two aggregates, written to the shared folder;
    it ends early when nothing may move.
    """
    shards = len(quota)
    weight = F.struct("n", F.xxhash64("g1", "shard").alias("tie"), "shard")
    for _ in range(rounds):
        room = [q - x for q, x in zip(quota, _loads(state, shards))]
        target = state.groupBy("g1", "g2").agg(F.max(weight).alias("to"))
        asked = cut(
            state.join(target, ["g1", "g2"])
            .filter(weight < F.col("to"))
            .select("g1", "g2", F.col("shard").alias("from"), F.col("to.shard").alias("to"), "n"),
            "shard-asked",
        )
        sums = {(r["from"], r.to): r.n for r in asked.groupBy("from", "to").agg(F.sum("n").alias("n")).collect()}
        flow = flows(sums, room)
        if not any(flow.values()):
            break
        table = [flow.get((a, b), 0) for a in range(shards) for b in range(shards)]
        pair = (F.col("from") * shards + F.col("to")).cast("int")
        # A pair's flow in as many parts as leave ROOM rows to each.
        share, cuts = _by_shard(table, pair), _by_shard([max(1, min(SALTS, n // ROOM)) for n in table], pair)
        salted = asked.withColumn("salt", F.pmod(F.xxhash64(F.lit(5), "g1", "g2"), cuts))
        part = F.floor(share * (F.col("salt") + 1) / cuts) - F.floor(share * F.col("salt") / cuts)
        before = F.sum("n").over(
            Window.partitionBy("from", "to", "salt")
            .orderBy(F.col("n").desc(), "g1", "g2")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        admitted = F.greatest(F.lit(0), F.least(F.col("n"), part - F.coalesce(before, F.lit(0)))).cast("long")
        moves = salted.withColumn("moved", admitted).filter("moved > 0")
        change = moves.select("g1", "g2", F.inline(F.array(
            F.struct(F.col("from").alias("shard"), (-F.col("moved")).alias("n")),
            F.struct(F.col("to").alias("shard"), F.col("moved").alias("n")),
        )))
        state = cut(
            state.unionByName(change).groupBy("g1", "g2", "shard").agg(F.sum("n").alias("n")).filter("n > 0"),
            "shard-state",
        )
    return state


def assign(docs: DataFrame, shards: int = 40, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    Law ``rows``: the counts of any two shards differ by one at most.  Linked
    documents are those with equal texts (null counts as empty); they start
    at a shard by hash and move towards each other under the shards' exact
    counts as quotas (``propagate``).  Documents without links then fill what
    is left.  slot numbers the documents of a shard from 0 without gaps.
    size is the UTF-8 bytes of the text plus 16.

    Null texts have size 16; null doc_ids are documents like any other;
    repeated rows are told apart only by their slots.  An empty table gives
    no rows; with fewer documents than shards some shards stay empty.
    Further columns are ignored.
    """
    rows = pick(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    g1, g2 = hash128(F.col("text"))
    thin = cut(
        rows.select(
            "doc_id",
            (F.octet_length("text") + 16).cast("long").alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            g1.alias("g1"),
            g2.alias("g2"),
            _salt("doc_id").alias("salt"),
        ),
        "shard-docs",
    )
    start = F.pmod(F.xxhash64("doc_id", "g1"), F.lit(shards)).cast("int")
    groups = thin.groupBy("g1", "g2").agg(F.count("*").alias("size_of_group"))
    total = thin.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    linked = groups.filter("size_of_group > 1")
    state = cut(
        thin.groupBy("g1", "g2", start.alias("shard")).agg(F.count("*").alias("n")).join(
            linked.select("g1", "g2"), ["g1", "g2"], "left_semi"
        ),
        "shard-state",
    )
    state = propagate(state, quota, rounds)

    # What a shard keeps of its linked rows: the first quota rows, large pieces first.
    pieces = _running(
        state.withColumn("salt", (F.lit(SALTS - 1) - F.least(F.lit(SALTS - 1), F.floor(F.log2("n")) * 16
                                                              + F.pmod(F.xxhash64("g1"), F.lit(16)))).cast("int")),
        ["shard"], "n", [F.col("n").desc(), "g1", "g2"], "at",
    )
    keep = F.greatest(F.lit(0), F.least(F.col("n"), _by_shard(quota, F.col("shard")) - F.col("at"))).cast("long")
    pieces = cut(pieces.withColumn("n", keep).filter("n > 0").select("g1", "g2", "shard", "n", "at"), "shard-pieces")
    kept = _loads(pieces, shards)
    vacant = [q - k for q, k in zip(quota, kept)]
    ahead = [sum(vacant[:s]) for s in range(shards)]

    # Of each group: its pieces as intervals of ranks (at most one a shard), then where its rest begins.
    placed = pieces.groupBy("g1", "g2").agg(
        F.sort_array(F.collect_list(F.struct("shard", "n", "at"))).alias("pieces"), F.sum("n").alias("held")
    )
    rest = (
        groups.join(placed, ["g1", "g2"], "left")
        .withColumn("held", F.coalesce("held", F.lit(0)))
        .withColumn("left", F.col("size_of_group") - F.col("held"))
        .withColumn("salt", _salt("g1", "g2"))
        .withColumn("all", F.lit(0))
    )
    plan = _running(rest, ["all"], "left", ["g1", "g2"], "rest_at").select(
        "g1", "g2", "pieces", "held", "rest_at"
    )

    # A document's rank in its group, in two levels as the group may be huge.
    parts = thin.groupBy("g1", "g2", "salt").agg(F.count("*").alias("in_part"))
    by_group = Window.partitionBy("g1", "g2").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("g1", "g2", "salt", F.coalesce(F.sum("in_part").over(by_group), F.lit(0)).alias("before"))
    in_part = F.row_number().over(Window.partitionBy("g1", "g2", "salt").orderBy("doc_id")) - 1
    ranked = (
        thin.withColumn("in_part", in_part)
        .join(parts, ["g1", "g2", "salt"])
        .withColumn("rank", F.col("before") + F.col("in_part"))
        .join(plan, ["g1", "g2"])
    )

    # (shard, slot) from the piece that holds the rank, else from the vacancies in order.
    start_of = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("shard"),
                        F.lit(None).cast("long").alias("slot"))
    found = F.aggregate(
        F.coalesce("pieces", F.array().cast("array<struct<shard:int,n:bigint,at:bigint>>")),
        start_of,
        lambda acc, p: F.when(
            acc["shard"].isNull() & (F.col("rank") < acc["seen"] + p["n"]),
            F.struct(acc["seen"], p["shard"].alias("shard"), (p["at"] + F.col("rank") - acc["seen"]).alias("slot")),
        ).otherwise(F.struct((acc["seen"] + p["n"]).alias("seen"), acc["shard"], acc["slot"])),
    )
    number = F.col("rest_at") + F.col("rank") - F.col("held")
    free = F.aggregate(
        F.array(*[F.struct(F.lit(s).alias("s"), F.lit(a).cast("long").alias("a")) for s, a in enumerate(ahead)
                  if vacant[s]] or [F.struct(F.lit(0).alias("s"), F.lit(0).cast("long").alias("a"))]),
        F.lit(0),
        lambda acc, v: F.when(number >= v["a"], v["s"]).otherwise(acc),
    )
    put = ranked.withColumn("found", found).withColumn("free", free)
    in_piece = F.col("found.shard").isNotNull()
    rest_slot = _by_shard(kept, F.col("free")) + number - _by_shard(ahead, F.col("free"))
    return put.select(
        "doc_id",
        "size",
        "text_crc32",
        F.when(in_piece, F.col("found.shard")).otherwise(F.col("free")).alias("shard"),
        F.when(in_piece, F.col("found.slot")).otherwise(rest_slot).cast("long").alias("slot"),
        "g1",
        "g2",
    )
