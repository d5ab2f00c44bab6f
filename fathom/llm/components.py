"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm.common import cut


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``edges`` (src, dst); root is the smallest node.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each
    step links neighbours to the smallest node next to them, so the diameter
    shrinks geometrically.  The minimum of a node is a map-side combined
    aggregate and the join back can be split by the skew-join rule, so a hub
    with a huge number of neighbours is not one task's work.  Every round is
    written to the shared folder.  Null ends and self-loops are ignored; an
    empty table gives an empty result.
    """
    state = cut(
        edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(max_rounds):
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        state = cut(_small_star(_large_star(state)), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return state.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(
        state.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    )


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("m"))
    least = least.select("src", F.least("src", "m").alias("m"))
    larger = both.filter(F.col("dst") > F.col("src"))
    return (
        larger.join(least, "src")
        .select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        .filter(F.col("src") != F.col("dst"))
        .distinct()
    )


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("src").agg(F.min("dst").alias("m"))
    moved = e.join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    own = least.select("src", F.col("m").alias("dst"))
    return moved.unionByName(own).filter(F.col("src") != F.col("dst")).distinct()
