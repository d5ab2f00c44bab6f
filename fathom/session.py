"""Spark session construction and cluster-facing settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every query in this package relies on: UTC session time so dates
# and timestamps agree with other engines, ANSI semantics (overflow and bad
# casts raise instead of silently producing NULL), and adaptive execution so
# shuffle partition counts, join strategies and skewed partitions are re-planned
# from runtime statistics rather than guessed up front.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key may hold a large share of a table; split skewed join
    # partitions even when the split costs a shuffle further down.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python-side call-site capture costs a stack walk per DataFrame call;
    # plans here are built from library code, so it buys nothing.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "fathom",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package's core settings.

    On a cluster ``master`` is left to the launcher and ``shuffle_partitions``
    should be sized so one post-shuffle partition stays around 128-256 MB at
    the target scale; AQE then coalesces small partitions at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
