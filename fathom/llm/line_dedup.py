"""Line deduplication over levelled sorted runs of line hashes (DataFrame functions only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import BLANKS, ascii_lower, cut, hash128, new_folder, pick

MIN_CHARS, MIN_DOCS = 20, 3
#: Batches of documents that are added one after the other, and runs of a
#: level that are compacted into one run of the next.
BATCHES, FANOUT = 4, 2

_RUN = "k1 long, k2 long, n_docs long, keeper long"
#: Stands for a null doc_id.
_NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """Sorted runs (k1, k2, n_docs, keeper) in levels, in the shared folder.

    A run has one row per line key: in how many documents the key was found
    and the largest doc_id among them.  ``add`` merge-joins a batch's keys
    with all runs: those that no run has become a run of level 0, so each key
    stands in one run only; those that one has become an update (further
    documents, another keeper) beside the runs.  ``FANOUT`` runs or updates of
    a level are merged into one of the next, so n batches leave O(log n) of
    each, which a batch reads, and a row is rewritten O(log n) times.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.folder = new_folder(spark, "line-runs")
        self.levels: list[list[DataFrame]] = []
        self.updates: list[list[DataFrame]] = []
        self._written = 0

    def _path(self) -> str:
        self._written += 1
        return f"{self.folder}/{self._written}"

    @staticmethod
    def _merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy("k1", "k2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def _all(self, levels: list[list[DataFrame]]) -> DataFrame:
        found = [rows for level in levels for rows in level]
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], _RUN)

    def _put(self, levels: list[list[DataFrame]], rows: DataFrame) -> None:
        """``rows`` into level 0, and full levels compacted into the next ones."""
        level = 0
        while True:
            if level == len(levels):
                levels.append([])
            levels[level].append(rows)
            if len(levels[level]) < self.fanout:
                return
            path = self._path()
            self._merged(self._all([levels[level]])).sortWithinPartitions("k1", "k2").write.parquet(path)
            rows, levels[level], level = self.spark.read.schema(_RUN).parquet(path), [], level + 1

    def add(self, batch: DataFrame) -> None:
        """Add the keys (k1, k2, doc_id) of a batch; its documents are in no other batch."""
        once = batch.select("k1", "k2", "doc_id").distinct()
        keys = once.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        before = self._all(self.levels).select("k1", "k2", F.lit(True).alias("known"))
        split = keys.join(before.hint("merge"), ["k1", "k2"], "left")
        split = split.withColumn("known", F.coalesce("known", F.lit(False)))
        path = self._path()
        split.sortWithinPartitions("known", "k1", "k2").write.partitionBy("known").parquet(path)
        done = self.spark.read.schema(f"{_RUN}, known boolean").parquet(path)
        self._put(self.levels, done.filter("NOT known").drop("known"))
        self._put(self.updates, done.filter("known").drop("known"))

    def rows(self) -> DataFrame:
        """All keys of all runs, one row each, with the updates in their counts and keepers."""
        return self._merged(self._all(self.levels).unionByName(self._all(self.updates)))


def key_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row, pos, k1, k2): the lines whose keys have ``min_chars`` code points or more."""
    lines = docs.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
    k1, k2 = hash128(F.col("key"))
    return keys.filter(F.char_length("key") >= min_chars).select("doc_id", "row", "pos", k1.alias("k1"), k2.alias("k2"))


def dropped_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES
) -> DataFrame:
    """(doc_id, row, drop): the positions of the lines to drop, for documents that lose any."""
    spark = docs.sparkSession
    path = new_folder(spark, "line-keys")
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    key_lines(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    keys = spark.read.schema("doc_id long, row long, pos int, k1 long, k2 long, batch int").parquet(path)
    runs = LineRuns(spark)
    for b in range(batches):
        runs.add(keys.filter(F.col("batch") == b))
    # Written, so that the join shuffles both sides for itself and a line of very many documents can be split.
    common = cut(runs.rows().filter(F.col("n_docs") >= min_docs).select("k1", "k2", "keeper"), "line-common")
    lost = keys.join(common, ["k1", "k2"]).filter(F.col("doc_id") < F.col("keeper"))
    return lost.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("drop"))


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES
) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept (the text that stays).

    Line keys of at least ``min_chars`` code points found in at least
    ``min_docs`` documents lose all their lines except those of the largest
    doc_id that holds the key; the other lines stay as they are, in order,
    joined by newlines.  Keys are compared by 128 bits of hash.

    Null and empty texts are one empty line.  Rows with one doc_id are one
    document where documents are counted; a null doc_id is one document, less
    than all others.  Repeated rows give repeated rows.  An empty table gives
    no rows; further columns are ignored.
    """
    done = _rewritten(pick(docs, doc_id="long", text="string"), min_chars, min_docs, batches)
    return done.select("doc_id", "n_lines", "n_dropped", F.col("text").alias("kept"))


def rewrite(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES
) -> DataFrame:
    """``docs`` (doc_id, text and others) with the lines dropped from the text; null texts become empty."""
    return _rewritten(docs, min_chars, min_docs, batches).select(*docs.columns)


def _rewritten(docs: DataFrame, min_chars: int, min_docs: int, batches: int) -> DataFrame:
    own = docs.withColumns({
        "text": F.coalesce("text", F.lit("")),
        "_id": F.coalesce("doc_id", F.lit(_NO_ID)),
        "_row": F.xxhash64(F.coalesce("text", F.lit(""))),
    })
    thin = own.select(F.col("_id").alias("doc_id"), F.col("_row").alias("row"), "text")
    lost = dropped_lines(thin, min_chars, min_docs, batches).select(
        F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "drop"
    )
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drop"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    return own.join(lost, ["_id", "_row"], "left").withColumns({
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.coalesce(F.size("drop"), F.lit(0)).cast("long"),
        "text": F.when(F.col("drop").isNull(), F.col("text")).otherwise(kept),
    })
