"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words and that are stripped from lines: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pick(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast to the given types.

    Columns are found by exact name first and by position afterwards, so a
    table with further columns whose names clash (``text`` and ``TEXT``, or a
    name twice) is read without an ambiguous reference.
    """
    names = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])

    def index(name: str) -> int:
        if name in names:
            return names.index(name)
        return [n.lower() for n in names].index(name.lower())

    return plain.select(
        *[F.col(f"_c{index(n)}").cast(t).alias(n) for n, t in types.items()]
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Only a plain local
    session (tests) may go without: it gets a temporary folder, which is then
    also set as its checkpoint folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
    named = "file://" + tempfile.mkdtemp(prefix="fathom-llm-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    Cuts the lineage: what follows is recomputed from the files when an
    executor is lost, and the plan below runs once however often it is read.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def id_crc32(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hash128(c: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a column: a key without collisions in practice."""
    return F.xxhash64(c), F.xxhash64(F.lit(7), c)
