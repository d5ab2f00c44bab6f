"""Base Parquet tables.

Every table is read with ``spark.read.parquet`` so Catalyst can prune columns
and push filters into the scan; nothing here materialises data.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


#: Schemas by path, as found in the files: finding one is a job, and a query may read a table several times.
_SCHEMAS: dict[str, StructType] = {}


def table_path(root: str, name: str) -> str:
    """Location of one table: ``<root>/<name>.parquet`` (file or directory)."""
    return os.path.join(root, f"{name}.parquet")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Table ``name`` under ``root``: Parquet files, or with a root of the form
    ``catalog:<database>`` the catalog table (e.g. the bucketed copies made
    by ``fathom.sources.bucketed.write_bucketed``)."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    if root.startswith("catalog:"):
        return spark.table(f"{root[len('catalog:'):]}.{name}")
    # Listed anew for every use, so that appended files are read; the schema is found once.
    path = table_path(root, name)
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)
