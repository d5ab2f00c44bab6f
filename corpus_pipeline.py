"""A corpus pipeline: language, line dedup, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) with the columns of ``documents`` and
returns them, but for the last, which returns packed sequences.  ``run``
writes each stage's rows to the shared folder and reads them as the next
one's input, so a lost executor never costs more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm import language, line_dedup, packing, simhash
from fathom.llm.common import cut, pick

_DOCUMENT = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which no language is found: null and letterless texts, and no others.

    Every text with a letter stays, whatever its language and probability.
    A document without a lang gets the one that the network finds in its text.
    """
    return language.without_unknown(pick(docs, **_DOCUMENT))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three documents or more stay in one of them; n_chars follows the text.

    No document goes; null texts become empty, and an empty table gives none.
    """
    docs = pick(docs, **_DOCUMENT)
    kept = line_dedup.rewrite(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays: that of the smallest doc_id, null ids last."""
    return simhash.keep_one(pick(docs, **_DOCUMENT), shingle=3, distance=2)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, one power-of-two piece of a document each.

    Null texts count as empty ones: their end id alone.  An empty table gives no rows.
    """
    return packing.pieces(docs, max_length=1024, end_id=0)


STAGES = [
    ("language_id", detect_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: Models, tokenizers and fingerprints are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
