"""The registered queries of the subpackage: ``opN_<name>`` over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components: words of 3-word shingles, links at 2 bits or fewer."""
    from fathom.llm import simhash

    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's log10 probability under a backoff automaton learned from nine tenths of them."""
    from fathom.llm import language_model
    from fathom.llm.common import id_crc32

    scored = language_model.score(_table(spark, sf_dir, "documents"), id_crc32(F.col("doc_id")) % 10 != 0)
    return scored.select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of one power-of-two piece each, at most 1024 tokens."""
    from fathom.llm import packing

    packed = packing.pieces(_table(spark, sf_dir, "documents"), max_length=1024, end_id=0)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text under the 32k sentence-piece vocabulary."""
    from fathom.llm import token_counts

    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), limit=4096)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of even counts (law ``rows``), copies kept together."""
    from fathom.llm import sharding

    put = sharding.assign(_table(spark, sf_dir, "documents"), shards=40)
    return put.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded by byte-level BPE ranks and decoded again."""
    from fathom.llm import bpe

    done = bpe.encode(_table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every 50th vector with all others."""
    from fathom.llm import topk

    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text by a bidirectional recurrent network over its bytes."""
    from fathom.llm import language

    return language.identify(_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 20 code points or more in 3 documents or more stay in the largest doc_id only."""
    from fathom.llm import line_dedup

    done = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of equal labels at cosine 0.93 or more, found by lattice cells, and their components."""
    from fathom.llm import embedding_dedup

    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's paragraph sketch, subtracted from those of its edited text and of the next document."""
    from fathom.llm import fingerprints

    docs = fingerprints.with_next(_table(spark, sf_dir, "documents"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", 1, n - half), F.substring("next", 1, half))
    done = fingerprints.compare(docs.withColumn("edited", edited))
    done = done.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
        "copies",
    )
    return fingerprints.copies(done, "copies")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with the damage that op12 does by the hash of id and turn; n is how often a row stands."""
    from fathom.llm.common import pick

    rows = pick(conversations, conv_id="long", turn="long", role="string", text="string")
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn")).cast("binary")) % 20
    rows = rows.withColumns({"kind": kind, "role": as_text("role"), "text": as_text("text")}).filter("kind <> 0")
    ends = F.regexp_replace("text", "[.!?]", "")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, ends).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired by the cheapest edits."""
    from fathom.llm import conversations
    from fathom.llm.common import pick

    table = _table(spark, sf_dir, "conversations")
    rows = damaged(table)
    found = conversations.digests(rows, conversations.repair(rows)).withColumnRenamed("conv_id", "_id")
    every = pick(table, conv_id="long").distinct()
    none = {"audit": "", "repaired_sha256": "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"}
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(none.get(c, 0))).alias(c) for c in columns]
    )


def with_repeats(doc_id: Column, text: Column) -> Column:
    """The words of a text, joined by one blank, with the repeats that op13 plants by the hash of the id."""
    from fathom.llm.common import id_crc32, let

    def changed(words: Column) -> Column:
        n, h = F.size(words).cast("long"), id_crc32(doc_id)
        g = F.floor(h / 10)

        def word(a: Column) -> Column:
            period = 1 + F.floor((n - a) / (3 + g % 8))
            return F.array_join(
                let(period, lambda p: F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int"))))),
                " ",
            )

        return F.when((h % 10 == 0) & (n > 0), let(g % n, word)).otherwise(F.array_join(words, " "))

    return let(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), changed)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least 12 words and two periods in every whole text, and the texts without their repeats."""
    from fathom.llm import periodic_runs
    from fathom.llm.common import id_crc32, pick

    table = pick(_table(spark, sf_dir, "documents"), doc_id="long", text="string")
    planted = F.when(id_crc32(F.col("doc_id")) % 10 == 0, with_repeats(F.col("doc_id"), F.col("text")))
    docs = table.select("doc_id", F.coalesce(planted, "text").alias("text"))
    found = periodic_runs.runs(docs, min_words=12)
    # The greatest length, then the least start and period.
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("p")))
    best = F.array_min(order)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.n")).alias("length"),
        F.col("best.p").alias("period"),
        F.floor(-F.col("best.n") * 1000 / F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_scores, op2_packing, op3_token_counts, op4_sharding, op5_simhash, op6_byte_bpe, op7_top_k, op8_language,
        op9_line_dedup, op10_embedding_dedup, op11_fingerprints,
        op12_conversation_repair, op13_periodic_runs,
    )
}
ORACLES: dict[str, str] = {
    "op7_top_k": """
WITH able AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM able q JOIN able d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op9_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), pieces AS (
  SELECT doc_id, r, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM lines
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM pieces
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id < c.keeper AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, r
""",
}
