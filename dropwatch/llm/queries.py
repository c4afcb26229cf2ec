"""One query per operator of this folder, over the whole tables; sql.py has the SQL of some."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from dropwatch.llm import (
    chat,
    importance,
    langid,
    lexical,
    minhash,
    pieces,
    pii,
    simhash,
    sql,
    substring,
    suffix,
    tiling,
    toxicity,
    warc,
)
from dropwatch.llm.common import table

PIECE_MODEL = "piece_bpe_32k.model"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts hold control strings."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.read_back(chat.format_conversations(conversations.unionByName(planted)))


def op2_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents and benchmark items of which the one leaks into the other."""
    return tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents")).drop("key")


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(table(spark, sf_dir, "documents"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.withColumn("held_out", langid.is_held_out(F.col("doc_id")))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(PIECE_MODEL)
    return pieces.encode_and_decode(table(spark, sf_dir, "documents"), path)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and edited texts; for every hundredth document also the number of
    different fingerprints of all documents within the radius, its own included."""
    found = simhash.fingerprint_edits(table(spark, sf_dir, "documents"))
    searched = found.where(F.col("doc_id") % 100 == 0)
    near = simhash.neighbours(searched, found).groupBy("fp").agg(F.count("*").alias("n_near"))
    counted = found.join(near, "fp", "left")
    return counted.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash.as_text(F.col("fp")).alias("fingerprint"),
        simhash.as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.when(F.col("doc_id") % 100 == 0, F.col("n_near")).alias("n_near"),
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"), k=2).drop("tkey")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archive(warc.write_archive(table(spark, sf_dir, "pages")))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.predict(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("held_out", toxicity.is_held_out(F.col("doc_id")))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_chat,
        op2_tiling,
        op3_pii,
        op4_suffix,
        op5_langid,
        op6_substring,
        op7_pieces,
        op8_simhash,
        op9_minhash,
        op10_warc,
        op11_lexical,
        op12_toxicity,
        op13_importance,
    )
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat": sql.OP1_SQL,
        "op4_suffix": sql.OP4_SQL,
        "op6_substring": sql.OP6_SQL,
        "op9_minhash": sql.OP9_SQL,
        "op10_warc": sql.OP10_SQL,
        "op11_lexical": sql.OP11_SQL,
        "op13_importance": sql.OP13_SQL,
    }
