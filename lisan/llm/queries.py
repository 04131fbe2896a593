"""The registered queries of the numbered operators."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    audit,
    chat,
    exact_dedup,
    language,
    lines,
    mixing,
    packing,
    quality,
    repair,
    simhash,
    tokens,
    topk,
    vectors,
)
from .common import ROW


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows = rows.unionByName(spark.createDataFrame(extra, rows.schema))
    out = chat.format_trees(chat.thread_nodes(rows))
    turns, loss = chat.read_back(F.col("formatted")), chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    out = out.withColumns({"turns": turns, "loss": loss})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_groups(_table(spark, sf_dir, "documents")).drop(ROW)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents")).drop(ROW)


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings")).drop(ROW)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_groups(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "fingerprint", "component_id")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.drop(ROW)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_table(spark, sf_dir, "documents"), path("word_bpe_49k.json")).drop(ROW)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def repaired(rows: DataFrame) -> DataFrame:
    """The report of a repair with a digest of each conversation's repaired turns."""
    report, turns = repair.repair(rows)
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))
    out = report.join(repair.digests(turns), "key", "left")
    return out.drop("key").withColumn("repaired_sha256", digest)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(_table(spark, sf_dir, "conversations"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat,
        op2_line_dedup,
        op3_language_id,
        op4_near_vectors,
        op5_exact_dedup,
        op6_simhash,
        op7_packing,
        op8_mixing,
        op9_quality,
        op10_token_counts,
        op11_filter_audit,
        op12_top_k,
        op13_repair,
    )
}
