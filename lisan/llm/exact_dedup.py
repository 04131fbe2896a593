"""Exact duplicates by a tree merge of sorted digest runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lisan.session import broadcast_if_small

from .common import BLANK, ROW, stable, whole_rows, with_row_id, written

FAN_IN = 8


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{BLANK}+", "")


def digest_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its digests, written as one sorted run per input partition.

    The texts are read once and never shuffled: a row holds only the SHA-256 of the normalised text and, to
    verify it, the length and a second, independent hash of the same text.
    """
    body = normalised(F.col(f"`{text}`"))
    rows = with_row_id(docs, doc_id, text).select(
        ROW,
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.xxhash64(body).alias("check"),
        F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long").alias("n_chars"),
        F.spark_partition_id().alias("run"),
    )
    return written(rows.sortWithinPartitions("digest"))


KEY = ["digest", "n_bytes", "check"]


def merge_runs(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct text: the row that stays and the number of its copies.

    Runs meet in binomial rounds: in each round ``fan_in`` neighbouring runs become one, and of every text the
    best identifier of those runs is retained. A run is spread over partitions by digest, so no round gathers a
    run, nor a group of copies, in one task: copies inside a run are folded before they are sent. Texts are one
    only if SHA-256, length and second hash all agree.
    """
    best = F.struct(
        (-F.col("n_chars")).alias("less"),
        F.col("doc_id").isNull().alias("unnamed"),
        "doc_id",
        ROW,
    )
    runs = rows.groupBy("run", *KEY).agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
    left = (rows.agg(F.max("run")).first()[0] or 0) + 1
    while left > 1:
        runs = (
            runs.withColumn("run", (F.col("run") / fan_in).cast("int"))
            .repartition("run", *KEY)
            .sortWithinPartitions("run", *KEY)
            .groupBy("run", *KEY)
            .agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size"))
        )
        left = -(-left // fan_in)
    return runs.select(*KEY, "best", "group_size")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """The group of equal texts of every document.

    Columns: __row, doc_id, keep_id, group_size, kept, text_sha256. Texts are equal if they agree once all ASCII
    white space is deleted; null counts as empty. Of a group the row with the most code points stays, then the
    smallest doc_id (null last), then the first of fully equal rows: exactly one row of a group is kept, even
    where rows repeat. Other columns are not read. An empty table gives no rows.
    """
    rows = digest_runs(docs, doc_id, text)
    merged = written(merge_runs(rows, fan_in))
    return rows.join(merged, KEY).select(
        ROW,
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col(ROW) == F.col(f"best.{ROW}")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    docs = stable(docs)
    return drop_rows(docs, exact_groups(docs, doc_id, text).where("NOT kept"))


def drop_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose row id is not in ``dropped``, the smaller part.

    The dropped ids are written and measured: few are broadcast, and no text is shuffled; many are joined by a shuffle.
    """
    dropped = broadcast_if_small(written(dropped.select(ROW)))
    return whole_rows(docs).join(dropped, ROW, "left_anti").select("__doc.*")
