"""Corpora from JSON lines or from a few literal texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lisan.session import broadcast_if_small, written

CORPUS = "doc_id bigint, lang string, text string"


def _contiguous(rows: DataFrame, groups: list[str], name: str) -> DataFrame:
    """Replace ``row`` (increasing inside each group without gaps) by positions over all groups in order.

    The sizes of the groups are summed up in order and added to the rows. Groups are input splits or
    partitions, so only that short table is sorted in one place; the rows are not shuffled.
    """
    sizes = rows.groupBy(groups).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(groups).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = written(sizes.select(*groups, (F.sum("n").over(order) - F.col("n") - F.col("first")).alias("shift")))
    others = [c for c in rows.columns if c not in (*groups, "row")]
    return rows.join(broadcast_if_small(starts), groups).select(
        (F.col("shift") + F.col("row")).alias(name), *others
    )


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their position over all files in path order."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return _contiguous(lines, ["file", "block"], "doc_id")


def with_doc_index(df: DataFrame) -> DataFrame:
    """Number the rows of a table from 0 in its present order, as ``doc_id``; a given one is kept.

    The table is read twice and must come out the same both times, as scans and written tables do.
    """
    if "doc_id" in df.columns:
        return df
    row = F.monotonically_increasing_id()  # partition number in the upper bits, row number in the lower 33
    rows = df.withColumn("row", row).withColumn("partition", F.shiftright("row", 33))
    return _contiguous(rows, ["partition"], "doc_id")


def read_jsonl(spark: SparkSession, path: str, lang: str) -> DataFrame:
    """``(doc_id, lang, text)`` of a JSON lines corpus; ``doc_id`` is the 0-based line position.

    Every line must be a JSON object with a ``text``; a blank or bad line or a missing ``text`` fails.
    """
    record = F.from_json("value", "text string", {"mode": "FAILFAST"})
    present = F.when(F.trim("value") == "", F.raise_error(F.lit("Blank line in JSON lines file."))).otherwise(
        record["text"]
    )
    # A filter is not pruned, so a bad line also fails where only rows are counted.
    good = F.when(present.isNull(), F.raise_error(F.lit("JSON record without text."))).otherwise(True)
    lines = _numbered_lines(spark, path).where(good)
    return lines.select("doc_id", F.lit(lang).alias("lang"), record["text"].alias("text"))


def from_texts(spark: SparkSession, texts: list[str], lang: str) -> DataFrame:
    """A small literal corpus in the given order."""
    return spark.createDataFrame([(i, lang, text) for i, text in enumerate(texts)], CORPUS)


def gold_labels(spark: SparkSession, sequences: list[list[str]]) -> DataFrame:
    """Literal gold label lists as ``(seq_id, token_index, label)``."""
    rows = spark.createDataFrame(list(enumerate(sequences)), "seq_id bigint, labels array<string>")
    return rows.select("seq_id", F.posexplode("labels").alias("token_index", "label"))
