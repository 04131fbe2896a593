"""Helpers shared by the operators: row identity, connected components, sums of bits."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lisan.session import scratch_folder, written

#: Fixed value: the ASCII white space that separates words.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

ROW = "__row"


def with_row_id(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``df`` and ``__row``, a struct that names each row, repeated rows included.

    Rows of Parquet files are named by their file and their place in it, which stays the same however often the
    files are read. Any other frame (a join, a union, rows from memory) is written once to the scratch folder and
    read from there.
    """
    if _reads_files(df):
        try:
            return _named(df, columns)
        except AnalysisException:  # other files than Parquet have no row places
            pass
    return _named(written(df.select(*[f"`{c}`" for c in columns])), columns)


def _reads_files(df: DataFrame) -> bool:
    """Whether ``df`` is columns and filters over one set of files, so that a row of a file comes once at most."""
    try:
        plan = df._jdf.queryExecution().analyzed().toString()
    except AttributeError:
        return False
    steps = set(re.findall(r"^[\s:+-]*(\w+)", plan, re.MULTILINE))
    return steps <= {"Project", "Filter", "SubqueryAlias", "Relation"} and plan.count("Relation [") == 1


def _named(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    place = df.metadataColumn("_metadata")
    row = F.struct(F.xxhash64(place["file_path"]).alias("f"), place["row_index"].alias("r"))
    return df.select(*[f"`{c}`" for c in columns], row.alias(ROW))


def stable(df: DataFrame) -> DataFrame:
    """``df``, written to the scratch folder unless it reads files: its rows then have the same names in each use."""
    return df if _reads_files(df) else written(df)


def whole_rows(docs: DataFrame) -> DataFrame:
    """(__doc, __row): every row packed in one column, so that no column's name can clash."""
    return with_row_id(docs.select(F.struct("*").alias("__doc")), "__doc")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b): the smallest node that links lead to.

    Large-star and small-star steps in turn until nothing changes; each round is written to the scratch folder.
    The rounds grow with the logarithm of a component's length. No component is gathered in one place.
    """
    spark = edges.sparkSession

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = mark(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("x"))
            .select(F.col("x.b").alias("a"), F.col("x.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        now = written(small)
        after = mark(now)
        if after == before:
            break
        before = after
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that few texts at a time are Python objects."""
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links a-b as few as keep what they connect: each node with the smallest of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[label[moved]], nodes[moved]


__all__ = [
    "BLANK",
    "ROW",
    "WORD",
    "components",
    "forest",
    "held_out",
    "scratch_folder",
    "slices",
    "stable",
    "whole_rows",
    "with_row_id",
    "written",
]
