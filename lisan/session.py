"""Small helpers about the running session: input spread, scratch tables, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What a broadcast may hold at most.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16_000_000


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a text table enough partitions to use every core.

    Only an input with fewer splits than cores is redistributed. A large input already has more splits
    than that and is returned as it is, so no text is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(4 * cores, *keys)


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors.")
    folder = tempfile.mkdtemp(prefix="lisan-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession) -> str:
    """A new place in the scratch folder."""
    return f"{scratch_folder(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as a table in the scratch folder and read it back.

    Used where several later steps need the same result: it cuts the lineage, survives lost executors
    and keeps column pruning for the readers.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows of at most ``size`` bytes in all; reads no further than that."""
    row = F.octet_length(F.to_json(F.struct("*")))
    found = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(row), F.lit(0))).first()
    return found[0] <= rows and found[1] <= size


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring that ``df`` is small; else leave the join to Spark."""
    return F.broadcast(df) if is_small(df, rows, size) else df
