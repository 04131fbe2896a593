"""Language models that are kept: saved by bucket, merged with new counts, and scored on other text."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lisan import constants as C
from lisan.operators import bigrams
from lisan.session import written

BUCKETS = 16
_TABLES = {
    "bigrams": (("context", "word"), "context STRING, word STRING, n BIGINT"),
    "contexts": (("context",), "context STRING, n BIGINT"),
}


@dataclass(frozen=True)
class StoredModel:
    """A bigram model on disk: ``bigrams(context, word, n)`` and ``contexts(context, n)``, each in buckets of its keys.

    A join on these keys reads the buckets as they lie and only moves the other side. Bigrams go by both words, so
    a frequent context is spread over all buckets.
    """

    bigrams: DataFrame
    contexts: DataFrame
    buckets: int

    def vocabulary_size(self) -> DataFrame:
        """One row ``v``: every training word opens a bigram but the end symbol, plus one for unknown words."""
        return self.contexts.agg(F.when(F.count(F.lit(1)) > 0, F.count(F.lit(1)) + 2).otherwise(1).alias("v"))


def training_bigrams(tokenized: DataFrame) -> DataFrame:
    """``(context, word, n)`` of all sentences with ``tokens``, sentence symbols included."""
    pairs = tokenized.select(F.inline(bigrams.bigrams_padded(F.col("tokens"))))
    return pairs.groupBy("context", "word").agg(F.count(F.lit(1)).alias("n"))


def save_model(counts: DataFrame, path: str, buckets: int = BUCKETS) -> StoredModel:
    """Write ``(context, word, n)`` counts below ``path`` as a model of so many buckets."""
    spark = counts.sparkSession
    first = counts.select("context", "word", F.col("n").cast("bigint").alias("n"))
    _write(first, "bigrams", path, buckets)
    stored = spark.read.schema("context string, n bigint").parquet(f"{path}/bigrams")
    _write(stored.groupBy("context").agg(F.sum("n").alias("n")), "contexts", path, buckets)
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.json(f"{path}/layout")
    return load_model(spark, path)


def _write(df: DataFrame, name: str, path: str, buckets: int) -> None:
    keys, _ = _TABLES[name]
    table = f"lisan_{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)  # the same hash as the buckets': one file each
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", f"{path}/{name}").saveAsTable(table)
    df.sparkSession.sql(f"DROP TABLE {table}")  # the files stay; any session may name them again


def load_model(spark: SparkSession, path: str) -> StoredModel:
    """The model below ``path``; its tables get names of this session that say how the files lie."""
    buckets = spark.read.schema("buckets int").json(f"{path}/layout").first()[0]
    found = []
    for name, (keys, columns) in _TABLES.items():
        table = f"lisan_{name}_{uuid.uuid4().hex}"
        by = ", ".join(keys)
        place = f"{path}/{name}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
            f"INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        found.append(spark.table(table))
    return StoredModel(*found, buckets)


def merge_model(model: StoredModel, counts: DataFrame, path: str) -> StoredModel:
    """A new model below ``path``: the counts of ``model`` and those of new text, ``(context, word, n)``, added up.

    The stored side stays in its buckets; only the new counts are dealt to them.
    """
    new = counts.select("context", "word", F.col("n").alias("more")).repartition(model.buckets, "context", "word")
    both = model.bigrams.join(new, ["context", "word"], "full_outer")
    total = F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))
    return save_model(both.select("context", "word", total.alias("n")), path, model.buckets)


def _pairs(tokenized: DataFrame, boundaries: bool) -> DataFrame:
    pairs: Column = (bigrams.bigrams_padded if boundaries else bigrams.bigrams_unpadded)(F.col("tokens"))
    return tokenized.select(F.inline(pairs)).groupBy("context", "word").agg(F.count(F.lit(1)).alias("m"))


def score_other(model: StoredModel, tokenized: DataFrame, boundaries: bool = False) -> DataFrame:
    """Each distinct bigram of other text with its looked-up words, counts and add-one probability.

    ``(context, word, context_lookup, word_lookup, m, n, context_n, score)``. The text's folded bigrams go to the
    model's buckets, three times: by both words, by the first, by the second.
    """
    pairs = _pairs(tokenized, boundaries).repartition(model.buckets, "context", "word")
    pairs = pairs.join(model.bigrams, ["context", "word"], "left")
    totals = model.contexts.withColumnRenamed("n", "context_n")
    pairs = pairs.join(totals, "context", "left")
    words = model.contexts.select(F.col("context").alias("word"), F.lit(True).alias("known"))
    pairs = pairs.join(words, "word", "left")
    opened = F.col("context_n").isNotNull()
    known = F.col("known") | (F.col("word") == C.SENTENCE_END)
    return pairs.select(
        "context", "word", F.when(opened, F.col("context")).otherwise(C.UNKNOWN).alias("context_lookup"),
        F.when(known, F.col("word")).otherwise(C.UNKNOWN).alias("word_lookup"), "m",
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        F.coalesce("context_n", F.lit(0).cast("bigint")).alias("context_n"),
        bigrams.laplace_score(F.col("n"), F.col("context_n"), model.vocabulary_size().scalar()).alias("score"),
    )


def perplexity_other(model: StoredModel, tokenized: DataFrame, boundaries: bool = False) -> DataFrame:
    """One row ``(vocabulary, test_bigrams, perplexity)`` of other text under the model; null without bigrams."""
    scored = written(score_other(model, tokenized, boundaries).select("m", "score"))
    entropy = -F.sum(F.col("m") * F.log2("score")) / F.nullif(F.sum("m"), F.lit(0))
    return scored.agg(
        model.vocabulary_size().scalar().cast("bigint").alias("vocabulary"),
        F.coalesce(F.sum("m"), F.lit(0)).cast("bigint").alias("test_bigrams"),
        F.pow(F.lit(2.0), entropy).alias("perplexity"),
    )
