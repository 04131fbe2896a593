"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lisan import session
from lisan.operators import corpus, split
from lisan.plans.queries import QUERIES

PYTHON_MODEL = {"model_entities"}
# Results made row by row: nothing but the spread of a one-split input may be shuffled.
NARROW = {
    "article_preview", "en_sentences", "ar_sentences", "ar_first_pieces", "en_word_tokens", "wordpunct_tokens",
    "simple_word_tokens", "token_offsets", "normalize_arabic", "en_pos_table", "ar_pos_table", "np_chunks",
    "chunk_tree", "pattern_entities", "bio_spans", "gazetteer_entities", "sentence_entities", "token_labels",
}
# One pass over the text besides the counting pass of the split.
SINGLE_SCAN = NARROW | {"lm_vocab", "train_lexicon", "everygrams", "top_entities", "entity_type_counts", "prf1_ner"}
# What is left after the pass over the text: a short table of totals.
FOLDED = {"en_perplexity", "ar_perplexity", "lm_summary"}
# Top-k or key lookups on ids, then a read that the key bounds.
BY_KEY = {"first_articles", "sample_words"}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert ("PythonUDF" in text or "InPandas" in text or "EvalPython" in text) == (name in PYTHON_MODEL)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    if name in NARROW:
        assert "Window" not in text and "Join" not in text
        assert text.count("Exchange") == text.count("REPARTITION_BY_NUM")
    if name in FOLDED:
        assert "text:string" not in text and "Window" not in text
    if name in BY_KEY:
        assert "PushedFilters: [IsNotNull(doc_id)" in text
    if name in SINGLE_SCAN:
        assert text.count("FileScan parquet") == 1


def test_tokenizer_runs_once_per_sentence(spark, sf_dir):
    """No filter on the size of a token array below the tokenizer."""
    for name in ("lm_vocab", "gazetteer_entities", "np_chunks", "confusion_pos"):
        text = plan(entry.queries()[name](spark, sf_dir))
        filters = [line for line in text.splitlines() if "Filter" in line and "sentence" in line]
        assert not [line for line in filters if "regexp" in line], name


def test_split_bound_reaches_the_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = split.locate_cut(split.sentence_counts(docs))
    train, test = split.train_test_split_positional(corpus.sentences(docs), cut)
    assert f"LessThanOrEqual(doc_id,{cut.doc_id})" in plan(train)
    assert f"GreaterThanOrEqual(doc_id,{cut.doc_id})" in plan(test)


def test_columns_are_pruned(spark, sf_dir):
    text = plan(entry.queries()["top_tokens"](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text or "ReadSchema: struct<text:string>" in text


def test_spread_leaves_large_inputs_alone(spark, sf_dir):
    wide = spark.range(1000, numPartitions=64)
    assert session.spread(wide, "id").rdd.getNumPartitions() == 64
    few = spark.range(10, numPartitions=1)
    assert session.spread(few, "id").rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism


def test_broadcast_is_bounded(spark):
    small, large = spark.range(10), spark.range(100)
    joined = lambda side: plan(
        spark.range(1000).withColumn("x", F.lit(1)).join(session.broadcast_if_small(side, rows=50), "id")
    )
    assert "BroadcastHashJoin" in joined(small)
    assert session.is_small(small, 50) and not session.is_small(large, 50)
