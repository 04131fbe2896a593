"""Bigram language model with add-one smoothing as tables of counts.

One explode and one shuffle turn sentences into ``grams(context, word, n, m)``: how often a bigram
occurs in the training part (n) and in the test part (m). Everything else is derived from that much
smaller table. The unigram that opens each padded sentence has a null context, so that summing n by
word also gives the unigram counts.

Because the cut-off of the vocabulary is one, no training word is unknown, so a bigram with an unknown
side has n = 0, and an unknown context has a context count of 0. Scores therefore need no replacement
of unknown words; ``lookup_oov`` shows the replaced names where they are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lisan import constants as C
from lisan.operators.split import Cut
from lisan.session import written


def pad_sentence(tokens: Column) -> Column:
    """One start and one end symbol around the tokens."""
    return F.concat(F.array(F.lit(C.SENTENCE_START)), tokens, F.array(F.lit(C.SENTENCE_END)))


def _pairs(contexts: Column, words: Column) -> Column:
    return F.arrays_zip(contexts.alias("context"), words.alias("word"))


def bigrams_padded(tokens: Column) -> Column:
    """Bigrams of the padded sentence as array<struct<context, word>>."""
    return _pairs(
        F.concat(F.array(F.lit(C.SENTENCE_START)), tokens),
        F.concat(tokens, F.array(F.lit(C.SENTENCE_END))),
    )


def bigrams_unpadded(tokens: Column) -> Column:
    """Bigrams inside the sentence; a one-token sentence has none."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return _pairs(F.slice(tokens, F.lit(1), n), F.slice(tokens, F.lit(2), n))


def everygrams(tokens: Column) -> Column:
    """All 1- and 2-grams of the padded sentence; a 1-gram has a null context."""
    padded = pad_sentence(tokens)
    return F.concat(
        F.transform(padded, lambda w: F.struct(F.lit(None).cast("string").alias("context"), w.alias("word"))),
        bigrams_padded(tokens),
    )


def _training_grams(tokens: Column) -> Column:
    return _pairs(
        F.concat(F.array(F.lit(None).cast("string"), F.lit(C.SENTENCE_START)), tokens),
        pad_sentence(tokens),
    )


def count_grams(tokenized: DataFrame, cut: Cut, boundaries: bool) -> DataFrame:
    """``grams(context, word, n, m)`` of tokenized sentences.

    ``boundaries`` says whether test bigrams with a start or end symbol count. The partial aggregation
    before the shuffle folds hot bigrams, so no reducer sees more than one row per bigram and map task.
    """
    test = bigrams_padded if boundaries else bigrams_unpadded
    in_train = cut.in_train
    grams = F.when(in_train, _training_grams(F.col("tokens"))).otherwise(test(F.col("tokens")))
    # The array goes straight into inline(): a named column would get a pushed-down filter on its size,
    # which tokenizes every sentence a second time.
    return (
        tokenized.select(in_train.alias("train"), F.inline(grams))
        .groupBy("context", "word")
        .agg(
            F.count(F.when(F.col("train"), 1)).alias("n"),
            F.count(F.when(~F.col("train"), 1)).alias("m"),
        )
    )


def vocabulary(grams: DataFrame) -> DataFrame:
    """``(word, n)``: training words with their unigram counts, start and end symbol included."""
    return grams.where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


def bigram_counts(grams: DataFrame) -> DataFrame:
    """``(context, word, n)`` of the training part."""
    return grams.where("n > 0 AND context IS NOT NULL").select("context", "word", "n")


def context_counts(grams: DataFrame) -> DataFrame:
    """``(context, n)``: training bigrams starting with a word."""
    return bigram_counts(grams).groupBy("context").agg(F.sum("n").alias("n"))


def vocabulary_size(vocab: DataFrame) -> DataFrame:
    """One row ``v``: distinct training words plus one for unknown words."""
    return vocab.agg((F.count(F.lit(1)) + 1).alias("v"))


def lookup_oov(pairs: DataFrame, vocab: DataFrame, column: str, alias: str) -> DataFrame:
    """Add ``alias``: the word in ``column`` if the vocabulary has it, else the unknown symbol."""
    known = vocab.select(F.col("word").alias(alias))
    return pairs.join(known, F.col(column) == F.col(alias), "left").withColumn(
        alias, F.coalesce(F.col(alias), F.lit(C.UNKNOWN))
    )


def laplace_score(n: Column, context_n: Column, v: Column) -> Column:
    """Add-one probability of a bigram seen ``n`` times after a context seen ``context_n`` times."""
    return (F.coalesce(n, F.lit(0)) + 1) / (F.coalesce(context_n, F.lit(0)) + v)


def score_test_bigrams(grams: DataFrame) -> DataFrame:
    """Each distinct test bigram with its looked-up words, counts and smoothed probability.

    ``grams`` is read twice here, so pass a written table. The totals of the contexts are written once and give
    counts, known words and the vocabulary size: every training word but the end symbol opens a bigram. The joins
    are on words; the test side has one row per distinct bigram, and a hot word's rows are split by adaptive
    execution because only the other, unique side has to be copied.
    """
    totals = written(context_counts(grams))
    vocab = totals.select(F.col("context").alias("word")).unionByName(
        totals.limit(1).select(F.lit(C.SENTENCE_END).alias("word"))
    )
    size = vocabulary_size(vocab)
    pairs = grams.where("m > 0").select("context", "word", "m", "n")
    contexts = totals.select(F.col("context").alias("c"), F.col("n").alias("context_n"))
    pairs = pairs.join(contexts, F.col("context") == F.col("c"), "left").drop("c")
    pairs = lookup_oov(pairs, vocab, "word", "word_lookup")
    # The end symbol opens no test bigram.
    known = F.col("context_n").isNotNull()
    return pairs.select(
        "context",
        "word",
        F.when(known, F.col("context")).otherwise(C.UNKNOWN).alias("context_lookup"),
        "word_lookup",
        "m",
        "n",
        F.coalesce("context_n", F.lit(0)).alias("context_n"),
        laplace_score(F.col("n"), F.col("context_n"), size.scalar()).alias("score"),
    )


def model_summary(grams: DataFrame, cut: Cut) -> DataFrame:
    """One row: sentence counts, vocabulary size and test perplexity, in one pass without joins.

    Per context, the mean of log2 P splits into sum(m * log2(n + 1)) - M * log2(N + v), with N and M
    the context's train and test totals. Contexts are then folded by N: distinct values of N number at
    most sqrt(2 * training tokens), some millions even for 10^13 tokens. That short table is written, so the
    text is read once although v is needed before the sum. v counts the training contexts, plus the end symbol, plus one.
    """
    by_context = (
        grams.where("context IS NOT NULL")
        .groupBy("context")
        .agg(
            F.sum("n").alias("n"),
            F.sum("m").alias("m"),
            F.sum(F.when(F.col("m") > 0, F.col("m") * F.log2(F.col("n") + 1)).otherwise(0.0)).alias("hits"),
        )
    )
    by_total = written(
        by_context.groupBy("n").agg(
            F.sum("m").alias("m"), F.sum("hits").alias("hits"), F.count(F.lit(1)).alias("contexts")
        )
    )
    seen = by_total.agg(F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("contexts"))), F.lit(0)).alias("seen"))
    sized = by_total.withColumn("seen", seen.scalar()).withColumn(
        "v", F.when(F.col("seen") > 0, F.col("seen") + 2).otherwise(1)
    )
    terms = sized.select("m", "v", (F.col("hits") - F.col("m") * F.log2(F.col("n") + F.col("v"))).alias("log2p"))
    entropy = -F.sum("log2p") / F.nullif(F.sum("m"), F.lit(0))
    return terms.agg(
        F.lit(cut.total).cast("bigint").alias("sentences"),
        F.lit(cut.train).cast("bigint").alias("train_sentences"),
        F.lit(cut.total - cut.train).cast("bigint").alias("test_sentences"),
        F.coalesce(F.max("v"), F.lit(1)).cast("bigint").alias("vocabulary"),
        F.coalesce(F.sum("m"), F.lit(0)).cast("bigint").alias("test_bigrams"),
        F.pow(F.lit(2.0), entropy).alias("perplexity"),
    )


def perplexity(grams: DataFrame, cut: Cut) -> DataFrame:
    """One row: test perplexity, null without test bigrams."""
    return model_summary(grams, cut).select("vocabulary", "test_bigrams", "perplexity")
