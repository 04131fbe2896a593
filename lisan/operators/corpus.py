"""Documents to sentences and tokens.

Every table keeps its keys: ``doc_id`` (article index), ``sentence_index``, ``token_index``.
All steps are narrow: one scan, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lisan import constants as C
from lisan.functions import text as T
from lisan.functions.arabic import normalize_arabic


def sentences(docs: DataFrame, splitter: Callable[[Column], Column] = T.split_sentences) -> DataFrame:
    """``(doc_id, sentence_index, sentence)`` of a ``(doc_id, text)`` table."""
    return docs.select("doc_id", F.posexplode(splitter(F.col("text"))).alias("sentence_index", "sentence"))


def located_sentences(docs: DataFrame, splitter: Callable[[Column], Column] = T.sentence_spans) -> DataFrame:
    """``sentences`` plus ``start_char``, the offset of the sentence in its document."""
    return docs.select("doc_id", F.posexplode(splitter(F.col("text"))).alias("sentence_index", "s")).select(
        "doc_id", "sentence_index", "s.sentence", "s.start_char"
    )


def tokenized(
    sents: DataFrame,
    tokenizer: Callable[[Column], Column] = T.word_tokenize,
    lowercase: bool = False,
) -> DataFrame:
    """Replace ``sentence`` by its ``tokens`` array."""
    source = F.lower("sentence") if lowercase else F.col("sentence")
    return sents.select("doc_id", "sentence_index", tokenizer(source).alias("tokens"))


def tokens(sents: DataFrame, tokenizer: Callable[[Column], Column] = T.word_tokenize) -> DataFrame:
    """Long form: ``(doc_id, sentence_index, token_index, token)``."""
    return sents.select(
        "doc_id", "sentence_index", F.posexplode(tokenizer(F.col("sentence"))).alias("token_index", "token")
    )


def token_offsets(sents: DataFrame, pattern: str = T.WORDPUNCT) -> DataFrame:
    """Tokens with code-point offsets inside their sentence (and document, if ``start_char`` is given)."""
    spans = sents.select(
        "doc_id",
        "sentence_index",
        *(["start_char"] if "start_char" in sents.columns else []),
        F.posexplode(T.spans_of(F.col("sentence"), pattern)).alias("token_index", "s"),
    )
    base = F.col("start_char") if "start_char" in sents.columns else F.lit(0)
    return spans.select(
        "doc_id",
        "sentence_index",
        "token_index",
        "s.token",
        (base + F.col("s.start")).alias("start_char"),
        (base + F.col("s.end")).alias("end_char"),
    )


def normalize_corpus(docs: DataFrame) -> DataFrame:
    """Documents with normalised Arabic spelling."""
    return docs.withColumn("text", normalize_arabic(F.col("text")))


def previews(docs: DataFrame, chars: int = C.PREVIEW_CHARS, tail: str = C.PREVIEW_TAIL) -> DataFrame:
    """The first characters of every document."""
    return docs.select("doc_id", T.preview(F.col("text"), chars, tail).alias("preview"))


def first_articles(docs: DataFrame, n: int) -> DataFrame:
    """The first ``n`` documents in article order, those without an id first.

    A top-k over the ids alone finds the bound; then only texts up to it are read.
    """
    ids = docs.select("doc_id").orderBy("doc_id").limit(n)
    last, unnamed = ids.agg(F.max("doc_id"), F.count(F.when(F.col("doc_id").isNull(), 1))).first()
    upto = F.col("doc_id") <= F.lit(last)
    return docs.where(F.col("doc_id").isNull() | upto if unnamed else upto).orderBy("doc_id").limit(n)


def nth_article(docs: DataFrame, position: int) -> DataFrame:
    """The document at a 0-based position in article order; no row if there are fewer.

    Documents without an id come first. Those with the same id are ordered by their other columns.
    """
    first = docs.select("doc_id").orderBy("doc_id").limit(position + 1)
    found = docs.select("doc_id").orderBy("doc_id").offset(position).limit(1).collect()
    if not found:
        return docs.limit(0)
    name = found[0][0]
    same = F.col("doc_id").isNull() if name is None else F.col("doc_id") == F.lit(name)
    before = first.where(same).count() - 1
    chosen = docs.where(same)
    return chosen.orderBy(*docs.columns).offset(before).limit(1)


def corpus_counts(docs: DataFrame) -> DataFrame:
    """Articles, sentences and tokens per language; sized inside each row, so nothing is exploded."""
    sized = docs.select(
        "lang",
        F.size(T.split_sentences(F.col("text"))).alias("sentences"),
        F.size(T.wordpunct_tokenize(F.col("text"))).alias("tokens"),
    )
    return sized.groupBy("lang").agg(
        F.count(F.lit(1)).alias("articles"),
        F.sum("sentences").alias("sentences"),
        F.sum("tokens").alias("tokens"),
    )
