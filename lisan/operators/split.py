"""Train/test split by position in the corpus."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lisan import constants as C
from lisan.functions import text as T

_BITS = 12


@dataclass(frozen=True)
class Cut:
    """Where the test part starts: ``sentence_index`` in ``doc_id``; no document if the corpus is empty."""

    total: int
    train: int
    doc_id: int | None
    sentence_index: int

    @property
    def in_train(self) -> Column:
        """Whether a sentence row lies before the cut. The bound on doc_id alone reaches the scan."""
        if self.doc_id is None:
            return F.lit(True)
        earlier = F.col("doc_id") < self.doc_id
        return (F.col("doc_id") <= self.doc_id) & (earlier | (F.col("sentence_index") < self.sentence_index))

    @property
    def in_test(self) -> Column:
        """Whether a sentence row lies at or after the cut."""
        if self.doc_id is None:
            return F.lit(False)
        later = F.col("doc_id") > self.doc_id
        return (F.col("doc_id") >= self.doc_id) & (later | (F.col("sentence_index") >= self.sentence_index))


def locate_cut(sizes: DataFrame, share: float = C.TRAIN_SHARE) -> Cut:
    """Find the sentence at position ``int(total * share)`` from ``(doc_id, n)`` rows.

    The first sentences in article order are a range of keys, so the split is one key: no row needs a
    number and no global sort is made. The key is found by histograms of n over ever narrower ranges
    of doc_id. Each has at most 8,192 buckets, whatever the ids look like, and a corpus of any size
    needs at most six of them. Only (doc_id, n) is kept between the passes.
    """
    kept = sizes.select("doc_id", "n").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first, last, total = kept.agg(F.min("doc_id"), F.max("doc_id"), F.sum("n")).first()
        total = total or 0
        train = int(total * share)
        if train >= total:
            return Cut(total, train, None, 0)
        before, bits = 0, max((last - first).bit_length() - _BITS, 0)
        while True:
            bucket = F.shiftright("doc_id", bits)
            histogram = sorted(
                kept.where(F.col("doc_id").between(first, last) & (F.col("n") > 0))
                .groupBy(bucket.alias("bucket"))
                .agg(F.sum("n").alias("n"))
                .collect()
            )
            upto = accumulate((n for _, n in histogram), initial=before)
            chosen, n, before = next(
                (key, n, start) for (key, n), start in zip(histogram, upto) if start + n > train
            )
            if bits == 0:
                return Cut(total, train, chosen, train - before)
            first, last = chosen << bits, ((chosen + 1) << bits) - 1
            bits = max(bits - _BITS, 0)
    finally:
        kept.unpersist()


def sentence_counts(docs: DataFrame, splitter: Callable[[Column], Column] = T.split_sentences) -> DataFrame:
    """``(doc_id, n)``: sentences per document, without exploding them."""
    return docs.select("doc_id", F.size(splitter(F.col("text"))).alias("n"))


def train_test_split_positional(sents: DataFrame, cut: Cut) -> tuple[DataFrame, DataFrame]:
    """The sentence rows before the cut and those from the cut on."""
    return sents.where(cut.in_train), sents.where(cut.in_test)
