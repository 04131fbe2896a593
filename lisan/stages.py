"""The operators as ``pyspark.ml`` stages over annotation columns, to be put in a Pipeline, fitted, saved and loaded.

An annotation column is array<struct<begin, end, result, sentence>>: the first and last character in the document, the
text or tag, and the number of its sentence.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lisan.functions import tags as G
from lisan.functions import text as T
from lisan.functions.arrays import let, positions
from lisan.operators import learning, tagging

SPLITTERS = {"plain": T.sentence_spans, "arabic": T.arabic_sentence_spans}
PATTERNS = {"wordpunct": T.WORDPUNCT, "simple": T.SIMPLE_WORD}
TAGGERS = {"english": tagging.ENGLISH, "arabic": tagging.ARABIC}


def annotation(begin: Column, end: Column, result: Column, sentence: Column) -> Column:
    return F.struct(
        begin.cast("int").alias("begin"), end.cast("int").alias("end"), result.alias("result"), sentence.cast("int").alias("sentence")
    )


class _Stage(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose output column is an expression over its input column: no shuffle."""

    def _annotated(self, column: Column) -> Column:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), self._annotated(F.col(self.getInputCol())))


class DocumentAssembler(_Stage):
    """A text column as one annotation; null and empty texts have none."""

    @keyword_only
    def __init__(self, *, inputCol: str = "text", outputCol: str = "document"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol="text", outputCol="document")

    def _annotated(self, column: Column) -> Column:
        whole = F.array(annotation(F.lit(0), F.length(column) - 1, column, F.lit(0)))
        return F.when(F.length(column) > 0, whole).otherwise(F.slice(whole, 1, 0))


class SentenceDetector(_Stage):
    """The sentences of documents; ``rules`` is plain or arabic."""

    rules = Param(Params._dummy(), "rules", "how sentences end", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol: str = "document", outputCol: str = "sentence", rules: str = "plain"):
        super().__init__()
        self._setDefault(inputCol="document", outputCol="sentence", rules="plain")
        self._set(**self._input_kwargs)

    def _annotated(self, column: Column) -> Column:
        split = SPLITTERS[self.getOrDefault(self.rules)]
        pieces = F.flatten(F.transform(column, lambda d: split(d["result"])))
        start = lambda s: s["start_char"]
        return F.transform(
            pieces, lambda s, i: annotation(start(s), start(s) + F.length(s["sentence"]) - 1, s["sentence"], i)
        )


class Tokenizer(_Stage):
    """The tokens of sentences; ``kind`` is wordpunct or simple."""

    kind = Param(Params._dummy(), "kind", "what a token is", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol: str = "sentence", outputCol: str = "token", kind: str = "wordpunct"):
        super().__init__()
        self._setDefault(inputCol="sentence", outputCol="token", kind="wordpunct")
        self._set(**self._input_kwargs)

    def _annotated(self, column: Column) -> Column:
        pattern = PATTERNS[self.getOrDefault(self.kind)]

        def tokens(s: Column) -> Column:
            return F.transform(
                T.spans_of(s["result"], pattern),
                lambda t: annotation(s["begin"] + t["start"], s["begin"] + t["end"] - 1, t["token"], s["sentence"]),
            )

        return F.flatten(F.transform(column, tokens))


class TableTagger(_Stage):
    """Tags of tokens by the tables of a language, english or arabic, context rules included."""

    language = Param(Params._dummy(), "language", "whose tables", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol: str = "token", outputCol: str = "pos", language: str = "english"):
        super().__init__()
        self._setDefault(inputCol="token", outputCol="pos", language="english")
        self._set(**self._input_kwargs)

    def _annotated(self, column: Column) -> Column:
        tagger = TAGGERS[self.getOrDefault(self.language)]

        def tagged(ts: Column) -> Column:
            # A null tag before each sentence, so that no rule looks across.
            def opened(tag: Column, i: Column) -> Column:
                new = F.get(ts, i)["sentence"] != F.coalesce(F.get(ts, i - 1)["sentence"], F.lit(-1))
                return F.when(new, F.array(F.lit(None).cast("string"), tag)).otherwise(F.array(tag))

            base = F.flatten(F.transform(tagger.base_tags(F.transform(ts, lambda t: t["result"])), opened))
            tags = F.filter(G.apply_context_rules(base, tagger.context), lambda t: t.isNotNull())
            return F.zip_with(ts, tags, lambda t, tag: annotation(t["begin"], t["end"], tag, t["sentence"]))

        return let(column, lambda ts: F.when(F.size(ts) > 0, tagged(ts)).otherwise(ts))


class _LearnedParams(HasInputCol, HasOutputCol):
    idCol = Param(Params._dummy(), "idCol", "what names a row, once each", TypeConverters.toString)


class TagLearner(Estimator, _LearnedParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns tags of tokens from a column of gold tags, annotations like the tokens', one for one."""

    goldCol = Param(Params._dummy(), "goldCol", "the gold tags", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol: str = "token", outputCol: str = "pos", goldCol: str = "gold", idCol: str = "doc_id"):
        super().__init__()
        self._setDefault(inputCol="token", outputCol="pos", goldCol="gold", idCol="doc_id")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TagLearnerModel:
        tokens, gold = (self.getOrDefault(p) for p in (self.inputCol, self.goldCol))
        pairs = F.arrays_zip(F.col(tokens).alias("token"), F.col(gold).alias("gold"))
        rows = dataset.select(F.col(self.getOrDefault(self.idCol)).alias("doc_id"), F.posexplode(pairs).alias("at", "x"))
        by = rows.groupBy("doc_id", F.col("x.token.sentence").alias("sentence_index"))
        found = by.agg(F.sort_array(F.collect_list(F.struct("at", F.col("x.token.result").alias("token"), F.col("x.gold.result").alias("tag")))).alias("s"))
        model = learning.train_tagger(found.select(F.col("s.token").alias("tokens"), F.col("s.tag").alias("tags")))
        return self._copyValues(TagLearnerModel(model))


class TagLearnerModel(Model, _LearnedParams, MLReadable, MLWritable):
    """Tags the tokens of each sentence by the cheapest path of a learned model; rows are named by ``idCol``."""

    def __init__(self, model: learning.TagModel | None = None):
        super().__init__()
        self._setDefault(inputCol="token", outputCol="pos", idCol="doc_id")
        self.model = model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name, tokens = self.getOrDefault(self.idCol), self.getInputCol()
        rows = dataset.select(F.col(name).alias("doc_id"), F.posexplode(tokens).alias("at", "t"))
        some = F.sort_array(F.collect_list(F.struct("at", "t")))
        sentences = rows.groupBy("doc_id", F.col("t.sentence").alias("sentence_index")).agg(some.alias("s"))
        tagged = learning.viterbi_tags(sentences.select("doc_id", "sentence_index", F.col("s.t.result").alias("tokens")), self.model)
        whole = tagged.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("sentence_index", "tags"))).alias("found"))
        tags = F.flatten(F.transform("found", lambda s: s["tags"]))
        pos = F.zip_with(tokens, tags, lambda t, tag: annotation(t["begin"], t["end"], tag, t["sentence"]))
        whole = whole.withColumnRenamed("doc_id", "__of")
        joined = dataset.join(whole, F.col(name) == F.col("__of"), "left")
        out = F.when(F.size(tokens) > 0, pos).otherwise(F.col(tokens))
        return joined.withColumn(self.getOutputCol(), out).drop("__of", "found")

    def write(self) -> MLWriter:
        return _TagWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TagReader()


class _TagWriter(MLWriter):
    def __init__(self, instance: TagLearnerModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.model.save(f"{path}/model")


class _TagReader(MLReader):
    def load(self, path: str) -> TagLearnerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = TagLearnerModel(learning.TagModel.load(self.sparkSession, f"{path}/model"))
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        return out


def annotation_rows(annotated: DataFrame, tokens: str = "token", tags: str = "pos", id_column: str = "doc_id") -> DataFrame:
    """``(article_index, sentence_index, token_index, token, pos)`` of token and tag annotations."""
    ts = F.col(tokens)

    def numbered(sentences: Column) -> Column:
        opens = lambda i: (i == 0) | ~F.get(sentences, i).eqNullSafe(F.get(sentences, i - 1))
        return let(F.filter(positions(sentences), opens), lambda starts: runs(sentences, starts))

    def runs(sentences: Column, starts: Column) -> Column:
        """Tokens are numbered run by run of one sentence; a sentence of several runs counts from its first one."""
        own = F.transform(starts, lambda s: F.get(sentences, s))

        def tokens_of(s: Column, k: Column, first: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(ts))
            return F.transform(
                F.slice(ts, s + 1, end - s),
                lambda t, i: F.struct(
                    t["sentence"].alias("sentence_index"), (s - first + i).alias("token_index"), t["result"].alias("token"),
                    F.get(F.col(tags), s + i)["result"].alias("pos"),
                ),
            )

        once = F.transform(starts, lambda s, k: tokens_of(s, k, F.when(F.get(sentences, s).isNotNull(), s)))
        again = lambda of: F.transform(
            starts, lambda s, k: tokens_of(s, k, F.get(starts, F.array_position(of, F.get(sentences, s)).cast("int") - 1))
        )
        each = let(own, lambda of: F.when(F.size(F.array_distinct(of)) == F.size(of), once).otherwise(again(of)))
        return F.flatten(each)

    numbers = let(F.transform(ts, lambda t: t["sentence"]), numbered)
    return annotated.select(F.col(id_column).alias("article_index"), F.inline(numbers))
