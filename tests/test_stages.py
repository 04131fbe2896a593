"""Stages in a pipeline, saved and loaded, against the operators."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from lisan import stages
from lisan.functions import text as T
from lisan.operators import corpus, learning, tagging

TEXTS = ["The big dog runs. It can run! (Yes.) The dog, the dog", "", None, "   ", "One. Two three's end?\n\nThe the"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, f"x{i}") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, lang string")


def parts(language: str = "english") -> list:
    return [
        stages.DocumentAssembler(), stages.SentenceDetector(), stages.Tokenizer(kind="wordpunct"),
        stages.TableTagger(language=language, outputCol="pos"),
    ]


def test_annotations_lie_in_the_text(docs, tmp_path):
    Pipeline(stages=parts()).fit(docs).save(str(tmp_path / "p"))
    rows = PipelineModel.load(str(tmp_path / "p")).transform(docs).collect()
    assert len(rows) == len(TEXTS) and rows[0].asDict().keys() >= {"doc_id", "lang", "document", "sentence", "token", "pos"}
    for r in rows:
        for column in ("document", "sentence", "token"):
            for a in r[column] or []:
                assert r.text[a.begin : a.end + 1] == a.result
        assert [(t.begin, t.sentence) for t in r.token or []] == [(p.begin, p.sentence) for p in r.pos or []]
    assert [s.result for s in rows[0].sentence] == ["The big dog runs.", "It can run!", "(Yes.)", "The dog, the dog"]


def test_tags_are_those_of_the_tagger(docs):
    annotated = Pipeline(stages=parts()).fit(docs).transform(docs)
    got = stages.annotation_rows(annotated).collect()
    own = tagging.Tagger(T.wordpunct_tokenize, *[getattr(tagging.ENGLISH, f) for f in ("lexicon", "shapes", "default", "context")])
    want = tagging.pos_table(corpus.sentences(docs), own).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 20


def test_a_learned_stage_is_saved_and_loaded(spark, docs, tmp_path):
    annotated = Pipeline(stages=[*parts()[:3], stages.TableTagger(outputCol="gold")])
    learner = stages.TagLearner(goldCol="gold", outputCol="learned")
    fitted = Pipeline(stages=[annotated, learner]).fit(docs)
    fitted.save(str(tmp_path / "p"))
    loaded = PipelineModel.load(str(tmp_path / "p"))
    assert loaded.stages[-1].uid == fitted.stages[-1].uid
    rows = loaded.transform(docs).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == list(range(len(TEXTS)))
    gold = annotated.fit(docs).transform(docs)
    sentences = gold.select("doc_id", F.posexplode("sentence").alias("sentence_index", "s"), "token", "gold")
    inside = lambda c: F.transform(F.filter(c, lambda t: t["sentence"] == F.col("sentence_index")), lambda t: t["result"])
    sentences = sentences.select("doc_id", "sentence_index", inside("token").alias("tokens"), inside("gold").alias("tags"))
    found = learning.viterbi_tags(sentences, learning.train_tagger(sentences)).orderBy("doc_id", "sentence_index").collect()
    want: dict = {}
    for f in found:
        want.setdefault(f.doc_id, []).extend(f.tags)
    assert {r.doc_id: [a.result for a in r.learned] for r in rows if r.learned} == want
    assert [a.begin for a in rows[0].learned] == [a.begin for a in rows[0].token]


def test_no_documents(spark, docs):
    model = Pipeline(stages=parts()).fit(docs)
    assert model.transform(docs.limit(0)).count() == 0


def test_a_long_document_is_numbered_in_a_time_in_proportion(spark):
    """A document of 60,000 tokens: work for each token over all tokens took minutes."""
    import time

    text = "the dog runs. " * 15_000
    docs = spark.createDataFrame([(1, text, "en")], "doc_id bigint, text string, lang string")
    annotated = Pipeline(stages=parts()).fit(docs).transform(docs)
    start = time.monotonic()
    rows = stages.annotation_rows(annotated)
    found = rows.groupBy("token_index", "token").count().collect()
    assert {(r.token_index, r.token): r["count"] for r in found} == {(0, "the"): 15_000, (1, "dog"): 15_000, (2, "runs"): 15_000, (3, "."): 15_000}
    assert time.monotonic() - start < 60


def test_tokens_count_from_the_first_token_of_their_sentence(spark):
    """Also where the tokens of a sentence do not lie together, or name none."""
    token = "array<struct<begin:int,end:int,result:string,sentence:int>>"
    ts = [(0, 0, "a", 0), (2, 2, "b", 1), (4, 4, "c", 1), (6, 6, "d", 0), (8, 8, "e", None)]
    df = spark.createDataFrame([(1, ts, ts), (2, [], []), (3, None, None), (4, ts[:3], ts[:2])], f"doc_id bigint, token {token}, pos {token}")
    rows = [tuple(r) for r in stages.annotation_rows(df).orderBy("article_index", "token").collect()]
    assert rows == [
        (1, 0, 0, "a", "a"), (1, 1, 0, "b", "b"), (1, 1, 1, "c", "c"), (1, 0, 3, "d", "d"), (1, None, None, "e", "e"),
        (4, 0, 0, "a", "a"), (4, 1, 0, "b", "b"), (4, 1, 1, "c", None),
    ]
