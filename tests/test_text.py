from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from lisan.functions import text as T
from lisan.functions.arabic import normalize_arabic
from lisan.functions.arrays import running_totals
from lisan.operators import corpus
from lisan.sources.jsonl import from_texts

LITTLE = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_word_tokens(value):
    text = (
        'They can\'t, won\'t; I\'d say "yes" (it\'s 3,000: ok)... cannot --gonna-- well-known U.S.A. end.'
    )
    expected = (
        "They ca n't , wo n't ; I 'd say `` yes '' ( it 's 3,000 : ok ) ... can not -- gon na -- "
        "well-known U.S.A. end ."
    )
    assert value(T.word_tokenize, text) == expected.split()


PLAIN_EDGES = [
    "a,b 1,000 ,5 x, y: z:9 3,.", "foo.,", "foo.;", "foo.:", "foo. ", "foo.\n", ".", " . ", "", "U.S.A. end", "a.b.?", "-x- _y_ *",
    "été, naïve; e\u0301a, 10² 50% #1 a@b.c", "GIMME that", "can Cannot", "gonna, wanna.", "lemme?", "a,,b", "a..", "a--b", "x\xa0y.",
    "it's", 'a "b" c', "(a, b).", "x\x1cy,\x85z", "$5.00!", "a , b . ", "\tq,\r\n7", "?!", "x:,y", ",", "a,", "9,", "9, 9", "w" * 3000 + ", v.1 " * 30000,
]


def test_plain_sentences_are_read_as_by_the_rules(spark):
    made = spark.createDataFrame([(s,) for s in [*PLAIN_EDGES, None]], "s string")
    rows = made.select("s", T.word_tokenize(F.col("s")).alias("once"), T._rule_tokens(F.col("s")).alias("rules")).collect()
    assert [r["s"] for r in rows if r["once"] != r["rules"]] == []


@LITTLE
@given(st.lists(st.text(alphabet="aAé9.,:;?!-_ \n\t'\"()no", max_size=30), min_size=1, max_size=40))
def test_any_sentence_is_read_as_by_the_rules(spark, texts):
    made = spark.createDataFrame([(s,) for s in texts], "s string").coalesce(1)
    rows = made.select("s", T.word_tokenize(F.col("s")).alias("once"), T._rule_tokens(F.col("s")).alias("rules")).collect()
    assert [r["s"] for r in rows if r["once"] != r["rules"]] == []


def test_word_tokens_edges(value):
    assert value(T.word_tokenize, '"Quoted"') == ["``", "Quoted", "''"]
    assert value(T.word_tokenize, "dogs' bones") == ["dogs", "'", "bones"]
    assert value(T.word_tokenize, "!!!") == ["!", "!", "!"]
    assert value(T.word_tokenize, "") == []
    assert value(T.word_tokenize, "end (see here.)") == ["end", "(", "see", "here", ".", ")"]


def test_sentences(value):
    text = " Dr. Smith met Mrs. Jones. Really? Yes!  They e.g. ran.\nEnd"
    assert value(T.split_sentences, text) == [
        "Dr. Smith met Mrs. Jones.", "Really?", "Yes!", "They e.g. ran.", "End",
    ]
    assert value(T.split_sentences, "") == []
    assert value(T.split_sentences, " \n ") == []


def test_sentence_ends(value):
    cases = {
        "J. K. Rowling wrote it. It sold.": ["J. K. Rowling wrote it.", "It sold."],
        "The U.S. Army came. It left.": ["The U.S. Army came.", "It left."],
        "On Jan. 5 we met approx. 5 men. Then we left.": ["On Jan. 5 we met approx. 5 men.", "Then we left."],
        'He said "Go home." Then he left.': ['He said "Go home."', "Then he left."],
        "(It rains now.) Yes. Go": ["(It rains now.)", "Yes.", "Go"],
        "They sold Acme Inc. The buyer paid.": ["They sold Acme Inc.", "The buyer paid."],
        "It cost 5 lb. of tea at Acme Co. in May.": ["It cost 5 lb. of tea at Acme Co. in May."],
        "“Really?” Yes!’ No": ["“Really?”", "Yes!’", "No"],
    }
    for text, expected in cases.items():
        assert value(T.split_sentences, text) == expected


def test_newer_word_rules(value):
    cases = {
        "“Hello” she said": "“ Hello ” she said",
        "wait.. what....": "wait .. what ....",
        "gimme that, lemme go": "gim me that , lem me go",
        "'tis true, 'twas d'ye see": "'t is true , 't was d 'ye see",
        "home time meme": "home time meme",
    }
    for text, expected in cases.items():
        assert value(T.word_tokenize, text) == expected.split()


def test_sentence_offsets(spark):
    text = "  One two.  Three!\n\nFour \x01 five? Six "
    docs = from_texts(spark, [text], "en")
    rows = corpus.located_sentences(docs).collect()
    assert [r.sentence for r in rows] == ["One two.", "Three!", "Four \x01 five?", "Six"]
    assert all(text[r.start_char:].startswith(r.sentence) for r in rows)


def test_arabic_sentences(value):
    text = "مرحبا! كيف؟ نعم. لا\nثم? هذا"
    assert value(T.split_arabic_sentences, text) == ["مرحبا", "كيف", "نعم", "لا", "ثم? هذا"]
    assert value(T.first_arabic_piece, text) == "مرحبا"
    assert value(T.first_arabic_piece, ".a") == ""


def test_normalize_arabic(value):
    text = "إلى المدرسةِ أُسْتاذ مسؤول قارئ ـــ آخر"
    once = value(normalize_arabic, text)
    assert once == "الي المدرسه استاذ مسوول قاري  اخر"
    assert value(normalize_arabic, once) == once


def test_null_text(spark):
    x = F.col("x")
    row = spark.createDataFrame([(None,)], "x string").select(
        T.split_sentences(x).alias("a"), T.word_tokenize(x).alias("b"), normalize_arabic(x).alias("c")
    )
    assert tuple(row.first()) == (None, None, None)


def test_preview(value):
    assert value(T.preview, "a" * 200) == "a" * 150 + "..."


@LITTLE
@given(st.text(alphabet=st.sampled_from("ab éَش٣_.,!؟  \n\t\x01😀-"), max_size=40))
def test_wordpunct_is_the_python_pattern(value, text):
    assert value(T.wordpunct_tokenize, text) == re.findall(r"\w+|[^\w\s]+", text)


@LITTLE
@given(st.text(alphabet=st.sampled_from("ab éَش.,!\n\x01😀"), max_size=60))
def test_offsets_point_at_tokens(value, text):
    spans = value(lambda x: T.spans_of(x, T.WORDPUNCT), text)
    assert [s.token for s in spans] == re.findall(r"\w+|[^\w\s]+", text)
    assert all(text[s.start:s.end] == s.token for s in spans)


def test_running_totals(value):
    numbers = list(range(1, 1000))
    totals = value(lambda: running_totals(F.sequence(F.lit(1), F.lit(999))))
    assert totals == [sum(numbers[: i + 1]) for i in range(len(numbers))]
    assert value(lambda: running_totals(F.array().cast("array<int>"))) == []


def test_long_sentence_offsets(spark):
    text = "w1, " * 30_000
    docs = from_texts(spark, [text], "en")
    offsets = corpus.token_offsets(corpus.located_sentences(docs))
    assert offsets.count() == 60_000
    assert offsets.agg(F.max("end_char")).first()[0] == len(text) - 1
    assert offsets.where("token_index = 59999").first().start_char == len(text) - 2


def test_functions_work_on_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"doc_id": 7, "text": "One. Two three."}\n', encoding="utf-8")
    stream = spark.readStream.schema("doc_id bigint, text string").json(str(folder))
    query = (
        corpus.tokens(corpus.sentences(stream))
        .writeStream.format("memory")
        .queryName("streamed_tokens")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    tokens = [r.token for r in spark.table("streamed_tokens").orderBy("sentence_index", "token_index").collect()]
    assert tokens == ["One", ".", "Two", "three", "."]


@pytest.mark.parametrize("ids", [[None, None, 1, 2], [3, 3, 3, 1], [None, 5, 5, None, 2], [7], []])
def test_articles_without_or_with_equal_ids(spark, ids):
    """Every position gives one document, and all positions give all; the first n are n."""
    rows = [(i, f"text {k}") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for n in range(1, len(rows) + 1):
        assert [r.doc_id for r in corpus.first_articles(docs, n).collect()] == [r[0] for r in order[:n]]
        assert [tuple(r) for r in corpus.nth_article(docs, n - 1).collect()] == [order[n - 1]]
    assert corpus.nth_article(docs, len(rows)).count() == 0
    assert corpus.first_articles(docs, len(rows) + 3).count() == len(rows)
