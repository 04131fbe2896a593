from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lisan.data import tables
from lisan.functions import tags as G
from lisan.operators import corpus, evaluate, tagging
from lisan.sources.jsonl import from_texts


def chunks(value, tags):
    found = value(lambda w, t: G.np_chunks(w, t), [f"w{i}" for i in range(len(tags))], tags)
    return [(c.start_token, c.end_token) for c in found]


def test_noun_phrases(value):
    assert chunks(value, "DT JJ JJ NN VBZ IN DT JJ NNS .".split()) == [(0, 4), (6, 9)]
    assert chunks(value, "DT DT NN NNP".split()) == [(1, 4)]
    assert chunks(value, ["JJ", "JJ"]) == []
    assert chunks(value, ["VB"]) == []


def test_chunk_tree(value):
    tree = value(G.chunk_tree, "The quick fox jumps over dogs .".split(), "DT JJ NN VBZ IN NNS .".split())
    assert tree == "(S (NP The/DT quick/JJ fox/NN) jumps/VBZ over/IN (NP dogs/NNS) ./.)"
    assert value(G.chunk_tree, ["Run"], ["VB"]) == "(S Run/VB)"


def test_context_rules_run_in_order(value):
    rules = [("TO", "NN", None, "VB"), ("VB", "VBD", "NN", "JJ")]
    assert value(lambda t: G.apply_context_rules(t, rules), ["TO", "NN", "VBD", "NN"]) == ["TO", "VB", "JJ", "NN"]
    assert value(lambda t: G.apply_context_rules(t, rules), ["NN"]) == ["NN"]


def test_english_sentence(spark):
    sents = corpus.sentences(from_texts(spark, ["The quick brown fox jumps over the lazy dog."], "en"))
    row = tagging.tagged_sentences(sents).first()
    assert row.tokens == "The quick brown fox jumps over the lazy dog .".split()
    gold = ["DT", "JJ", "JJ", "NN", "VBZ", "IN", "DT", "JJ", "NN", "."]
    assert [g == t for g, t in zip(gold, row.tags)].count(True) == 8


def test_arabic_sentence(spark):
    sents = corpus.sentences(from_texts(spark, ["زار محمد بن سلمان مدينة الرياض اليوم."], "ar"))
    row = tagging.tagged_sentences(sents, tagging.ARABIC).first()
    gold = ["VERB", "PROPN", "PROPN", "PROPN", "NOUN", "PROPN", "NOUN", "PUNCT"]
    assert row.tags == gold


def test_lexicon_training(spark):
    gold = spark.createDataFrame(
        [("Run", "VB"), ("run", "NN"), ("run", "NN"), ("a", "X"), ("a", "DT")], "token string, tag string"
    )
    assert {tuple(r) for r in tagging.train_lexicon(gold).collect()} == {("run", "NN", 2), ("a", "DT", 1)}


@pytest.mark.parametrize("small", [True, False])
def test_table_tagging_equals_array_tagging(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(tagging, "broadcast_if_small", lambda df: df)
    sents = corpus.sentences(from_texts(spark, ["The dogs will bark. To boldly go!", "She wanted a painted door"], "en"))
    words = [(w, tag) for tag, ws in tables.ENGLISH_LEXICON.items() for w in ws]
    lexicon = spark.createDataFrame(words, "token string, tag string")
    rows = tagging.token_tags(tagging.tag_with_lexicon(corpus.tokenized(sents), lexicon))
    table = tagging.pos_table(sents)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, table.collect()))


def test_self_confusion_is_diagonal(spark):
    sents = corpus.sentences(from_texts(spark, ["The dogs bark at 7, loudly."], "en"))
    tags = tagging.tagged_sentences(sents).select(F.explode("tags").alias("gold"))
    matrix = evaluate.confusion_matrix(tags.withColumn("pred", F.col("gold"))).collect()
    assert all((r.n > 0) == (r.gold == r.pred) for r in matrix)
    assert sum(r.n for r in matrix) == tags.count()


def test_scores_against_given_gold(spark):
    gold = spark.createDataFrame(
        [(["The", "dogs", "bark", "."], ["DT", "NNS", "VBP", "."])], "tokens array<string>, gold array<string>"
    )
    pairs = tagging.tag_pairs(gold)
    assert pairs.count() == 4
    assert evaluate.prf1(pairs).first().tp >= 2
    with pytest.raises(Exception, match="Gold and Pred must be same length"):
        tagging.tag_pairs(gold.withColumn("gold", F.array(F.lit("DT")))).collect()


def test_shapes_that_need_another_beginning_are_told_apart():
    assert [G._may_open_low(kind, value) for kind, value, _ in tables.ENGLISH_SHAPES] == [False, *[True] * 12, False, False]
    patterns = [r"^[0-9]*a", r"^[A-Z]|x", r"^[^a-y]", r"(?i)^[A-Z]", r"^[A-Z]?b", r"[0-9]", r"^[\p{N}a]"]
    assert all(G._may_open_low("pattern", p) for p in patterns)


def test_tags_by_shape_on_every_beginning(spark):
    tokens = ["under", "Running", "9ing", "ÉTÉ", "élan", "{", "`a", "12.5", "--", "", "zing", "a9", "ß", "x-1", "The", "THE", "that"]
    made = spark.createDataFrame([(tokens,)], "ts array<string>")
    found = made.select(tagging.ENGLISH.base_tags(F.col("ts"))).first()[0]
    assert found == "IN NNP VBG NNP NN ( NN CD : NN VBG NN NN NN DT DT IN".split()


def test_a_word_of_two_tags_has_the_first(spark):
    made = spark.createDataFrame([(["a", "b", "c", "d", "e"],)], "ts array<string>")
    lexicon = {"X": ["a"], "Y": [], "Z": ["b", "c"], "U": ["c", "a"], "V": ["d", "c"]}
    assert made.select(G.tag_tokens(F.col("ts"), lexicon, [], "N")).first()[0] == ["X", "Z", "Z", "V", "N"]


def test_only_words_that_are_not_held_become_rows(spark, monkeypatch):
    """Sentences of one name, names that are null and tokens that hold the sign between tokens, with few and many places."""
    monkeypatch.setattr(tagging, "broadcast_if_small", lambda df: df)
    rows = [
        (1, 0, ["The", "dog", "the", "zebra"]), (1, 0, ["The", "cat"]), (None, 0, ["a", "the"]), (None, 0, ["the", "b"]),
        (2, 0, []), (2, 1, ["x\x1fy", "dog"]), (3, 0, [""]), (4, 0, ["dog"] * 200),
    ]
    sents = spark.createDataFrame(rows, "doc_id bigint, sentence_index int, tokens array<string>").withColumn("mark", F.lit("m"))
    table = {"the": ("DT", 9), "dog": ("NN", 5), "cat": ("NN", 1), "x\x1fy": ("SYM", 1), "w" * 100: ("NN", 9)}
    words = spark.createDataFrame([(w, *v) for w, v in table.items()], "word string, value string, n bigint")
    want = {}
    for doc, at, tokens in rows:
        want.setdefault((doc, at), []).extend((i, t, table.get(t.lower(), (None,))[0]) for i, t in enumerate(tokens))
    want = {k: sorted(v, key=lambda x: x[:2]) for k, v in want.items() if v}
    joined = []
    inner = type(sents).join
    monkeypatch.setattr(type(sents), "join", lambda self, other, *a: joined.append(self) or inner(self, other, *a))
    for places, most in ((1, 208), (1 << 10, 6)):
        monkeypatch.setattr(tagging, "HELD_PLACES", places)
        got = tagging.looked_up(sents, words).collect()
        assert {(r.doc_id, r.sentence_index): [tuple(x) for x in r.found] for r in got} == want
        assert len(got) == len(want) and all(r.mark == "m" for r in got)
        assert next(df for df in joined if "token_index" in df.columns).count() <= most
        joined.clear()
