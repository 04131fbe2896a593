from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lisan.functions import text as T
from lisan.operators import bigrams, corpus, generate, split
from lisan.sources.jsonl import from_texts


def brute_force(sentences: list[list[str]], boundaries: bool) -> tuple[int, float | None]:
    """Vocabulary size and perplexity of an add-one bigram model, word by word."""
    at = int(len(sentences) * 0.8)
    train = [["<s>", *s, "</s>"] for s in sentences[:at]]
    test = [["<s>", *s, "</s>"] if boundaries else s for s in sentences[at:]]
    vocab = {w for s in train for w in s}
    pairs = Counter(p for s in train for p in zip(s, s[1:]))
    contexts = Counter(p[0] for s in train for p in zip(s, s[1:]))
    v = len(vocab) + 1
    seen = [p for s in test for p in zip(s, s[1:])]
    known = lambda w: w if w in vocab else "<UNK>"
    logs = [
        math.log2((pairs[known(a), known(b)] + 1) / (contexts[known(a)] + v)) for a, b in seen
    ]
    return v, 2 ** (-sum(logs) / len(logs)) if logs else None


def texts(n: int, seed: int = 0) -> list[str]:
    """Random documents in which one word makes up a third of all tokens and some are empty."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    sentence = lambda: " ".join(
        "hot" if draw.random() < 0.33 else draw.choice(words) for _ in range(draw.randint(1, 9))
    )
    return [". ".join(sentence() for _ in range(draw.randint(1, 6))) + "." if i % 7 else "" for i in range(n)]


def fitted(docs, boundaries: bool):
    cut = split.locate_cut(split.sentence_counts(docs))
    tokens = corpus.tokenized(corpus.sentences(docs), T.wordpunct_tokenize)
    return bigrams.count_grams(tokens, cut, boundaries), cut


def python_sentences(docs) -> list[list[str]]:
    rows = corpus.tokenized(corpus.sentences(docs), T.wordpunct_tokenize).orderBy("doc_id", "sentence_index")
    return [r.tokens for r in rows.collect()]


@pytest.mark.parametrize("boundaries", [True, False])
def test_perplexity_by_brute_force(spark, boundaries):
    docs = from_texts(spark, texts(60), "en")
    grams, cut = fitted(docs, boundaries)
    v, expected = brute_force(python_sentences(docs), boundaries)
    row = bigrams.model_summary(grams, cut).first()
    assert row.vocabulary == v
    assert row.perplexity == pytest.approx(expected, rel=1e-12)
    assert row.train_sentences + row.test_sentences == row.sentences


def test_summary_agrees_with_scores(spark):
    grams, cut = fitted(from_texts(spark, texts(50, seed=3), "en"), True)
    mean = F.sum(F.col("m") * F.log2("score")) / F.sum("m")
    scored = bigrams.score_test_bigrams(grams).agg(F.pow(F.lit(2.0), -mean)).first()[0]
    assert scored == pytest.approx(bigrams.perplexity(grams, cut).first().perplexity, rel=1e-12)


def test_probabilities_sum_to_one(spark):
    grams, _ = fitted(from_texts(spark, texts(50), "en"), True)
    vocab = bigrams.vocabulary(grams)
    v = bigrams.vocabulary_size(vocab).first().v
    context_n = bigrams.context_counts(grams).where("context = 'hot'").first().n
    known = {r.word: r.n for r in bigrams.bigram_counts(grams).where("context = 'hot'").collect()}
    words = [r.word for r in vocab.collect()] + ["<UNK>"]
    assert sum((known.get(w, 0) + 1) / (context_n + v) for w in words) == pytest.approx(1.0)


def test_empty_corpus(spark):
    grams, cut = fitted(from_texts(spark, [], "en"), True)
    row = bigrams.model_summary(grams, cut).first()
    assert (cut.total, cut.train, row.sentences, row.test_bigrams, row.perplexity) == (0, 0, 0, 0, None)
    assert row.vocabulary == 1


def test_one_sentence_is_all_test(spark):
    grams, cut = fitted(from_texts(spark, ["Only one."], "en"), True)
    row = bigrams.model_summary(grams, cut).first()
    assert (row.train_sentences, row.test_sentences, row.test_bigrams) == (0, 1, 4)


@pytest.mark.parametrize(
    "ids",
    [
        list(range(30)),
        [-(2**63), -5, 0, 3, 2**40, 2**63 - 1],
        [10**15 + i * i for i in range(50)],
        [7],
    ],
)
@pytest.mark.parametrize("share", [0.0, 0.5, 0.8, 1.0])
def test_cut_is_the_position_split(spark, ids, share):
    draw = random.Random(len(ids))
    sizes = [(i, draw.choice([0, 1, 2, 50])) for i in ids] + [(ids[-1] - 1, 2)]
    cut = split.locate_cut(spark.createDataFrame(sizes, "doc_id bigint, n int"), share)
    order = [(doc_id, i) for doc_id, n in sorted(sizes) for i in range(n)]
    at = int(len(order) * share)
    rows = spark.createDataFrame(order, "doc_id bigint, sentence_index int")
    train, test = split.train_test_split_positional(rows, cut)
    assert sorted(map(tuple, train.collect())) == order[:at]
    assert sorted(map(tuple, test.collect())) == order[at:]


def test_grams(value):
    assert [tuple(g) for g in value(bigrams.bigrams_padded, ["a", "b"])] == [("<s>", "a"), ("a", "b"), ("b", "</s>")]
    assert [tuple(g) for g in value(bigrams.bigrams_unpadded, ["a", "b", "c"])] == [("a", "b"), ("b", "c")]
    assert value(bigrams.bigrams_unpadded, ["a"]) == []
    assert [tuple(g) for g in value(bigrams.everygrams, ["a"])] == [
        (None, "<s>"), (None, "a"), (None, "</s>"), ("<s>", "a"), ("a", "</s>"),
    ]


def test_unknown_words_are_replaced(spark):
    vocab = spark.createDataFrame([("a", 1)], "word string, n bigint")
    pairs = spark.createDataFrame([("a",), ("b",)], "w string")
    assert {tuple(r) for r in bigrams.lookup_oov(pairs, vocab, "w", "x").collect()} == {("a", "a"), ("b", "<UNK>")}


def test_greedy_generation_by_brute_force(spark):
    docs = from_texts(spark, texts(60), "en")
    grams, cut = fitted(docs, True)
    train = [["<s>", *s, "</s>"] for s in python_sentences(docs)[: cut.train]]
    unigrams = Counter(w for s in train for w in s)
    pairs = Counter(p for s in train for p in zip(s, s[1:]))

    def follow(word: str) -> str:
        seen = Counter({b: n for (a, b), n in pairs.items() if a == word}) or unigrams
        return min(seen, key=lambda w: (-seen[w], w))

    seeds = ["hot", "w3", "unknown", "</s>"]
    frame = spark.createDataFrame(list(enumerate(seeds)), "seed_id bigint, seed string")
    got = {r.seed_id: r.text for r in generate.generate_greedy(grams, frame, 6).collect()}
    for i, seed in enumerate(seeds):
        words = [seed]
        for _ in range(6):
            words.append(follow(words[-1]))
        assert got[i] == " ".join(words)


def test_sampled_words_follow_their_context(spark):
    grams, _ = fitted(from_texts(spark, texts(60), "en"), True)
    seeds = spark.createDataFrame([(i, "hot") for i in range(400)], "seed_id bigint, seed string")
    drawn = Counter(r.generated for r in generate.generate_sample(grams, seeds, 1).collect())
    again = Counter(r.generated for r in generate.generate_sample(grams, seeds, 1).collect())
    followers = {r.word: r.n + 1 for r in bigrams.bigram_counts(grams).where("context = 'hot'").collect()}
    assert drawn == again and set(drawn) <= set(followers)
    share = followers["hot"] / sum(followers.values())
    assert drawn["hot"] / 400 == pytest.approx(share, abs=0.1)
