from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lisan.data import tables
from lisan.functions import spans as S
from lisan.functions import text as T
from lisan.operators import corpus, entities, evaluate, stats
from lisan.sources.jsonl import from_texts

# Sentences with known gold labels.
HARD = (
    "A tiny intruder infiltrated White House grounds Tuesday, prompting a swift response from the US Secret "
    "Service. Anthony Guglielmi, chief of communications for the Secret Service, said a toddler crawled."
)


HARD_LABELS = [
    "O", "O", "O", "O", "ORG", "ORG", "O", "DATE", "O", "O", "O", "O", "O", "O", "O", "ORG", "ORG", "ORG", "O",
    "PERSON", "PERSON", "O", "O", "O", "O", "O", "O", "ORG", "ORG", "O", "O", "O", "O", "O", "O",
]


def test_bio_spans(value):
    labels = "B-ORG I-ORG O B-PER B-PER I-ORG".split()
    found = value(S.bio_spans, labels, [0.5, 1.0, 0.0, 0.25, 0.5, 1.0])
    assert [tuple(f) for f in found] == [
        (0, 2, "ORG", 0.75), (3, 4, "PER", 0.25), (4, 5, "PER", 0.5), (5, 6, "ORG", 1.0),
    ]
    assert value(S.bio_spans, ["O", "O"], [1.0, 1.0]) == []


def test_spans_restore_labels(spark):
    draw = random.Random(1)
    rows = [
        (d, 0, [draw.choice(["O", "B-A", "I-A", "B-B", "I-B"]) for _ in range(12)], [1.0] * 12) for d in range(20)
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, sentence_index int, labels array<string>, scores array<double>")
    spans = entities.bio_to_spans(frame).withColumnsRenamed({"start": "start_token", "end": "end_token"})
    labelled = entities.token_labels(frame.withColumnRenamed("labels", "tokens"), spans)
    assert labelled.count() == 240
    assert labelled.where(F.coalesce(S.label_type(F.col("token")), F.lit("O")) != F.col("label")).count() == 0


def greedy(words: list[str], phrases: dict[tuple[str, ...], str]) -> list[tuple]:
    out, i = [], 0
    while i < len(words):
        n = max((len(p) for p in phrases if tuple(words[i : i + len(p)]) == p), default=0)
        if n:
            out.append((i, i + n, phrases[tuple(words[i : i + n])]))
        i += n or 1
    return out


@pytest.mark.parametrize("small", [True, False])
def test_gazetteer_by_brute_force(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(entities, "TRIE_PHRASES", 0)
        monkeypatch.setattr(entities, "broadcast_if_small", lambda df: df.hint("merge"))
    draw = random.Random(5)
    texts = [" ".join(draw.choice(["hot", "hot", "a", "b", "c"]) for _ in range(40)) for _ in range(20)]
    phrases = {("hot",): "H", ("hot", "a"): "HA", ("a", "b", "c"): "ABC", ("b", "hot"): "BH", ("c", "c"): "CC"}
    table = entities.gazetteer_table(spark, [(" ".join(p), label) for p, label in phrases.items()])
    found = entities.gazetteer_matches(corpus.sentences(from_texts(spark, texts, "en")), table).collect()
    got = sorted((r.doc_id, r.start_token, r.end_token, r.label) for r in found)
    assert got == sorted((d, *m) for d, text in enumerate(texts) for m in greedy(text.split(), phrases))
    assert all(texts[r.doc_id][r.start : r.end] == r.entity for r in found)


@pytest.mark.parametrize("seed", range(3))
def test_trie_and_join_agree(spark, monkeypatch, seed):
    """Phrases that share beginnings, end inside others, come twice with two labels or are blank."""
    draw = random.Random(seed)
    letters = ["a", "b", "c", "-", "d"]
    texts = [" ".join(draw.choices(letters, k=draw.randrange(1, 30))) for _ in range(40)]
    phrases = [(" ".join(draw.choices(letters, k=draw.randrange(1, 6))), draw.choice("XYZ")) for _ in range(12)]
    phrases += [(phrases[0][0], "A"), ("", "E"), ("  ", "E"), (None, "N")]
    table = entities.gazetteer_table(spark, phrases)
    sents = corpus.located_sentences(from_texts(spark, texts, "en"))
    columns = ["doc_id", "start_char", "sentence", "entity", "label", "start", "end", "start_token", "end_token"]
    by_trie = entities.gazetteer_matches(sents, table).select(*columns).collect()
    labels = entities.phrase_labels(sents, {"x": table, "y": table}).select("doc_id", "tokens", "x", "y").collect()
    monkeypatch.setattr(entities, "TRIE_PHRASES", 0)
    joined = entities.gazetteer_matches(sents, table).select(*columns).collect()
    also = entities.phrase_labels(sents, {"x": table, "y": table}).select("doc_id", "tokens", "x", "y").collect()
    assert sorted(by_trie) == sorted(joined) and sorted(labels) == sorted(also)
    best = {}
    for phrase, label in phrases:
        if phrase and phrase.split():
            best[tuple(phrase.split())] = min(best.get(tuple(phrase.split()), label), label)
    got = sorted((r.doc_id, r.start_token, r.end_token, r.label) for r in by_trie)
    assert got == sorted((d, *m) for d, text in enumerate(texts) for m in greedy(text.split(), best))
    for r in labels:
        want = ["O"] * len(r.tokens)
        for start, end, label in greedy(r.tokens, best):
            want[start:end] = [label] * (end - start)
        assert r.x == r.y == want


def test_no_phrases(spark):
    none = entities.gazetteer_table(spark, [])
    sents = corpus.sentences(from_texts(spark, ["a b", ""], "en"))
    assert entities.gazetteer_matches(sents, none).count() == 0
    assert [r.x for r in entities.phrase_labels(sents, {"x": none}).collect()] == [["O", "O"]]


def test_english_entities(spark):
    docs = from_texts(spark, [HARD, "Dominion Voting Systems sued Fox News for spreading misinformation."], "en")
    found = entities.extract_entities(
        corpus.located_sentences(docs), entities.gazetteer_table(spark, tables.ENGLISH_GAZETTEER)
    ).collect()
    assert {(r.article_index, r.text, r.label) for r in found} == {
        (0, "White House", "ORG"), (0, "Tuesday", "DATE"), (0, "US Secret Service", "ORG"),
        (0, "Anthony Guglielmi", "PERSON"), (0, "Secret Service", "ORG"),
        (1, "Dominion Voting Systems", "ORG"), (1, "Fox News", "ORG"),
    }
    assert all(HARD[r.start_char : r.end_char] == r.text for r in found if r.article_index == 0)


def test_hard_sentence_scores(spark):
    sents = corpus.sentences(from_texts(spark, [HARD], "en"))
    spans = entities.gazetteer_matches(sents, entities.gazetteer_table(spark, tables.ENGLISH_GAZETTEER))
    pred = entities.token_labels(corpus.tokenized(sents, T.wordpunct_tokenize), spans)
    pred = pred.orderBy("sentence_index", "token_index").collect()
    assert len(pred) == 35
    assert [r.label for r in pred] == HARD_LABELS


def test_arabic_entities(spark):
    docs = from_texts(spark, ["اليوم! زار محمد بن سلمان الرياض"], "ar")
    sents = corpus.sentences(docs, T.split_arabic_sentences)
    found = entities.extract_entities_by_sentence(
        sents, entities.gazetteer_table(spark, tables.ARABIC_GAZETTEER)
    ).collect()
    assert {(r.sentence_index, r.entity, r.label) for r in found} == {(1, "محمد بن سلمان", "PER"), (1, "الرياض", "LOC")}
    assert all(r.sentence[r.start : r.end] == r.entity for r in found)


def test_patterns(value):
    found = value(
        lambda t: S.pattern_entities(t, tables.ENTITY_PATTERNS), "Pay $1,200.50 by 2024-01-31 to a.b@mail.example.com"
    )
    assert {(f.label, f.text) for f in found} == {
        ("MONEY", "$1,200.50"), ("DATE", "2024-01-31"), ("EMAIL", "a.b@mail.example.com"),
    }


def test_char_labels_by_brute_force(spark):
    draw = random.Random(2)
    line = "token " * 50
    sents = [(d, k, line, k * len(line)) for d in (1, 2) for k in range(4)]
    tokens = [(d, k, i, "t", k * 300 + i * 6, k * 300 + i * 6 + 5) for d in (1, 2) for k in range(4) for i in range(50)]
    marks = [
        (draw.choice([1, 2]), "x", draw.choice("ABC"), s, s + draw.choice([5, 20, 900]))
        for s in (draw.randrange(1400) for _ in range(30))
    ]
    located = spark.createDataFrame(sents, "doc_id bigint, sentence_index int, sentence string, start_char int")
    mark_frame = spark.createDataFrame(
        marks, "article_index bigint, text string, label string, start_char int, end_char int"
    )
    labelled = entities.token_labels_by_char(located, mark_frame).collect()
    got = {(r.doc_id, r.start_char): r.label for r in labelled}
    assert len(labelled) == len(tokens)
    for d, _, _, _, start, end in tokens:
        inside = [(s, e, label) for m, _, label, s, e in marks if m == d and s <= start and end <= e]
        assert got[d, start] == (max(inside)[2] if inside else "O")


def test_later_span_wins(spark):
    tokens = spark.createDataFrame([(0, 0, ["t"] * 4)], "doc_id bigint, sentence_index int, tokens array<string>")
    spans = spark.createDataFrame(
        [(0, 0, 0, 3, "A"), (0, 0, 2, 3, "B")],
        "doc_id bigint, sentence_index int, start_token int, end_token int, label string",
    )
    assert [r.label for r in entities.token_labels(tokens, spans).orderBy("token_index").collect()] == ["A", "A", "B", "O"]


def test_entity_line(value):
    assert value(S.format_entity, "Cairo", "LOC", 0.98765) == "Cairo -> LOC (score=0.9877)"


def test_top_values_break_ties_by_value(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert [tuple(r) for r in stats.top_values(rows, "v", 2).collect()] == [("c", 2), ("a", 1)]


def pairs(spark, gold: str, pred: str):
    rows = list(zip(gold.split(), pred.split(), strict=True))
    return spark.createDataFrame(rows, "gold string, pred string")


def test_prf1(spark):
    row = evaluate.prf1(pairs(spark, "DT JJ NN VBZ", "DT JJ NN NN")).first()
    assert (row.tp, row.fp, row.fn) == (3, 0, 1)
    assert (row.precision, row.recall, row.f1) == (1.0, 0.75, pytest.approx(6 / 7))
    row = evaluate.prf1(pairs(spark, "ORG O O PER", "PER PER O PER")).first()
    assert (row.tp, row.fp, row.fn) == (1, 1, 1)
    row = evaluate.prf1(pairs(spark, "O O", "O O")).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_unequal_lengths_fail(spark):
    gold = spark.createDataFrame([(0, 0, "A"), (0, 1, "B")], "s int, i int, label string")
    with pytest.raises(Exception, match="Gold and Pred must be same length"):
        evaluate.align(gold, gold.where("i = 0"), ["s", "i"]).collect()
    with pytest.raises(Exception, match="Gold and Pred must be same length"):
        gold.select(
            F.inline(evaluate.align_arrays(F.array("label", "label"), F.array("label")))
        ).collect()


def test_confusion_matrix(spark):
    matrix = evaluate.confusion_matrix(pairs(spark, "B B A", "B C A"))
    got = {(r.gold, r.pred): r.n for r in matrix.collect()}
    assert got == {(g, p): {("A", "A"): 1, ("B", "B"): 1, ("B", "C"): 1}.get((g, p), 0) for g in "ABC" for p in "ABC"}
    wide = evaluate.confusion_wide(matrix, ["A", "B", "C"]).orderBy("gold").collect()
    assert [tuple(r) for r in wide] == [("A", 1, 0, 0), ("B", 0, 1, 1), ("C", 0, 0, 0)]
    codes = evaluate.label_codes(pairs(spark, "B A", "C A")).collect()
    assert [(r.code, r.label) for r in codes] == [(0, "A"), (1, "B"), (2, "C")]


def test_dense_matches_in_one_long_sentence(spark):
    text = "hot " * 20_000
    table = entities.gazetteer_table(spark, [("hot", "H"), ("hot hot hot", "HHH")])
    found = entities.gazetteer_matches(corpus.sentences(from_texts(spark, [text], "en")), table)
    counts = {r.label: r.n for r in found.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert counts == {"HHH": 6_666, "H": 2}
    assert found.where("end_token - start_token = 3 AND end - start != 11").count() == 0


def test_folded_pairs_score_the_same(spark):
    rows = pairs(spark, "A A B O O A", "A A A B O O")
    folded = evaluate.confusion_counts(rows)
    assert evaluate.prf1(rows).first() == evaluate.prf1(folded).first()
    assert sorted(evaluate.confusion_matrix(rows).collect()) == sorted(evaluate.confusion_matrix(folded).collect())


def test_one_list_without_overlaps(spark):
    docs = from_texts(spark, ["Pay $1234567 to x2024-01-31@mail.example at Fox News today.", "none"], "en")
    phrases = entities.extract_entities(
        corpus.located_sentences(docs), entities.gazetteer_table(spark, [("Fox News", "ORG"), ("News", "MISC")])
    )
    merged = entities.merge_entities(phrases, entities.extract_pattern_entities(docs, tables.ENTITY_PATTERNS))
    rows = sorted((r.start_char, r.text, r.label) for r in merged.collect())
    assert rows == [(4, "$1234567", "MONEY"), (16, "x2024-01-31@mail.example", "EMAIL"), (44, "Fox News", "ORG")]


@pytest.mark.parametrize("size", [1, 7, 256])
def test_labels_by_char_over_many_entities(spark, monkeypatch, size):
    """Entities across bins and sentences, inside each other, empty, and in other articles."""
    monkeypatch.setattr(entities, "CHAR_BIN", size)
    draw = random.Random(size)
    texts = [" ".join("ab"[k % 2] * draw.randrange(1, 9) for k in range(30)) + ". Cd ef. " for _ in range(4)] + [""]
    marks = []
    for doc in (0, 1, 2, 9):
        for _ in range(60):
            start = draw.randrange(0, 150)
            marks.append((doc, start, start + draw.randrange(0, 40), draw.choice("XYZ")))
    frame = spark.createDataFrame(marks, "article_index bigint, start_char int, end_char int, label string")
    located = corpus.located_sentences(from_texts(spark, texts, "en"))
    got = entities.token_labels_by_char(located, frame).collect()
    assert len(got) == corpus.token_offsets(located).count()
    for r in got:
        around = [m[1:] for m in marks if m[0] == r.doc_id and m[1] <= r.start_char and r.end_char <= m[2]]
        assert r.label == (max(around)[2] if around else "O")
        assert texts[r.doc_id][r.start_char : r.end_char] == r.token


def test_pieces_lie_in_their_words(spark):
    text = "Anthony Guglielmi, of  Washington"
    pieces = ["An", "##th", "##ony", "Gug", "##lielmi", ",", "of", "Wash", "##ington"]
    frame = spark.createDataFrame([(text, pieces)], "text string, pieces array<string>").withColumn("words", T.spans_of(F.col("text"), T.WORDPUNCT))

    def spans(labels: list[str], scores: list[float]):
        found = S.piece_spans(F.col("words"), F.col("pieces"), F.array(*map(F.lit, labels)), F.array(*map(F.lit, scores)))
        return [tuple(s) for s in frame.select(found.alias("s")).first().s]

    got = spans(["B-PER", "I-PER", "I-PER", "I-PER", "I-PER", "O", "O", "B-LOC", "O"], [1.0, 0.5, 0.0, 0.5, 0.5, 1.0, 1.0, 0.75, 1.0])
    assert got == [(0, 17, "PER", 0.5), (23, 27, "LOC", 0.75)]
    assert [text[s:e] for s, e, *_ in got] == ["Anthony Guglielmi", "Wash"]
    assert spans(["O"] * 9, [1.0] * 9) == []
    words = frame.select(S.piece_words(F.col("pieces")).alias("w")).first().w
    assert [w.word for w in words] == [0, 0, 0, 1, 1, 2, 3, 4, 4] and "".join(w.text for w in words) == text.replace(" ", "")
    whole = frame.withColumn("pieces", F.transform("words", lambda w: w["token"]))
    labels, scores = ["B-PER", "I-PER", "O", "O", "B-LOC"], [1.0, 0.5, 1.0, 1.0, 0.5]
    by_word = whole.select(
        S.piece_spans(F.col("words"), F.col("pieces"), F.array(*map(F.lit, labels)), F.array(*map(F.lit, scores))).alias("p"),
        S.bio_spans(F.array(*map(F.lit, labels)), F.array(*map(F.lit, scores))).alias("b"), "words",
    ).first()
    assert [(p.start, p.end, p.label, p.score) for p in by_word.p] == [
        (by_word.words[b.start].start, by_word.words[b.end - 1].end, b.label, b.score) for b in by_word.b
    ]
    with pytest.raises(Exception, match="do not spell"):
        frame.select(S.piece_spans(F.col("words"), F.array(F.lit("x")), F.array(F.lit("O")), F.array(F.lit(1.0)))).collect()


def test_labels_by_char_move_no_tokens(spark, monkeypatch):
    """With entities too many for a broadcast, what is dealt out is sentences; names may be null or come twice."""
    monkeypatch.setattr(entities, "broadcast_if_small", lambda df: df)
    monkeypatch.setattr(entities, "CHAR_BIN", 8)
    text = "ab cd ef gh ij kl mn op qr st"
    rows = [(1, 0, text, 4), (1, 0, text, 4), (1, 0, "ab", 4), (None, 0, text, 0), (2, 0, "ab", 0)]
    located = spark.createDataFrame(rows, "doc_id bigint, sentence_index int, sentence string, start_char int")
    marks = [(1, 7, 9, "X"), (1, 30, 33, "Y"), (None, 0, 2, "Z"), (3, 0, 2, "Z")]
    frame = spark.createDataFrame(marks, "article_index bigint, start_char int, end_char int, label string")
    labelled = entities.token_labels_by_char(located, frame)
    got = labelled.collect()
    assert len(got) == 32
    assert sorted((r.doc_id, r.token, r.label) for r in got if r.label != "O") == [(1, "cd", "X")] * 2 + [(1, "st", "Y")] * 2
    plan = labelled._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and plan.index("posexplode") < plan.index("Join")


def test_scores_are_made_once_for_all_spans(spark):
    """Scores given as an expression are not made again for each span; unmarked labels keep their types."""
    rows = [(["B-X", "I-X", "X", "O", "I-Y", "O", "B-", "I-Y"],), ([],)]
    frame = spark.createDataFrame(rows, "labels array<string>")
    scores = F.transform("labels", lambda x: F.length(x) * 1.0)
    found = frame.select(S.bio_spans(F.col("labels"), scores).alias("s"))
    assert "slice(transform" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [[tuple(s) for s in r.s] for r in found.collect()] == [[(0, 3, "X", 7 / 3), (4, 5, "Y", 3.0), (6, 7, "", 2.0), (7, 8, "Y", 3.0)], []]
