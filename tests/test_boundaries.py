"""Learned sentence ends: scores by hand, real abbreviations, splits."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lisan.operators import boundaries

DOCS = "doc_id bigint, lang string, text string"


def prose(seed: int, n: int) -> str:
    """Sentences of common words with titles and units before words that also stand alone."""
    draw = random.Random(seed)
    words = ["house", "river", "walked", "slowly", "mountain", "bright", "under", "table", "garden", "window", "carried", "many"]
    out = []
    for _ in range(n):
        some = draw.choices(words, k=draw.randrange(4, 9))
        if draw.random() < 0.5:
            some.insert(draw.randrange(1, len(some)), draw.choice(["Dr. Smith", "approx. twelve", "e.g. one", "vs. Jones"]))
        out.append(" ".join([draw.choice(["However", "The", "Then"]), *some]) + draw.choice([".", ".", "!", "?"]))
    return " ".join(out)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "en", prose(i, 60)) for i in range(20)]
    rows += [(50, "de", "Das z. B. ist es. Es ist."), (51, None, "Mr. X is here. Mr. Y is not."), (52, "en", None), (53, "en", ""), (54, "en", "... !!! 3.5 a.")]
    return spark.createDataFrame(rows, DOCS)


def plain_counts(rows) -> dict:
    counts: dict = {}
    for lang, text in rows:
        for token in (text or "").split():
            core = re.sub(r"[^\w.]+$", "", re.sub(r"^\W+", "", token))
            if re.search(r"[^\W\d_]", core) and not core.endswith(".."):
                stop = core.endswith(".")
                found = counts.setdefault((lang or "", (core[:-1] if stop else core).lower()), [0, 0])
                found[0 if stop else 1] += 1
    return counts


def test_scores_by_hand(docs):
    rows = [(r.lang, r.text) for r in docs.collect()]
    counts = plain_counts(rows)
    assert {(r.lang, r.type): [r.stopped, r.plain] for r in boundaries.type_counts(docs).collect()} == counts
    want = {}
    for (lang, word), (c, d) in counts.items():
        stops = sum(s for (g, _), (s, _) in counts.items() if g == lang)
        total = sum(s + p for (g, _), (s, p) in counts.items() if g == lang)
        p = stops / total
        if c:
            null = c * math.log(p) + (d * math.log(1 - p) if d else 0)
            other = c * math.log(0.99) + d * math.log(1 - 0.99)
            inner = word.count(".") + 1
            letters = len(word) - inner + 1
            score = -2 * (null - other) * math.exp(-letters) * inner * letters ** -d
            if score >= 0.3:
                want[lang, word] = score
    got = {(r.lang, r.type): r.score for r in boundaries.abbreviations(docs).collect()}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 * max(1, abs(want[k])) for k in want)
    assert {("en", "dr"), ("en", "e.g"), ("en", "vs"), ("", "mr")} <= set(got)
    assert ("en", "house") not in got and ("en", "river") not in got


def test_starters_follow_ends(docs):
    found = {r.type for r in boundaries.sentence_starters(docs, boundaries.abbreviations(docs)).where("lang = 'en'").collect()}
    assert found == {"however", "the", "then"}


def test_splits_by_what_was_learned(spark, docs):
    ends = boundaries.SentenceEnds.learned(docs)
    rows = [
        (1, "en", "They met Dr. Jones. However he left. \"Why?\" She ran (slowly.) Then it was approx. twelve."),
        (2, "en", "It is big, e.g. a river vs. However. The end."),
        (3, "xx", "Here Dr. Who is unknown. Yes."),
        (4, None, "See Mr. X now. Go."),
        (5, "en", None),
        (6, "en", "   "),
    ]
    got = {}
    for r in boundaries.learned_sentences(spark.createDataFrame(rows, DOCS), ends).orderBy("doc_id", "sentence_index").collect():
        got.setdefault(r.doc_id, []).append(r.sentence)
    assert got[1][:2] == ["They met Dr. Jones.", "However he left."]
    assert got[1][2:4] == ['"Why?"', "She ran (slowly.)"]
    assert got[2] == ["It is big, e.g. a river vs.", "However.", "The end."]  # a capitalised starter ends the abbreviation
    assert got[3] == ["Here Dr.", "Who is unknown.", "Yes."]
    assert got[4] == ["See Mr. X now.", "Go."]
    assert set(got) == {1, 2, 3, 4}


def test_too_many_words_are_refused(spark, docs, monkeypatch):
    monkeypatch.setattr(boundaries, "MOST_WORDS", 2)
    with pytest.raises(ValueError, match="higher score"):
        boundaries.SentenceEnds.learned(docs)


def test_no_documents(spark):
    none = spark.createDataFrame([], DOCS)
    assert boundaries.abbreviations(none).count() == 0
    ends = boundaries.SentenceEnds.learned(none)
    assert ends.shortened == {} and ends.starters == {}
    only = spark.range(1).select(ends.split(F.lit("A b. C"), F.lit("en")).alias("x")).first().x
    assert only == ["A b.", "C"]


def test_tables_split_as_the_expression_does(spark, docs, monkeypatch):
    """Whatever case and signs the words have, and however many they are; a text may come twice or lack its id."""
    rows = [
        (1, "en", "Dr. Who met DR. Jones. However (vs.) He went, e.g. twelve-vs. The end. E.G. \"However\" it was x-dr.) THE-re. A."),
        (1, "en", "Dr. Who met DR. Jones."), (None, "xx", "Mr. X is (mr.) here. mr. Y"), (None, None, "Mr. X. Go. İs. maſ."), (5, "de", "z. B. ist. Es"),
        (6, "en", None), (7, "en", "  "), (1, "en", "Dr. Who met DR. Jones."),
    ]
    some = spark.createDataFrame(rows, DOCS).unionByName(docs)
    shortened = [("en", w) for w in ("dr", "vs", "e.g", "a+b", "twelve-vs", "i̇s", "mas")] + [("", "mr"), ("", "mas"), ("de", "z"), ("de", "b")]
    starters = [("en", "however"), ("en", "the"), ("en", "he"), ("xx", "y"), ("de", "ist")]
    lists = [{}, {}]
    for words, into in zip((shortened, starters), lists):
        for lang, word in words:
            into.setdefault(lang, []).append(word)
    frames = [spark.createDataFrame(words, "lang string, type string") for words in (shortened, starters)]
    counted = lambda ends: sorted((str(tuple(r)) for r in boundaries.learned_sentences(some, ends).collect()))
    want = counted(boundaries.SentenceEnds(*lists))
    assert counted(boundaries.EndTables(*frames)) == want and len(want) > 100
    monkeypatch.setattr(boundaries, "MOST_WORDS", 2)  # what fits no expression still fits the tables
    monkeypatch.setattr(boundaries, "broadcast_if_small", lambda df: df)
    assert counted(boundaries.EndTables(*frames)) == want
    assert boundaries.learned_sentences(docs, boundaries.EndTables.learned(docs)).count() > 0
    assert boundaries.learned_sentences(docs.limit(0), boundaries.EndTables.learned(docs.limit(0))).count() == 0


def test_words_are_learned_from_tokens_folded_once(spark, docs):
    """Both lists come from one folded table of tokens, with the rows that the documents themselves give."""
    rows = [
        (1, "en", "U.S.A. x.. Dr. \"(Mr.)\" ...end. -- .5. 'e.g.' É.) Über! it?! No. Yes. a.b.. c"), (1, "en", "Dr. No. Dr. No."),
        (2, None, "Dr. (No.) 7. \U00010400. x"), (None, "en", None), (3, "de", "  "), (4, "de", ""), (1, "en", "Dr. No. Dr. No."),
    ]
    some = spark.createDataFrame(rows, DOCS).unionByName(docs)
    pairs = boundaries.written(boundaries.token_pairs(some))
    assert pairs.where("token IS NULL").count() == 0
    want = {}
    for _, lang, text in rows + [tuple(r) for r in docs.select("doc_id", "lang", "text").collect()]:
        last = None
        for token in re.findall(r"\S+", text or ""):
            key = lang or "", token, last if last and re.search(r"[.!?][\"')\]}”’»]*$", last) else None
            want[key] = want.get(key, 0) + 1
            last = token
    assert {(r.lang, r.token, r.before): r.c for r in pairs.collect()} == want
    rows_of = lambda df: sorted(map(tuple, df.collect()))
    assert rows_of(boundaries.type_counts(some, pairs)) == rows_of(boundaries.type_counts(some))
    counts = {(r.lang, r.type): (r.stopped, r.plain) for r in boundaries.type_counts(some, pairs).collect()}
    assert counts["", "dr"] == (1, 0) and counts["", "\U00010428"] == (1, 0) and ("", "7") not in counts
    assert counts["en", "u.s.a"] == (1, 0) and counts["en", "end"][0] >= 1 and ("en", "x.") not in counts and ("en", "a.b") not in counts
    shortened = boundaries.written(boundaries.abbreviations(some))
    assert rows_of(shortened) == rows_of(boundaries.abbreviations(some, pairs=pairs))
    assert rows_of(boundaries.sentence_starters(some, shortened)) == rows_of(boundaries.sentence_starters(some, shortened, pairs=pairs))


def test_patterns_see_folded_tokens(docs):
    """The patterns of a word run above the fold, and the texts are cut into tokens once."""
    plan = boundaries.type_counts(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    steps = [line.lstrip(" :+-") for line in plan.splitlines()]
    folds = [i for i, x in enumerate(steps) if x.startswith("Aggregate")]
    assert len(folds) == 2 and folds[0] < next(i for i, x in enumerate(steps) if "regexp_extract(" in x) < folds[1]
    assert boundaries.token_pairs(docs)._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
