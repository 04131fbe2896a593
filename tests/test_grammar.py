"""Tag grammars against hand-made chunks and a plain matcher."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from lisan.data import tables
from lisan.functions import grammar as R
from lisan.functions import tags as G


@pytest.fixture
def chunked(value):
    def run(tags: list[str], grammar) -> list[tuple]:
        tokens = [f"w{k}" for k in range(len(tags))]
        found = value(lambda ts, gs: R.chunks(ts, gs, R.compile_grammar(grammar)), tokens, tags)
        assert all(f.phrase == " ".join(tokens[f.start_token : f.end_token]) for f in found)
        return [(f.label, f.start_token, f.end_token) for f in found]

    return run


NP = ("NP", ["{<DT>?<JJ.*>*<NN.*>+}"])


@pytest.mark.parametrize(
    ("tags", "want"),
    [
        ("DT JJ NN VBD", [("NP", 0, 3)]),
        ("DT DT NN NNP", [("NP", 1, 4)]),
        ("JJ JJR", []),
        ("NN VBZ NNS", [("NP", 0, 1), ("NP", 2, 3)]),
        ("VB", []),
    ],
)
def test_noun_phrases(chunked, tags, want):
    assert chunked(tags.split(), [NP]) == want


def test_rules_of_a_stage_follow_each_other(chunked):
    tags = "NN IN NN VB DT NN".split()
    assert chunked(tags, [("NP", ["{<.*>+}", "}<VB.*|IN>+{"])]) == [("NP", 0, 1), ("NP", 2, 3), ("NP", 4, 6)]
    # the second rule only sees what the first left out
    assert chunked("DT NN NN".split(), [("NP", ["{<DT><NN>}", "{<NN>}"])]) == [("NP", 0, 2), ("NP", 2, 3)]
    # a chink at the edge of a chunk leaves no empty chunk
    assert chunked("VB NN VB".split(), [("NP", ["{<.*>+}", "}<VB>{"])]) == [("NP", 1, 2)]
    assert chunked("VB VB".split(), [("NP", ["{<.*>+}", "}<VB>{"])]) == []


def test_cascades(chunked):
    grammar = [NP, ("PP", ["{<IN><NP>}"]), ("VP", ["{<VB.*><NP|PP>+}"])]
    tags = "NN VBD IN DT NN NN".split()
    assert chunked(tags, grammar) == [("NP", 0, 1), ("NP", 3, 6), ("PP", 2, 6), ("VP", 1, 6)]


def test_alternatives_and_odd_tags(chunked):
    grammar = [("X", [r"{(<A>|<B><C>)+}"]), ("Y", [r"{<PRP\$>}", r"{<\.>}"])]
    assert chunked(["A", "B", "C", "B", "PRP$", "PRP", "."], grammar) == [("X", 0, 3), ("Y", 4, 5), ("Y", 6, 7)]
    assert chunked([], grammar) == []


@pytest.mark.parametrize("rules", [["<NN>"], ["{NN}"], ["{}"], ["{<NN>x}"], ["}<NN>}"]])
def test_wrong_rules_are_refused(rules):
    with pytest.raises(ValueError):
        R.compile_grammar([("NP", rules)])


def test_too_many_patterns_are_refused():
    with pytest.raises(ValueError, match="more than"):
        R.compile_grammar([("X", ["{" + "".join(f"<T{k}>" for k in range(R.MOST_PATTERNS + 1)) + "}"])])


def test_agrees_with_the_fixed_grammar_and_a_plain_matcher(spark):
    draw = random.Random(4)
    names = [*tables.ENGLISH_LEXICON, "NN", "NNS", "JJ"] + ["NN", "DT", "JJ"] * 8
    rows = [(i, [draw.choice(names) for _ in range(draw.randrange(1, 150))]) for i in range(60)]
    frame = spark.createDataFrame(rows, "id int, tags array<string>")
    tokens = F.transform("tags", lambda t: F.concat(F.lit("w"), t))
    found = frame.select("id", "tags", R.chunks(tokens, F.col("tags"), R.compile_grammar([NP])).alias("a"), G.np_chunks(tokens, F.col("tags")).alias("b"))
    for r in found.collect():
        letters = "".join("D" if t == "DT" else "J" if t.startswith("JJ") else "N" if t.startswith("NN") else "x" for t in r.tags)
        want = [m.span() for m in re.finditer("D?J*N+", letters)]
        assert [(c.start_token, c.end_token) for c in r.a] == want
        assert [(c.start_token, c.end_token, c.phrase) for c in r.a] == [(c.start_token, c.end_token, c.phrase) for c in r.b]


def test_a_chunk_is_named_once(chunked):
    """A stage of a label that is there already names only what it makes itself; a tag may be called like a label."""
    tags = "NN VB NP NN NP".split()
    assert chunked(tags, [NP, ("NP", ["{<NP>}"])]) == [("NP", 0, 1), ("NP", 3, 4)]
    assert chunked(tags, [NP, ("NP", ["{<NP>+}"])]) == [("NP", 0, 1), ("NP", 3, 4), ("NP", 2, 5)]


def test_a_long_sentence_takes_a_time_in_proportion(spark):
    """120,000 tags without an end: comparing each chunk with all nodes took minutes."""
    import time

    tags = F.flatten(F.array_repeat(F.array(*map(F.lit, ["DT", "NN", "IN", "NN"])), 30_000))
    df = spark.range(1).select(tags.alias("tags"))
    start = time.monotonic()
    found = df.select(F.size(R.chunks(F.col("tags"), F.col("tags"), R.compile_grammar([("NP", ["{<DT>?<NN>}"])]))).alias("n")).first().n
    assert found == 60_000 and time.monotonic() - start < 60
