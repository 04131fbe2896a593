"""Labelled spans over arrays: BIO labels, patterns, overlap resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lisan import constants as C
from lisan.functions.arrays import blocks, let, positions, running_totals
from lisan.functions.text import spans_of


def label_type(label: Column) -> Column:
    """The entity type of a BIO label: the part after ``B-`` or ``I-``; null outside."""
    marked = label.startswith("B-") | label.startswith("I-")
    return F.when(label == C.OUTSIDE, None).when(marked, F.substring(label, 3, F.length(label))).otherwise(label)


def bio_spans(labels: Column, scores: Column) -> Column:
    """Merge neighbouring labels of one type into array<struct<start, end, label, score>>.

    A ``B-`` label opens a new span even next to its own type; the score is the mean over the span.
    Starts and ends are found separately and paired by position, and types, openings and scores are made once, so the
    work is linear.
    """
    def opens(ls: Column, types: Column, i: Column) -> Column:
        here = F.get(ls, i)
        return (here != C.OUTSIDE) & (here.startswith("B-") | ~F.get(types, i).eqNullSafe(F.get(types, i - 1)))

    def pair(ls: Column, types: Column, opening: Column, at: Column, ss: Column) -> Column:
        closes = lambda i: (F.get(ls, i) != C.OUTSIDE) & (
            (i == F.size(ls) - 1) | (F.get(ls, i + 1) == C.OUTSIDE) | F.get(opening, i + 1)
        )
        return F.zip_with(
            F.filter(at, lambda i: F.get(opening, i)),
            F.filter(at, closes),
            lambda s, e: F.struct(
                s.alias("start"),
                (e + 1).alias("end"),
                F.get(types, s).alias("label"),
                (
                    F.aggregate(F.slice(ss, s + 1, e - s + 1), F.lit(0.0), lambda a, x: a + x)
                    / (e - s + 1)
                ).alias("score"),
            ),
        )

    def spans(ls: Column, types: Column, at: Column) -> Column:
        opening = F.transform(at, lambda i: opens(ls, types, i))
        return let(opening, lambda os: let(scores, lambda ss: pair(ls, types, os, at, ss)))

    return let(
        labels, lambda ls: let(F.transform(ls, label_type), lambda types: let(positions(ls), lambda at: spans(ls, types, at)))
    )


def pattern_entities(text: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """Matches of every (label, regex) rule as array<struct<text, label, start_char, end_char>>."""
    def matches(label: str, pattern: str) -> Column:
        return F.transform(
            spans_of(text, pattern),
            lambda s: F.struct(
                s["token"].alias("text"),
                F.lit(label).alias("label"),
                s["start"].alias("start_char"),
                s["end"].alias("end_char"),
            ),
        )

    found = [matches(label, pattern) for label, pattern in patterns]
    return F.concat(*found)


def leftmost_longest(spans: Column) -> Column:
    """Keep non-overlapping spans, earliest start first and longest first among equal starts.

    ``spans`` is array<struct<start, back, label>> with ``back`` the length negated, so that the
    natural order of the structs is the order of preference. Kept spans are gathered in blocks of 64,
    because appending to one long array would copy it each time.
    """
    def take(state: Column, span: Column) -> Column:
        free = span["start"] >= state["end"]
        return F.struct(
            F.when(free, span["start"] - span["back"]).otherwise(state["end"]).alias("end"),
            F.when(free, F.concat(state["kept"], F.array(span))).otherwise(state["kept"]).alias("kept"),
        )

    def take_block(state: Column, block: Column) -> Column:
        start = F.struct(state["end"].alias("end"), F.slice(block, 1, 0).alias("kept"))
        return let(
            F.aggregate(block, start, take),
            lambda done: F.struct(
                done["end"].alias("end"), F.concat(state["kept"], F.array(done["kept"])).alias("kept")
            ),
        )

    def fold(ordered: Column) -> Column:
        cut = blocks(ordered)
        start = F.struct(F.lit(0).alias("end"), F.slice(cut, 1, 0).alias("kept"))
        return F.aggregate(cut, start, take_block, lambda state: F.flatten(state["kept"]))

    return let(F.array_sort(spans), fold)


def format_entity(word: Column, label: Column, score: Column) -> Column:
    """One entity as a preview line."""
    return F.format_string(C.ENTITY_LINE, word, label, score)


def piece_words(pieces: Column, mark: str = "##") -> Column:
    """Sub-word pieces as array<struct<text, word, start, end>>: their word and their characters among all words' letters.

    A piece with the ``mark`` in front goes on with the word of the piece before it; the mark is no character. Words
    follow each other without blanks here; ``piece_spans`` brings them to their places in a text.
    """
    def place(ps: Column) -> Column:
        plain = F.transform(ps, lambda p: F.when(p.startswith(mark), F.substring(p, len(mark) + 1, F.length(p))).otherwise(p))
        opens = F.transform(ps, lambda p, i: F.when(p.startswith(mark) & (i > 0), 0).otherwise(1))
        return let(
            plain,
            lambda xs: let(
                running_totals(F.transform(xs, F.length)),
                lambda ends: let(
                    running_totals(opens),
                    lambda words: F.transform(
                        xs,
                        lambda x, i: F.struct(
                            x.alias("text"), (F.get(words, i) - 1).alias("word"),
                            (F.get(ends, i) - F.length(x)).alias("start"), F.get(ends, i).alias("end"),
                        ),
                    ),
                ),
            ),
        )

    return let(pieces, place)


def piece_spans(words: Column, pieces: Column, labels: Column, scores: Column, mark: str = "##") -> Column:
    """Spans of labelled sub-word pieces as array<struct<start, end, label, score>> in characters of the text.

    ``words`` are the text's words, array<struct<token, start, end>>, of which the pieces are cuts in order; ``labels``
    and ``scores`` are one per piece. Neighbouring pieces of one type merge as ``bio_spans`` has it, whatever words
    they belong to; a span may begin or end inside a word. Pieces that do not spell the words raise an error.
    """
    def spans(at: Column) -> Column:
        letters = F.transform(words, lambda w: w["end"] - w["start"])

        def shifted(befores: Column) -> Column:
            def char(piece: Column, side: str) -> Column:
                word = piece["word"]
                return F.get(words, word)["start"] + piece[side] - F.coalesce(F.get(befores, word - 1), F.lit(0))

            return F.transform(
                bio_spans(labels, scores),
                lambda s: F.struct(
                    char(F.get(at, s["start"]), "start").alias("start"), char(F.get(at, s["end"] - 1), "end").alias("end"),
                    s["label"].alias("label"), s["score"].alias("score"),
                ),
            )

        spelled = F.array_join(F.transform(at, lambda p: p["text"]), "") == F.array_join(F.transform(words, lambda w: w["token"]), "")
        return F.when(spelled, let(running_totals(letters), shifted)).otherwise(F.raise_error(F.lit("The pieces do not spell the words.")))

    return let(piece_words(pieces, mark), spans)
