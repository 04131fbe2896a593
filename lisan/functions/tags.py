"""Part-of-speech tagging, context rules and noun phrases over token arrays.

A sentence stays one row with its tokens and tags as arrays, so tagging, context rules and chunking
need no shuffle. Tables too large for literals go through ``operators.tagging.tag_with_lexicon``.
"""

from __future__ import annotations

import re
import string
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lisan import constants as C
from lisan.functions.arrays import let
from lisan.functions.text import spans_of

Shape = tuple[str, str, str]
ContextRule = tuple[str | None, str, str | None, str]


def _first_match(rules: Sequence[tuple[Column, str]], rest: Column) -> Column:
    """``CASE WHEN`` over (test, tag) pairs."""
    if not rules:
        return rest
    (test, name), *others = rules
    tag = F.when(test, name)
    for test, name in others:
        tag = tag.when(test, name)
    return tag.otherwise(rest)


def _has_shape(token: Column, kind: str, value: str) -> Column:
    first = F.substring(token, 1, 1)
    tests = {
        "capital": lambda: first != F.lower(first),
        "prefix": lambda: F.startswith(token, F.lit(value)),
        "suffix": lambda: F.endswith(token, F.lit(value)),
        "pattern": lambda: F.regexp_like(token, F.lit(value)),
    }
    return tests[kind]()


def _may_open_low(kind: str, value: str) -> bool:
    """Whether a shape may hold for a token that begins with one of a to z.

    A pattern is out of the question if it asks, at the start, for a character of a class without these letters.
    """
    if kind == "capital":
        return False
    found = re.match(r"\^\[(\^?)((?:[^\\\[\]&]|\\p\{[LN]\})+)\](?![?*{])", value) if kind == "pattern" else None
    if found is None or "|" in value or "(?" in value:
        return True
    body = found[2].replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9")
    return any(re.match(f"[{found[1]}{body}]", c) for c in string.ascii_lowercase)


def shape_tag(token: Column, shapes: Sequence[Shape], default: str) -> Column:
    """Tag a token by the first shape rule it meets. Rules that need another beginning are not tried on a to z."""
    def tag(rules: Sequence[Shape]) -> Column:
        return _first_match([(_has_shape(token, kind, value), tag) for kind, value, tag in rules], F.lit(default))

    low = [shape for shape in shapes if _may_open_low(*shape[:2])]
    if len(low) == len(shapes):
        return tag(shapes)
    return F.when((token >= "a") & (token < "{"), tag(low)).otherwise(tag(shapes))


def tag_tokens(
    tokens: Column, lexicon: Mapping[str, Sequence[str]], shapes: Sequence[Shape], default: str
) -> Column:
    """Tags of a token array: the lower-case form in the lexicon, else the shape, else ``default``.

    One hash lookup tells whether the lexicon has the word at all; only then its tags are tried.
    """
    words = [w for ws in lexicon.values() for w in ws]

    def named(low: Column, names: Sequence[str]) -> Column:
        """The first of ``names`` whose words hold a word that one of them holds, by halving."""
        if len(names) == 1:
            return F.lit(names[0])
        first, rest = names[: len(names) // 2], names[len(names) // 2 :]
        held = [w for name in first for w in lexicon[name]]
        return F.when(low.isin(*held), named(low, first)).otherwise(named(low, rest)) if held else named(low, rest)

    def tag(token: Column, low: Column) -> Column:
        shape = shape_tag(token, shapes, default)
        if not words:
            return shape
        return F.when(low.isin(*words), named(low, list(lexicon))).otherwise(shape)

    return let(tokens, lambda ts: F.zip_with(ts, F.transform(ts, F.lower), tag))


def rule_applies(rule: ContextRule, before: Column, tag: Column, after: Column) -> Column:
    """Whether a context rule changes ``tag`` between its neighbours' tags."""
    previous, old, following, _ = rule
    hit = tag == old
    if previous is not None:
        hit = hit & F.coalesce(before == previous, F.lit(False))
    if following is not None:
        hit = hit & F.coalesce(after == following, F.lit(False))
    return hit


def apply_context_rules(tags: Column, rules: Sequence[ContextRule]) -> Column:
    """Rewrite tags by their neighbours: one pass over the sentence per rule, in order."""
    def rewrite(ts: Column, rule: ContextRule) -> Column:
        return F.transform(
            ts,
            lambda t, i: F.when(
                rule_applies(rule, F.get(ts, i - 1), t, F.get(ts, i + 1)), F.lit(rule[3])
            ).otherwise(t),
        )

    def one_pass(tags: Column, rule: ContextRule) -> Column:
        # A sentence without the tags the rule asks for is left alone.
        return let(tags, lambda ts: F.when(has_tags(ts, rule), rewrite(ts, rule)).otherwise(ts))

    def has_tags(ts: Column, rule: ContextRule) -> Column:
        asked = [tag for tag in dict.fromkeys(rule[:3]) if tag is not None]
        return reduce(lambda a, b: a & b, [F.array_contains(ts, tag) for tag in asked])

    return reduce(one_pass, rules, tags)


def tag_codes(tags: Column) -> Column:
    """One letter per tag (D determiner, J adjective, N noun, x other), joined to a string."""
    code = lambda t: (
        F.when(t == "DT", "D").when(t.startswith("JJ"), "J").when(t.startswith("NN"), "N").otherwise("x")
    )
    return F.array_join(F.transform(tags, code), "")


def np_chunks(tokens: Column, tags: Column) -> Column:
    """Noun phrases DT? JJ* NN+ as array<struct<start_token, end_token, phrase>>, leftmost and greedy."""
    return F.transform(
        spans_of(tag_codes(tags), C.NOUN_PHRASE),
        lambda s: F.struct(
            s["start"].alias("start_token"),
            s["end"].alias("end_token"),
            F.array_join(F.slice(tokens, s["start"] + 1, s["end"] - s["start"]), " ").alias("phrase"),
        ),
    )


def chunk_tree(tokens: Column, tags: Column) -> Column:
    """The chunked sentence as bracket text, e.g. ``(S (NP The/DT fox/NN) ran/VBD ./.)``."""
    def words(leaves: Column, start: Column, end: Column) -> Column:
        return F.array_join(F.slice(leaves, start + 1, end - start), " ")

    def tree(leaves: Column, spans: Column) -> Column:
        # Each phrase brings the plain words before it; the words after the last phrase close the line.
        parts = F.transform(
            spans,
            lambda s, i: F.array(
                words(leaves, F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)), s["start"]),
                F.concat(F.lit("(NP "), words(leaves, s["start"], s["end"]), F.lit(")")),
            ),
        )
        last = F.coalesce(F.get(spans, F.size(spans) - 1)["end"], F.lit(0))
        tail = F.array(words(leaves, last, F.size(leaves)))
        pieces = F.filter(F.concat(F.flatten(parts), tail), lambda p: p != "")
        return F.concat(F.lit("(S "), F.array_join(pieces, " "), F.lit(")"))

    return let(
        F.zip_with(tokens, tags, lambda w, t: F.concat_ws("/", w, t)),
        lambda leaves: let(spans_of(tag_codes(tags), C.NOUN_PHRASE), lambda spans: tree(leaves, spans)),
    )
