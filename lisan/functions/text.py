"""Sentence splitting, tokenising and offsets as Column functions (JVM side, no UDF)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lisan import constants as C
from lisan.functions.arrays import let, running_totals

# White space inside a regular expression class; matches constants.WHITESPACE.
SPACE_CLASS = r"\s\p{Z}\x1C-\x1F\x85"

WORDPUNCT = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{SPACE_CLASS}]+"
SIMPLE_WORD = rf"[\p{{L}}\p{{N}}\p{{M}}_]+|[^\p{{L}}\p{{N}}\p{{M}}_{SPACE_CLASS}]"
# The ASCII range first: most characters are settled by it.
NON_SPACE = rf"[!-~[^{SPACE_CLASS}]]+"

# The blanks between two sentences: after . ! or ? and what closes with it. The full stop of a title, an initial or
# an acronym ends no sentence; that of another abbreviation none before a lower-case word or a number.
_WORD_START = r"(?<![\p{L}\p{N}_])"
_NEVER = r"|".join([*C.ABBREVIATIONS, r"\p{Lu}", r"(?:\p{L}\.){1,4}\p{L}"])
SENTENCE_GAP = (
    # Two cheap tests first: nearly every place has no blank after it or no end before it.
    rf"(?![!-~])(?<=[.!?{C.CLOSERS}])"
    rf"(?<=[.!?][{C.CLOSERS}]{{0,3}})"
    rf"(?<!{_WORD_START}(?:{_NEVER})\.[{C.CLOSERS}]{{0,3}})"
    rf"(?<!{_WORD_START}(?:{'|'.join(C.OPEN_ABBREVIATIONS)})\.(?=[{SPACE_CLASS}]{{1,9}}[\p{{Ll}}\p{{N}}]))"
    rf"[{SPACE_CLASS}]+"
)


def strip(text: Column) -> Column:
    """Remove white space at both ends."""
    return F.btrim(text, F.lit(C.WHITESPACE))


def preview(text: Column, chars: int = C.PREVIEW_CHARS, tail: str = C.PREVIEW_TAIL) -> Column:
    """The first characters of a text, followed by ``tail``."""
    return F.concat(F.substring(text, 1, chars), F.lit(tail))


def _non_blank(pieces: Column) -> Column:
    return F.filter(F.transform(pieces, strip), lambda s: s != "")


def split_by(text: Column, gap: str) -> Column:
    """Stripped non-blank pieces of a text between matches of ``gap``."""
    return _non_blank(F.split(text, gap, -1))


def split_sentences(text: Column) -> Column:
    """Sentences of a text, ending at . ! or ? and closing quotes or brackets, followed by white space."""
    return split_by(text, SENTENCE_GAP)


def split_arabic_sentences(text: Column) -> Column:
    """Pieces between runs of . ! the Arabic question mark or line ends, stripped, blanks dropped."""
    return _non_blank(F.split(text, C.ARABIC_SENTENCE_END, -1))


def first_arabic_piece(text: Column) -> Column:
    """The text before the first sentence end, untouched; it may be blank."""
    return F.get(F.split(text, C.ARABIC_SENTENCE_END, -1), F.lit(0))


def _pieces_with_start(text: Column, gap: str) -> Column:
    """Stripped non-blank pieces between matches of ``gap`` with their start offset in ``text``."""
    def place(pieces: Column, gaps: Column) -> Column:
        lengths = F.transform(pieces, lambda p, i: F.length(p) + F.coalesce(F.length(F.get(gaps, i)), F.lit(0)))
        return let(
            running_totals(lengths),
            lambda ends: F.transform(
                pieces,
                lambda p, i: F.struct(
                    strip(p).alias("sentence"),
                    (
                        F.coalesce(F.get(ends, i - 1), F.lit(0))
                        + F.length(p)
                        - F.length(F.ltrim(p, F.lit(C.WHITESPACE)))
                    ).alias("start_char"),
                ),
            ),
        )

    pieces = let(
        F.split(text, gap, -1),
        lambda ps: let(F.regexp_extract_all(text, F.lit(gap), F.lit(0)), lambda gaps: place(ps, gaps)),
    )
    return F.filter(pieces, lambda s: s["sentence"] != "")


def sentence_spans(text: Column) -> Column:
    """``split_sentences`` with the start offset (in code points) of each sentence."""
    return _pieces_with_start(text, SENTENCE_GAP)


def arabic_sentence_spans(text: Column) -> Column:
    """``split_arabic_sentences`` with the start offset of each piece."""
    return _pieces_with_start(text, C.ARABIC_SENTENCE_END)


def spans_of(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` as array<struct<token, start, end>>, offsets in code points.

    Matches and the gaps around them are read separately and their lengths summed up, so no marker
    character has to be planted in the text.
    """
    def place(tokens: Column, gaps: Column) -> Column:
        lengths = F.transform(tokens, lambda t, i: F.length(t) + F.length(F.get(gaps, i)))
        return let(
            running_totals(lengths),
            lambda ends: F.transform(
                tokens,
                lambda t, i: F.struct(
                    t.alias("token"),
                    (F.get(ends, i) - F.length(t)).alias("start"),
                    F.get(ends, i).alias("end"),
                ),
            ),
        )

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda tokens: let(F.split(text, pattern, -1), lambda gaps: place(tokens, gaps)),
    )


def wordpunct_tokenize(text: Column) -> Column:
    """Runs of word characters and runs of other visible characters."""
    return F.regexp_extract_all(text, F.lit(WORDPUNCT), F.lit(0))


def simple_word_tokenize(text: Column) -> Column:
    """Runs of word characters with their combining marks; every other visible character alone."""
    return F.regexp_extract_all(text, F.lit(SIMPLE_WORD), F.lit(0))


def _where_contains(text: Column, sign: str, rewrite: Callable[[Column], Column]) -> Column:
    """Rewrite only the texts that contain ``sign``, so the others skip the patterns."""
    return let(text, lambda t: F.when(F.contains(t, F.lit(sign)), rewrite(t)).otherwise(t))


def _open_quotes(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, r'^"', "`` "), r'"(?<=[ (\[{<]")', " `` ")


def _contractions(s: Column) -> Column:
    s = F.regexp_replace(s, r"'(?<=[^' ]')([sSmMdD]?) ", " '$1 ")
    s = F.regexp_replace(s, r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 ")
    s = F.regexp_replace(s, r"(?i)(?<=^| )('t)(is|was)(?![A-Za-z0-9_])", "$1 $2")
    return F.regexp_replace(s, r"(?i)(?<![A-Za-z0-9_])(d)('ye)(?![A-Za-z0-9_])", "$1 $2")


# Sentences in which no rule but those of _PLAIN_TOKEN has anything to do: no quotes, brackets or foreign signs, no runs of
# stops, dashes or commas, no blanks but the usual ones. The other words that are cut are told apart by _CUT_WORDS.
_PLAIN = (
    r"\A(?:[a-z A-Z0-9;@#$%&?!_/*+=~^|\\\s\p{L}\p{M}\p{N}]++|\.(?!\.)|-(?!-)|[:,](?![:,]))*+\z"
)
_PLAIN_TOKEN = r"(?:[a-zA-Z0-9\-_/*+=~^|\\\p{L}\p{M}\p{N}]++|\.(?!\s*\z)|[:,](?=[0-9]))++|\S"
_CUT_WORDS = ("gimme", "lemme", "cannot", "gonna", "gotta", "wanna")


def word_tokenize(sentence: Column) -> Column:
    """English tokens of one sentence after the published Penn Treebank tokenizer rules.

    A sentence of words, numbers and plain signs is read by one pattern, any other by the rules one after the other;
    where both apply they give the same tokens.
    """
    def cut(s: Column) -> Column:
        return let(F.lower(s), lambda low: reduce(or_, [F.contains(low, F.lit(w)) for w in _CUT_WORDS]))

    def either(s: Column) -> Column:
        plain = F.regexp_like(s, F.lit(_PLAIN)) & ~cut(s)
        return F.when(plain, F.regexp_extract_all(s, F.lit(_PLAIN_TOKEN), F.lit(0))).otherwise(_rule_tokens(s))

    return let(sentence, either)


def _rule_tokens(sentence: Column) -> Column:
    """The tokenizer rules in their order.

    Patterns start at the rare character they are about and look back from it, which is much faster
    than consuming the character before it.
    """
    s = _where_contains(sentence, '"', _open_quotes)
    s = F.regexp_replace(s, r"\.{2,}", " $0 ")
    s = F.regexp_replace(s, "[«“‘„»”’]", " $0 ")
    s = F.regexp_replace(s, r"([:,])([^0-9])", " $1 $2")
    s = F.regexp_replace(s, r"[:,]\z", " $0 ")
    s = F.regexp_replace(s, r"""\.(?<=[^.]\.)([\])}>"']*)\s*\z""", " .$1 ")
    s = F.regexp_replace(s, r"[;@#$%&?!\]\[(){}<>]", " $0 ")
    s = F.replace(s, F.lit("--"), F.lit(" -- "))
    s = F.replace(s, F.lit('"'), F.lit(" '' "))
    s = F.concat(s, F.lit(" "))
    s = _where_contains(s, "'", _contractions)
    s = F.regexp_replace(s, r"(?i)me(?![A-Za-z0-9_])(?<=(?<![A-Za-z0-9_])(?:gim|lem)me)", " $0")
    s = F.regexp_replace(s, r"not(?![A-Za-z0-9_])(?<=(?<![A-Za-z0-9_])[Cc]annot)", " not ")
    s = F.regexp_replace(s, r"[nt]a(?![A-Za-z0-9_])(?<=(?<![A-Za-z0-9_])(?:[Gg]on|[Gg]ot|[Ww]an)[nt]a)", " $0 ")
    return F.regexp_extract_all(s, F.lit(NON_SPACE), F.lit(0))
