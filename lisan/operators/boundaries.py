"""Sentence ends learned from the corpus itself: abbreviations and sentence starters by log-likelihood over type counts.

After Kiss and Strunk, "Unsupervised Multilingual Sentence Boundary Detection" (2006). Nothing is labelled: a word is an
abbreviation if it comes with a full stop much more often than words do, the more so the shorter it is.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lisan import constants as C
from lisan.functions import text as T
from lisan.functions.arrays import let
from lisan.session import broadcast_if_small, is_small, written

# Fixed values of the paper: least scores, and the share of its tokens that an abbreviation has a full stop with.
ABBREVIATION_SCORE, STARTER_SCORE, STOP_SHARE = 0.3, 30.0, 0.99
# Learned words travel inside the splitting expression; a longer list asks for a higher score.
MOST_WORDS, MOST_BYTES = 5_000, 200_000

# A sentence end, what forbids it, and what allows it all the same; %s stands for learned words.
_ENDS = rf"(?<=[.!?][{C.CLOSERS}]{{0,3}})"
_GUARD = rf"(?<!(?<![\p{{L}}\p{{N}}.])(?iu:%s)\.[{C.CLOSERS}]{{0,3}})"
_NEXT_WORD = rf"[{T.SPACE_CLASS}]+[^\p{{L}}\p{{N}}{T.SPACE_CLASS}]*"
_LATER = rf"(?={_NEXT_WORD}\p{{Lu}})(?={_NEXT_WORD}(?iu:%s)(?![\p{{L}}\p{{N}}]))"


def _core(token: Column) -> Column:
    """A token from its first letter or digit to its last one or full stop; empty without one."""
    return F.regexp_extract(token, r"(?s)[\p{L}\p{N}](?:.*[\p{L}\p{N}.])?", 0)


def _typed(core: Column) -> Column:
    """struct<type, stop>: the lower-case word of a core with a letter and whether one full stop ends it; else null."""
    many = F.endswith(core, F.lit(".."))
    stop = F.endswith(core, F.lit(".")) & ~many
    word = F.lower(F.when(stop, F.left(core, F.length(core) - 1)).otherwise(core))
    return F.when(~many & core.rlike(r"\p{L}"), F.struct(word.alias("type"), stop.alias("stop")))


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(T.NON_SPACE), F.lit(0))


def token_pairs(docs: DataFrame) -> DataFrame:
    """``(lang, token, before, c)``: how often each token comes after each token that closes with . ! or ?, else null.

    Tokens are folded inside each map task before any pattern looks at them, so a frequent one is a row per task in
    the shuffle. A null language is the empty string.
    """
    lists = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), _tokens(F.col("text")).alias("ts"))
    last = F.slice(F.concat(F.array(F.lit(None).cast("string")), "ts"), F.lit(1), F.size("ts"))
    tokens = lists.select("lang", F.inline(F.arrays_zip("ts", last)).alias("token", "last"))
    # A cheap test first: nearly every token closes with a letter.
    end = ~F.right("last", F.lit(1)).between("a", "z") & F.col("last").rlike(rf"[.!?][{C.CLOSERS}]*$")
    tokens = tokens.select("lang", "token", F.when(end, F.col("last")).alias("before"))
    return tokens.groupBy("lang", "token", "before").agg(F.count(F.lit(1)).alias("c"))


def type_counts(docs: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """``(lang, type, stopped, plain)``: how often each word comes with and without a full stop, by language.

    Tokens are folded before the patterns, and words after them. ``pairs`` are the documents' ``token_pairs`` if they
    are there already. A null language is the empty string.
    """
    if pairs is None:
        named = docs.select("text", F.coalesce("lang", F.lit("")).alias("lang"))
        tokens = named.select("lang", F.explode(_tokens(F.col("text"))).alias("token"))
        folded = tokens.groupBy("lang", "token").agg(F.count(F.lit(1)).alias("c"))
    else:
        folded = pairs.groupBy("lang", "token").agg(F.sum("c").alias("c"))
    types = F.filter(F.array(let(_core(F.col("token")), _typed)), lambda x: x.isNotNull())
    words = folded.select("lang", "c", F.inline(types))
    none = F.lit(0).cast("bigint")
    return words.groupBy("lang", "type").agg(
        F.coalesce(F.sum(F.when(F.col("stop"), F.col("c"))), none).alias("stopped"),
        F.coalesce(F.sum(F.when(~F.col("stop"), F.col("c"))), none).alias("plain"),
    )


def _xlogy(x: Column, y: Column) -> Column:
    return F.when(x == 0, 0.0).otherwise(x * F.ln(F.when(x == 0, 1.0).otherwise(y)))


def abbreviations(docs: DataFrame, least: float = ABBREVIATION_SCORE, pairs: DataFrame | None = None) -> DataFrame:
    """``(lang, type, stopped, plain, score)`` of the words that are abbreviations in their language.

    The score is the log-likelihood ratio of "a full stop follows nearly always" against "as often as after any
    word", times e to the minus its letters, times its full stops, and less for each time it comes without. The
    totals are one row per language. ``pairs`` are the documents' ``token_pairs`` if they are there already.
    """
    counts = written(type_counts(docs, pairs))
    totals = counts.groupBy("lang").agg(F.sum("stopped").alias("stops"), F.sum(F.col("stopped") + F.col("plain")).alias("tokens"))
    share = F.col("stops") / F.col("tokens")
    rest, some = F.col("plain"), F.col("stopped")
    null = _xlogy(some, share) + _xlogy(rest, 1 - share)
    other = some * F.ln(F.lit(STOP_SHARE)) + rest * F.ln(F.lit(1 - STOP_SHARE))
    stops = F.length("type") - F.length(F.replace("type", F.lit("."), F.lit(""))) + 1
    letters = F.length("type") - stops + 1
    score = -2 * (null - other) * F.exp(-letters) * stops * F.pow(letters.cast("double"), -rest.cast("double"))
    scored = counts.where("stopped > 0").join(broadcast_if_small(totals), "lang").withColumn("score", score)
    return scored.where(F.col("score") >= least).select("lang", "type", "stopped", "plain", "score")


def _by_language(words: DataFrame) -> dict[str, list[str]]:
    """The words of a ``(lang, type)`` table by language; refused if they are too many to travel in an expression."""
    if not is_small(words.select("lang", "type"), MOST_WORDS, MOST_BYTES):
        raise ValueError("too many learned words; ask for a higher score")
    out: dict[str, list[str]] = {}
    for row in words.select("lang", "type").collect():
        out.setdefault(row["lang"], []).append(row["type"])
    return {lang: sorted(types) for lang, types in sorted(out.items())}


def sentence_starters(
    docs: DataFrame, shortened: DataFrame, least: float = STARTER_SCORE, pairs: DataFrame | None = None
) -> DataFrame:
    """``(lang, type, n, starts, score)``: words that follow a sentence end more often than chance has it.

    An end is a token that closes with . ! or ? and is none of the ``shortened`` words. The score is the
    log-likelihood ratio of the two rates, with and without an end before. Tokens are folded with the end before them
    before they are looked at; the ``shortened`` words are joined, so they may be any number. ``pairs`` are the
    documents' ``token_pairs`` if they are there already.
    """
    folded = token_pairs(docs) if pairs is None else pairs
    # A generator, so that no filter or field asks for the patterns again.
    seen = let(
        _core(F.col("token")),
        lambda own: let(
            let(_core(F.col("before")), _typed),
            lambda cut: F.array(
                F.struct(_typed(own)["type"].alias("type"), F.col("before").isNotNull().alias("end"), F.when(cut["stop"], cut["type"]).alias("cut"))
            ),
        ),
    )
    words = folded.select("lang", "c", F.inline(F.filter(seen, lambda x: x["type"].isNotNull())))
    words = words.groupBy("lang", "type", "end", "cut").agg(F.sum("c").alias("c"))
    known = shortened.select("lang", F.col("type").alias("cut"), F.lit(True).alias("shorter")).distinct()
    marked = words.join(broadcast_if_small(known), ["lang", "cut"], "left")
    starts = F.when(F.col("end") & F.col("shorter").isNull(), F.col("c"))
    counts = written(
        marked.groupBy("lang", "type").agg(F.sum("c").alias("n"), F.coalesce(F.sum(starts), F.lit(0).cast("bigint")).alias("starts"))
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("tokens"), F.sum("starts").alias("ends"))
    n, a, b, ab = F.col("tokens"), F.col("ends"), F.col("n"), F.col("starts")
    p, p1, p2 = b / n, ab / a, (b - ab) / F.nullif(n - a, F.lit(0))
    rest = n - a - b + ab
    one_rate = _xlogy(ab, p) + _xlogy(a - ab, 1 - p) + _xlogy(b - ab, p) + _xlogy(rest, 1 - p)
    two_rates = _xlogy(ab, p1) + _xlogy(a - ab, 1 - p1) + _xlogy(b - ab, p2) + _xlogy(rest, 1 - p2)
    scored = counts.where("starts > 0").join(broadcast_if_small(totals), "lang").withColumn("score", -2 * (one_rate - two_rates))
    return scored.where((F.col("score") >= least) & (ab * n > b * a)).select("lang", "type", "n", "starts", "score")


@dataclass(frozen=True)
class SentenceEnds:
    """Learned words by language, to split texts with."""

    shortened: Mapping[str, Sequence[str]]
    starters: Mapping[str, Sequence[str]]

    @classmethod
    def learned(cls, docs: DataFrame, least: float = ABBREVIATION_SCORE) -> SentenceEnds:
        """Learn both lists from ``(text, lang)`` documents."""
        pairs = written(token_pairs(docs))
        shortened = written(abbreviations(docs, least, pairs))
        return cls(_by_language(shortened), _by_language(sentence_starters(docs, shortened, pairs=pairs)))

    def gap(self, lang: str) -> str:
        """The pattern of the blanks between two sentences of a language.

        A full stop after an abbreviation ends a sentence only before a capitalised sentence starter.
        """
        either = lambda words: "|".join(map(re.escape, words))
        ends = _ENDS
        if self.shortened.get(lang):
            guard = _GUARD % either(self.shortened[lang])
            if self.starters.get(lang):
                guard = f"(?:{guard}|{_LATER % either(self.starters[lang])})"
            ends += guard
        return ends + rf"[{T.SPACE_CLASS}]+"

    def split(self, text: Column, lang: Column) -> Column:
        """Sentences of a text by the pattern of its language; a language without learned words has plain ends."""
        out = T.split_by(text, self.gap(""))
        for name in {**self.shortened, **self.starters}:
            if name:
                out = F.when(lang == name, T.split_by(text, self.gap(name))).otherwise(out)
        return out


def _folded(word: Column) -> Column:
    """A word without the differences that a pattern overlooks with (?iu), and some more."""
    return F.translate(F.lower(F.upper(F.lower(word))), "\u0307", "")


def _filled(pattern: str, words: Column) -> Column:
    """The pattern with a choice of ``words`` in place of %s."""
    quoted = F.transform(F.array_sort(words), lambda w: F.regexp_replace(w, r"([^\p{L}\p{N}])", r"\\$1"))
    before, after = pattern.split("%s")
    return F.concat(F.lit(before), F.array_join(quoted, "|"), F.lit(after))


def _at_ends(text: Column, shortened: int | None, starters: int | None) -> Column:
    """array<struct<starts, word>>: what stands before and after full stops, up to the lengths of the longest words."""
    letter = rf"[!-~[^{T.SPACE_CLASS}]]"
    found = []
    if shortened:
        before = rf"(?<![\p{{L}}\p{{N}}.])(?=({letter}{{1,{shortened}}})\.[{C.CLOSERS}]{{0,3}}[{T.SPACE_CLASS}])"
        found.append((False, F.regexp_extract_all(text, F.lit(before), F.lit(1))))
    if shortened and starters:
        after = rf"\.(?=[{C.CLOSERS}]{{0,3}}{_NEXT_WORD}({letter}{{1,{starters}}}))"
        # The beginnings of a word are the ends of it read backwards.
        ends = lambda w: F.regexp_extract_all(F.reverse(w), F.lit(r"(?<![\p{L}\p{N}])(?=(.+)$)"), F.lit(1))
        words = F.array_distinct(F.regexp_extract_all(text, F.lit(after), F.lit(1)))
        found.append((True, F.transform(F.flatten(F.transform(words, ends)), F.reverse)))

    def marked(starts: bool, words: Column) -> Column:
        return F.transform(F.array_distinct(F.transform(words, _folded)), lambda w: F.struct(F.lit(starts).alias("starts"), w.alias("word")))

    each = [marked(*x) for x in found]
    return F.concat(*each) if each else F.array().cast("array<struct<starts:boolean,word:string>>")


@dataclass(frozen=True)
class EndTables:
    """Learned words as tables ``(lang, type)`` of any size; their words begin with a letter or digit."""

    shortened: DataFrame
    starters: DataFrame

    @classmethod
    def learned(cls, docs: DataFrame, least: float = ABBREVIATION_SCORE) -> EndTables:
        """Learn both tables from ``(text, lang)`` documents."""
        pairs = written(token_pairs(docs))
        shortened = written(abbreviations(docs, least, pairs).select("lang", "type"))
        return cls(shortened, written(sentence_starters(docs, shortened, pairs=pairs).select("lang", "type")))

    def split(self, docs: DataFrame) -> DataFrame:
        """``(doc_id, sentences)`` as ``SentenceEnds.split`` has them.

        Each text gets the pattern of those learned words that may stand at its own ends: words before and after full
        stops are joined with the tables, what is found is folded by text, and the texts meet their words by digest.
        """
        tables = self.shortened.select("lang", "type", F.lit(False).alias("starts"))
        tables = tables.unionByName(self.starters.select("lang", "type", F.lit(True).alias("starts")))
        tables = written(tables.select("lang", _folded(F.col("type")).alias("word"), "starts", "type"))
        longest = {r["starts"]: r["n"] for r in tables.groupBy("starts").agg(F.max(F.length("type")).alias("n")).collect()}
        languages = tables.select("lang").distinct()
        named = docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("own")).join(
            broadcast_if_small(languages), F.col("own") == F.col("lang"), "left"
        )
        named = named.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang"), F.sha2("text", 256).alias("digest"))
        asked = named.select("lang", "digest", F.inline(_at_ends(F.col("text"), longest.get(False), longest.get(True))))
        hits = asked.join(broadcast_if_small(tables), ["lang", "word", "starts"]).groupBy("lang", "digest").agg(
            F.collect_set(F.when(~F.col("starts"), F.col("type"))).alias("shortened"),
            F.collect_set(F.when(F.col("starts"), F.col("type"))).alias("starters"),
        )
        met = named.join(broadcast_if_small(written(hits)), ["lang", "digest"], "left")
        guard = _filled(_GUARD, F.col("shortened"))
        either = F.concat(F.lit("(?:"), guard, F.lit("|"), _filled(_LATER, F.col("starters")), F.lit(")"))
        guard = F.when(F.size("shortened") > 0, F.when(F.size("starters") > 0, either).otherwise(guard)).otherwise("")
        gap = F.concat(F.lit(_ENDS), guard, F.lit(rf"[{T.SPACE_CLASS}]+"))
        return met.select("doc_id", T.split_by(F.col("text"), gap).alias("sentences"))


def learned_sentences(docs: DataFrame, ends: SentenceEnds | EndTables) -> DataFrame:
    """``(doc_id, sentence_index, sentence)`` of ``(doc_id, text, lang)`` documents by learned sentence ends."""
    if isinstance(ends, EndTables):
        return ends.split(docs).select("doc_id", F.posexplode("sentences").alias("sentence_index", "sentence"))
    return docs.select(
        "doc_id", F.posexplode(ends.split(F.col("text"), F.coalesce("lang", F.lit("")))).alias("sentence_index", "sentence")
    )
