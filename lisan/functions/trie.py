"""A phrase list as a trie of token prefixes that is walked inside the sentence's row."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from lisan.functions.arrays import let, positions
from lisan.functions.spans import leftmost_longest


@dataclass(frozen=True)
class PhraseTrie:
    """Token prefixes of phrases, each a string of tokens between blanks, looked up by hash.

    ``openers`` are the first tokens, ``prefixes`` all longer beginnings, ``labels`` the phrases of each label. A
    phrase with several labels has the least.
    """

    openers: tuple[str, ...]
    prefixes: tuple[str, ...]
    labels: tuple[tuple[str, tuple[str, ...]], ...]
    longest: int

    @classmethod
    def of(cls, phrases: Iterable[tuple[list[str], str]]) -> PhraseTrie:
        """From the tokens and label of each phrase; phrases without tokens are passed over."""
        named: dict[str, str] = {}
        prefixes: set[str] = set()
        openers, longest = set(), 0
        for words, label in phrases:
            if not words:
                continue
            phrase = " ".join(words)
            named[phrase] = min(named.get(phrase, label), label)
            openers.add(words[0])
            prefixes.update(" ".join(words[:k]) for k in range(2, len(words) + 1))
            longest = max(longest, len(words))
        labels: dict[str, list[str]] = {}
        for phrase, label in sorted(named.items()):
            labels.setdefault(label, []).append(phrase)
        return cls(
            tuple(sorted(openers)), tuple(sorted(prefixes)), tuple((k, tuple(v)) for k, v in sorted(labels.items())), longest
        )

    def _label(self, phrase: Column) -> Column:
        found = F.lit(None).cast("string")
        for label, phrases in reversed(self.labels):
            found = F.when(phrase.isin(*phrases), F.lit(label)).otherwise(found)
        return found

    def _longest_at(self, tokens: Column, start: Column) -> Column:
        """struct<start, back, label> of the longest phrase that begins at ``start``; back is its length negated, 0 if none."""
        phrases = [p for _, ps in self.labels for p in ps]

        def further(state: Column, k: Column) -> Column:
            prefix = F.concat(state["prefix"], F.lit(" "), F.get(tokens, start + k))
            alive = F.coalesce(prefix.isin(*self.prefixes), F.lit(False))
            return let(
                F.when(alive, prefix),
                lambda p: F.struct(
                    p.alias("prefix"), F.when(p.isin(*phrases), -(k + 1)).otherwise(state["back"]).alias("back")
                ),
            )

        def done(state: Column) -> Column:
            phrase = F.array_join(F.slice(tokens, start + 1, -state["back"]), " ")
            return F.struct(
                start.alias("start"), state["back"].alias("back"), F.when(state["back"] < 0, self._label(phrase)).alias("label")
            )

        first = F.get(tokens, start)
        state = F.struct(first.alias("prefix"), F.when(first.isin(*phrases), -1).otherwise(0).alias("back"))
        if self.longest < 2:
            return let(state, done)
        return F.aggregate(F.sequence(F.lit(1), F.lit(self.longest - 1)), state, further, done)

    def matches(self, tokens: Column) -> Column:
        """Phrases in a token array as array<struct<start, back, label>>: leftmost, then longest, none overlapping.

        Null if no token opens a phrase. Only where a token opens a phrase is the trie walked, and only as far as some phrase goes on.
        """
        if not self.openers:
            return F.array().cast("array<struct<start:int,back:int,label:string>>")

        def walked(ts: Column, starts: Column) -> Column:
            hits = F.filter(F.transform(starts, lambda i: self._longest_at(ts, i)), lambda h: h["back"] < 0)
            return let(hits, lambda hs: F.when(F.size(hs) > 1, leftmost_longest(hs)).otherwise(hs))

        def opened(ts: Column) -> Column:
            starts = F.filter(positions(ts), lambda i: F.get(ts, i).isin(*self.openers))
            return let(starts, lambda at: F.when(F.size(at) > 0, walked(ts, at)))

        return let(tokens, opened)
