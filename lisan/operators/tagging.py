"""Part-of-speech tables, lexicon training and noun phrases."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lisan.data import tables
from lisan.functions import grammar as R
from lisan.functions import tags as G
from lisan.functions import text as T
from lisan.functions.arrays import let
from lisan.operators.evaluate import align_arrays
from lisan.session import broadcast_if_small

# Words that are looked up inside a sentence's row, one to a place, and the bytes of the longest such word.
HELD_PLACES, HELD_BYTES = 1 << 17, 64
# Parts the tokens of a sentence that moves.
TOKEN_END = "\x1f"


@dataclass(frozen=True)
class Tagger:
    """A tokenizer with the tables that tag its tokens."""

    tokenizer: Callable[[Column], Column]
    lexicon: Mapping[str, Sequence[str]]
    shapes: Sequence[G.Shape]
    default: str
    context: Sequence[G.ContextRule] = field(default_factory=list)

    def base_tags(self, tokens: Column) -> Column:
        """Tags by lexicon and shape alone."""
        return G.tag_tokens(tokens, self.lexicon, self.shapes, self.default)


ENGLISH = Tagger(
    T.word_tokenize, tables.ENGLISH_LEXICON, tables.ENGLISH_SHAPES, tables.ENGLISH_DEFAULT, tables.ENGLISH_CONTEXT
)
ARABIC = Tagger(T.simple_word_tokenize, tables.ARABIC_LEXICON, tables.ARABIC_SHAPES, tables.ARABIC_DEFAULT)


def tagged_sentences(sents: DataFrame, tagger: Tagger = ENGLISH) -> DataFrame:
    """``(doc_id, sentence_index, tokens, base_tags, tags)``: one row per sentence, no shuffle."""
    tokens = sents.select("doc_id", "sentence_index", tagger.tokenizer(F.col("sentence")).alias("tokens"))
    based = tokens.withColumn("base_tags", tagger.base_tags(F.col("tokens")))
    return based.withColumn("tags", G.apply_context_rules(F.col("base_tags"), tagger.context))


def pos_table(sents: DataFrame, tagger: Tagger = ENGLISH, tag_column: str = "pos") -> DataFrame:
    """``(article_index, sentence_index, token_index, token, pos)`` of a whole corpus."""
    paired = F.arrays_zip(F.col("tokens").alias("token"), F.col("tags").alias("tag"))
    return (
        tagged_sentences(sents, tagger)
        .select("doc_id", "sentence_index", F.posexplode(paired).alias("token_index", "t"))
        .select(
            F.col("doc_id").alias("article_index"),
            "sentence_index",
            "token_index",
            F.col("t.token").alias("token"),
            F.col("t.tag").alias(tag_column),
        )
    )


def tag_pairs(gold: DataFrame, tagger: Tagger = ENGLISH) -> DataFrame:
    """``(gold, pred)`` rows of sentences given as ``tokens`` with their ``gold`` tags; fails on unequal lengths.

    For ``evaluate.prf1`` and ``evaluate.confusion_matrix``. The tags are compared inside the row.
    """
    tags = G.apply_context_rules(tagger.base_tags(F.col("tokens")), tagger.context)
    return gold.select(F.inline(align_arrays(F.col("gold"), tags)))


def train_lexicon(gold: DataFrame) -> DataFrame:
    """``(token, tag, n)``: the most frequent tag per lower-case token, ties by tag.

    Counts are folded before both shuffles, so a very frequent token costs one row per map task.
    """
    counts = gold.groupBy(F.lower("token").alias("token"), "tag").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("tag"))).alias("best")
    return counts.groupBy("token").agg(best).select("token", "best.tag", (-F.col("best.rank")).alias("n"))


def _place(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(HELD_PLACES)).cast("int")


def _held(words: DataFrame) -> DataFrame:
    """One row ``held``: the most frequent word of each place, array<struct<word, value>> by place."""
    fits = F.col("n").isNotNull() & (F.octet_length("word") <= HELD_BYTES)
    best = words.where(fits).groupBy(_place(F.col("word")).alias("place")).agg(F.max(F.struct("n", "word", "value")).alias("best"))
    every = words.sparkSession.range(HELD_PLACES, numPartitions=1).join(best, F.col("id") == F.col("place"), "left")
    entry = F.struct("id", F.struct("best.word", "best.value").alias("entry"))
    return every.agg(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["entry"]).alias("held"))


def _packed(tokens: Column) -> Column:
    """Tokens as one line, a third as large when moved; as they are if a line would not give them back."""
    unfit = (F.size(tokens) == 0) | F.exists(tokens, lambda t: t.isNull() | F.contains(t, F.lit(TOKEN_END)))
    return F.struct(
        F.when(~unfit, F.array_join(tokens, TOKEN_END)).alias("line"), F.when(unfit, tokens).alias("tokens")
    )


def _unpacked(packed: Column) -> Column:
    return F.coalesce(packed["tokens"], F.split(packed["line"], TOKEN_END, -1))


def looked_up(tokenized: DataFrame, words: DataFrame) -> DataFrame:
    """``(doc_id, sentence_index, found, ...)``: each sentence's ``tokens`` with the value of their word in a table.

    ``words`` is ``(word, value, n)``, of any size and unique by lower-case word; ``found`` is
    array<struct<token_index, token, value>> in order, with a null value for words that the table lacks. Other columns
    of ``tokenized`` go along. Sentences without tokens give no row; those of one name become one sentence.

    Up to HELD_PLACES words, the most frequent ones by ``n`` (null for those that must not be held), are looked up
    inside the sentence's row. Only the other tokens become rows and are joined with the table, which is unique by
    word, so adaptive execution may split their side. A sentence moves once, as a line, to meet them.
    """
    keys = ["doc_id", "sentence_index"]
    carried = [c for c in tokenized.columns if c not in (*keys, "tokens")]
    held = _held(words)

    def entry(token: Column, body: Callable[[Column, Column], Column]) -> Column:
        """``body`` of the token's lower-case form and of what is held at its place."""
        return let(F.lower(token), lambda low: let(F.get(F.col("held"), _place(low)), lambda e: body(low, e)))

    def other(token: Column, i: Column) -> Column:
        spot = F.struct(i.alias("token_index"), token.alias("token"))
        return entry(token, lambda low, e: F.when(F.coalesce(e["word"] != low, F.lit(True)), spot))

    def known(token: Column, i: Column) -> Column:
        spot = lambda e: F.struct(i.alias("token_index"), token.alias("token"), e["value"].alias("value"))
        return entry(token, lambda low, e: F.when(e["word"] == low, spot(e)))

    def in_order(here: Column) -> Column:
        alone = (F.size("spots") == 0) & (F.size("whole") == 1)
        return F.when(alone, here).otherwise(F.sort_array(F.concat(here, "spots")))

    # A subquery may not be named inside a higher-order function. As a column used once it is put there by the optimizer,
    # and no row ever holds the array. That needs a projection, so the generator comes after it; its outer form keeps
    # Spark from testing the array's size first, which would make the array twice.
    with_held = lambda df: df.withColumn("held", _held(words).scalar())
    others = with_held(tokenized).select(*keys, F.array_compact(F.transform("tokens", other)).alias("others"))
    others = others.select(*keys, F.inline_outer("others")).where("token_index IS NOT NULL")
    joined = others.join(broadcast_if_small(words.select("word", "value")), F.lower("token") == F.col("word"), "left")
    spots = joined.select(*keys, F.struct("token_index", "token", "value").alias("spot"))
    whole = tokenized.select(*keys, F.struct(let(F.col("tokens"), _packed).alias("packed"), *carried).alias("whole"))
    met = whole.unionByName(spots, allowMissingColumns=True).groupBy(*keys).agg(
        F.collect_list("whole").alias("whole"), F.collect_list("spot").alias("spots")
    )
    some = lambda p: p["line"].isNotNull() | (F.size(p["tokens"]) > 0)
    met = with_held(met.where(F.exists("whole", lambda w: some(w["packed"]))))
    here = F.flatten(F.transform("whole", lambda w: F.array_compact(F.transform(_unpacked(w["packed"]), known))))
    return met.select(*keys, let(here, in_order).alias("found"), *[F.get("whole", F.lit(0))[c].alias(c) for c in carried])


def tag_with_lexicon(tokenized: DataFrame, lexicon: DataFrame, tagger: Tagger = ENGLISH) -> DataFrame:
    """``tags`` for sentences with ``tokens``, from a lexicon table ``(token, tag)`` of any size, shapes for the rest.

    With counts ``n`` in the lexicon its most frequent words are those looked up in the sentence's row, see
    ``looked_up``. The tagger's context rules run on the array.
    """
    n = F.col("n") if "n" in lexicon.columns else F.lit(0)
    words = lexicon.select(F.col("token").alias("word"), F.col("tag").alias("value"), n.cast("bigint").alias("n"))
    found = looked_up(tokenized.select("doc_id", "sentence_index", "tokens"), words)
    tag = lambda s: F.coalesce(s["value"], G.shape_tag(s["token"], tagger.shapes, tagger.default))
    tags = G.apply_context_rules(F.transform("found", tag), tagger.context)
    return found.select("doc_id", "sentence_index", F.col("found.token").alias("tokens"), tags.alias("tags"))


def token_tags(tagged: DataFrame) -> DataFrame:
    """Long form of tagged sentences: ``(doc_id, sentence_index, token_index, token, tag)``."""
    paired = F.arrays_zip(F.col("tokens").alias("token"), F.col("tags").alias("tag"))
    return tagged.select("doc_id", "sentence_index", F.posexplode(paired).alias("token_index", "t")).select(
        "doc_id", "sentence_index", "token_index", "t.token", "t.tag"
    )


def noun_phrases(tagged: DataFrame) -> DataFrame:
    """``(doc_id, sentence_index, start_token, end_token, phrase)`` of tagged sentences."""
    return tagged.select("doc_id", "sentence_index", F.inline(G.np_chunks(F.col("tokens"), F.col("tags"))))


def grammar_chunks(tagged: DataFrame, grammar: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """``(doc_id, sentence_index, label, start_token, end_token, phrase)`` of tagged sentences by a tag grammar."""
    found = R.chunks(F.col("tokens"), F.col("tags"), R.compile_grammar(grammar))
    return tagged.select("doc_id", "sentence_index", F.inline(found))


def chunk_trees(tagged: DataFrame) -> DataFrame:
    """``(doc_id, sentence_index, tree)``: bracket text per sentence."""
    return tagged.select(
        "doc_id", "sentence_index", G.chunk_tree(F.col("tokens"), F.col("tags")).alias("tree")
    )
