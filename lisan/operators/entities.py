"""Named entities by phrase list, pattern or caller's model, and labels for tokens."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from lisan import constants as C
from lisan.functions import spans as S
from lisan.functions import text as T
from lisan.functions.arrays import let
from lisan.functions.trie import PhraseTrie
from lisan.session import broadcast_if_small, is_small, written

# A phrase list up to this size travels inside the expression as a trie.
TRIE_PHRASES = 2_000
TRIE_BYTES = 200_000
# Characters of a bin when tokens look for the entities around them.
CHAR_BIN = 256


def gazetteer_table(spark: SparkSession, phrases: list[tuple[str, str]]) -> DataFrame:
    """A phrase list as a table ``(phrase, label)``."""
    return spark.createDataFrame(phrases, "phrase string, label string")


def phrase_trie(gazetteer: DataFrame) -> PhraseTrie | None:
    """The trie of a phrase list, or None if the list is too long to travel inside an expression."""
    if not is_small(gazetteer, TRIE_PHRASES, TRIE_BYTES):
        return None
    words = gazetteer.select(T.wordpunct_tokenize(F.col("phrase")).alias("words"), "label")
    return PhraseTrie.of((list(r["words"]), r["label"]) for r in words.where("words IS NOT NULL").collect())


def gazetteer_matches(sents: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Non-overlapping gazetteer phrases of each sentence: leftmost, then longest.

    Input ``(doc_id, sentence_index, sentence, ...)``; output one row per match: the keys, ``start_char`` and
    ``sentence`` if given, ``entity``, ``label``, ``start``, ``end`` (offsets in the sentence), ``start_token``,
    ``end_token``.

    A trie of the phrases is walked inside the sentence's row: one scan, no row per token, and offsets only in
    sentences with a match. A longer list is joined, see ``_joined_matches``; the results are the same.
    """
    trie = phrase_trie(gazetteer)
    if trie is None:
        return _joined_matches(sents, gazetteer)
    carried = ["doc_id", "sentence_index", *(c for c in ("start_char",) if c in sents.columns)]

    def placed(hits: Column) -> Column:
        return let(
            T.spans_of(F.col("sentence"), T.WORDPUNCT),
            lambda ts: F.transform(hits, lambda h: _placed(ts, h["start"], h["start"] - h["back"], h["label"])),
        )

    found = let(
        trie.matches(T.wordpunct_tokenize(F.col("sentence"))), lambda hits: F.when(F.size(hits) > 0, placed(hits))
    )
    rows = sents.select(*carried, "sentence", F.inline(found))
    return rows.select(*carried, "sentence", "entity", "label", "start", "end", "start_token", "end_token")


def _placed(spans: Column, first: Column, end: Column, label: Column) -> Column:
    """A match of the tokens ``first`` to ``end`` as a struct with its place in the sentence."""
    start, stop = F.get(spans, first)["start"], F.get(spans, end - 1)["end"]
    return F.struct(
        F.substring(F.col("sentence"), start + 1, stop - start).alias("entity"), label.alias("label"),
        start.alias("start"), stop.alias("end"), first.alias("start_token"), end.alias("end_token"),
    )


def _joined_matches(sents: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """``gazetteer_matches`` for a list of any length.

    A token becomes a row with the tokens that follow it only to find out whether it opens a phrase; what does goes
    on, at the lengths of that opener's phrases, to the join with the phrases. Both lists are unique by their key, so
    a frequent opener is on the other side, which adaptive execution may split. Sentences are joined back to the
    matches, never to tokens.
    """
    words = gazetteer.select(T.wordpunct_tokenize(F.col("phrase")).alias("words"), "label").where(F.size("words") > 0)
    phrases = words.groupBy(F.array_join("words", " ").alias("phrase")).agg(F.min("label").alias("label"))
    lengths = words.groupBy(F.get("words", F.lit(0)).alias("opener")).agg(F.collect_set(F.size("words")).alias("lengths"))
    longest = words.agg(F.max(F.size("words"))).first()[0] or 1
    keys = ["doc_id", "sentence_index"]

    def opened(ts: Column) -> Column:
        return F.transform(
            ts, lambda t, i: F.struct(i.alias("first"), t.alias("opener"), F.slice(ts, i + 1, F.lit(longest)).alias("ahead"))
        )

    tokens = sents.select(*keys, F.inline(let(T.wordpunct_tokenize(F.col("sentence")), opened)))
    open_ = tokens.join(broadcast_if_small(lengths), "opener")
    fits = F.filter("lengths", lambda n: n <= F.size("ahead"))
    runs = open_.select(*keys, "first", "ahead", F.explode(fits).alias("length")).select(
        *keys, "first", "length", F.array_join(F.slice("ahead", F.lit(1), F.col("length")), " ").alias("phrase")
    )
    hits = runs.join(broadcast_if_small(phrases), "phrase")
    hit = F.struct(F.col("first").alias("start"), (-F.col("length")).alias("back"), "label")
    kept = hits.groupBy(*keys).agg(S.leftmost_longest(F.collect_list(hit)).alias("kept"))
    carried = [c for c in ("start_char",) if c in sents.columns]
    placed = let(
        T.spans_of(F.col("sentence"), T.WORDPUNCT),
        lambda ts: F.transform("kept", lambda h: _placed(ts, h["start"], h["start"] - h["back"], h["label"])),
    )
    rows = kept.join(sents.select(*keys, *carried, "sentence"), keys).select(*keys, *carried, "sentence", F.inline(placed))
    return rows.select(*keys, *carried, "sentence", "entity", "label", "start", "end", "start_token", "end_token")


def extract_entities(located: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """English records: entity text, label and offsets in the article."""
    found = gazetteer_matches(located, gazetteer)
    return found.select(
        F.col("doc_id").alias("article_index"),
        F.col("entity").alias("text"),
        "label",
        (F.col("start_char") + F.col("start")).alias("start_char"),
        (F.col("start_char") + F.col("end")).alias("end_char"),
    )


def extract_entities_by_sentence(sents: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Arabic records: entity, label, offsets in the sentence, and the sentence itself."""
    found = gazetteer_matches(sents, gazetteer)
    return found.select(
        F.col("doc_id").alias("article_index"), "sentence_index", "entity", "label", "start", "end", "sentence"
    )


def extract_pattern_entities(docs: DataFrame, patterns: list[tuple[str, str]]) -> DataFrame:
    """English records by regular expression rules; one scan for all rules, no shuffle."""
    return docs.select(
        F.col("doc_id").alias("article_index"),
        F.inline(S.pattern_entities(F.col("text"), patterns)),
    )


def merge_entities(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One list per article without overlaps from several ``(article_index, text, label, start_char, end_char)``.

    The leftmost entity wins, then the longest, then the label first in order; each article's entities meet in one
    row, never its text.
    """
    every = first
    for other in others:
        every = every.unionByName(other)
    span = F.struct(
        F.col("start_char").alias("start"), (F.col("start_char") - F.col("end_char")).alias("back"), "label", "text"
    )
    kept = every.groupBy("article_index").agg(S.leftmost_longest(F.collect_list(span)).alias("kept"))
    return kept.select("article_index", F.inline("kept")).select(
        "article_index", "text", "label", F.col("start").alias("start_char"),
        (F.col("start") - F.col("back")).alias("end_char"),
    )


def predict_partitions(
    docs: DataFrame,
    factory: Callable[[], Callable[[list[str]], list[list[dict]]]],
    record: t.StructType,
) -> DataFrame:
    """Run a caller's model over ``(doc_id, text)``: ``factory`` builds it once per task.

    The model maps a batch of texts to a list of dicts, with the fields of ``record``, for each text.
    """
    schema = t.StructType([t.StructField("article_index", t.LongType()), *record.fields])
    columns = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for batch in batches:
            found = model(batch["text"].tolist())
            rows = [{"article_index": i, **e} for i, es in zip(batch["doc_id"], found) for e in es]
            yield pd.DataFrame(rows, columns=columns)

    return docs.select("doc_id", "text").mapInPandas(run, schema)


def entity_preview(entities: DataFrame) -> DataFrame:
    """One formatted line per ``(entity, label, score)`` row."""
    return entities.withColumn("line", S.format_entity(F.col("entity"), F.col("label"), F.col("score")))


def bio_to_spans(labelled: DataFrame) -> DataFrame:
    """Spans of ``(doc_id, sentence_index, labels, scores)`` rows, merged within the row."""
    return labelled.select(
        "doc_id", "sentence_index", F.inline(S.bio_spans(F.col("labels"), F.col("scores")))
    )


def _label_array(size: Column, spans: Column) -> Column:
    """Labels of ``size`` tokens by sorted array<struct<start, end, label>>; where spans overlap the later wins."""
    def in_turn(ss: Column) -> Column:
        parts = F.transform(
            ss,
            lambda s, k: F.concat(
                F.array_repeat(F.lit(C.OUTSIDE), s["start"] - F.coalesce(F.get(ss, k - 1)["end"], F.lit(0))),
                F.array_repeat(s["label"], s["end"] - s["start"]),
            ),
        )
        rest = F.array_repeat(F.lit(C.OUTSIDE), size - F.get(ss, F.size(ss) - 1)["end"])
        return F.concat(F.flatten(parts), rest)

    def by_token(ss: Column) -> Column:
        over = lambda i: F.filter(ss, lambda s: (s["start"] <= i) & (i < s["end"]))
        each = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.array_max(over(i))["label"])
        return F.transform(each, lambda x: F.coalesce(x, F.lit(C.OUTSIDE)))

    def label(ss: Column) -> Column:
        ends = F.transform(ss, lambda s: s["end"])
        apart = F.forall(F.transform(ss, lambda s, k: s["start"] >= F.coalesce(F.get(ends, k - 1), F.lit(0))), lambda x: x)
        inside = F.get(ends, F.size(ends) - 1) <= size
        return F.when(size == 0, F.array().cast("array<string>")).when(apart & inside, in_turn(ss)).otherwise(by_token(ss))

    return let(spans, lambda ss: F.when(ss.isNull(), F.array_repeat(F.lit(C.OUTSIDE), size)).otherwise(label(ss)))


def labelled_sentences(tokenized: DataFrame, spans: DataFrame, column: str = "labels") -> DataFrame:
    """Add the label array of each sentence's ``tokens`` by ``(doc_id, sentence_index, start_token, end_token, label)``.

    Spans are folded per sentence, so the join has one row per sentence and side; tokens stay in their sentence.
    """
    keys = ["doc_id", "sentence_index"]
    span = F.struct(F.col("start_token").alias("start"), F.col("end_token").alias("end"), "label")
    folded = spans.where("end_token > start_token").groupBy(keys).agg(F.sort_array(F.collect_list(span)).alias("ss"))
    joined = tokenized.join(folded, keys, "left")
    return joined.withColumn(column, _label_array(F.size("tokens"), F.col("ss"))).drop("ss")


def phrase_labels(sents: DataFrame, gazetteers: Mapping[str, DataFrame]) -> DataFrame:
    """``(doc_id, sentence_index, tokens, ...)``: a label array by each named phrase list, all in one pass.

    Lists that are too long for a trie are matched by join, one after the other.
    """
    out = sents.select("doc_id", "sentence_index", T.wordpunct_tokenize(F.col("sentence")).alias("tokens"))
    tries = {name: phrase_trie(gazetteer) for name, gazetteer in gazetteers.items()}

    def labels(trie: PhraseTrie) -> Column:
        spans = F.transform(
            trie.matches(F.col("tokens")),
            lambda h: F.struct(h["start"].alias("start"), (h["start"] - h["back"]).alias("end"), h["label"].alias("label")),
        )
        return _label_array(F.size("tokens"), F.when(F.size(spans) > 0, spans))

    small = {name: labels(trie) for name, trie in tries.items() if trie is not None}
    out = out.withColumns(small) if small else out
    for name in [name for name, trie in tries.items() if trie is None]:
        out = labelled_sentences(out, _joined_matches(sents, gazetteers[name]), name)
    return out


def token_rows(labelled: DataFrame, column: str = "labels") -> DataFrame:
    """``(doc_id, sentence_index, token_index, token, label)`` of sentences with ``tokens`` and a label array."""
    paired = F.arrays_zip(F.col("tokens").alias("token"), F.col(column).alias("label"))
    return labelled.select("doc_id", "sentence_index", F.posexplode(paired).alias("token_index", "x")).select(
        "doc_id", "sentence_index", "token_index", "x.token", "x.label"
    )


def token_labels(tokenized: DataFrame, spans: DataFrame) -> DataFrame:
    """``(doc_id, sentence_index, token_index, token, label)`` of sentences with ``tokens``; later spans win."""
    return token_rows(labelled_sentences(tokenized, spans))


def _bin_of(char: Column) -> Column:
    return F.floor(char / CHAR_BIN).cast("int")


def _near_sentences(located: DataFrame, entities: DataFrame) -> DataFrame:
    """``(doc_id, sentence_index, start_char, bins)``: entities around each sentence, array by bin from the sentence's first.

    The join has a row for each bin that a sentence touches and none of its text; sentences without entities give no row.
    """
    keys = ["doc_id", "sentence_index", "start_char"]
    entity = F.struct(F.col("start_char").alias("from"), F.col("end_char").alias("to"), "label")
    touched = F.sequence(_bin_of(F.col("start_char")), _bin_of(F.col("end_char") - 1))
    near = (
        entities.where("end_char > start_char")
        .select(F.col("article_index").alias("doc_id"), F.explode(touched).alias("bin"), entity.alias("entity"))
        .groupBy("doc_id", "bin").agg(F.collect_set("entity").alias("near"))
    )
    first, last = _bin_of(F.col("start_char")), _bin_of(F.col("start_char") + F.length("sentence"))
    asked = located.select(*keys, F.posexplode(F.sequence(first, last)).alias("at", "bin"))
    found = asked.join(broadcast_if_small(written(near)), ["doc_id", "bin"]).select(*keys, F.struct("at", "near").alias("b"))
    by_place = found.groupBy(*keys).agg(F.sort_array(F.collect_set("b")).alias("bs"))
    # Bins without entities between those that have some are filled, so that a token finds its bin by number.
    gap = lambda bs, k: F.get(bs, k)["at"] - F.coalesce(F.get(bs, k - 1)["at"], F.lit(-1)) - 1
    none = F.expr("cast(array() AS array<struct<from:int,to:int,label:string>>)")
    filled = lambda bs: F.flatten(F.transform(bs, lambda b, k: F.concat(F.array_repeat(none, gap(bs, k)), F.array(b["near"]))))
    return by_place.select(*keys, let(F.col("bs"), filled).alias("bins"))


def token_labels_by_char(located: DataFrame, entities: DataFrame, pattern: str = T.WORDPUNCT) -> DataFrame:
    """Label the tokens of located sentences that lie inside an entity's characters; later entities win.

    An interval join by bins of ``CHAR_BIN`` characters: an entity is folded into each bin of its article that it
    touches, a sentence meets the bins it touches, and a token asks only the bin it starts in, so an article may have
    any number of entities. Tokens are made in the sentence's row after that, and never moved.
    """
    keys = ["doc_id", "sentence_index", "start_char"]
    joined = located.select(*keys, "sentence").join(broadcast_if_small(written(_near_sentences(located, entities))), keys, "left")

    def placed(s: Column, label: Callable[[Column, Column], Column]) -> Column:
        start, end = F.col("start_char") + s["start"], F.col("start_char") + s["end"]
        return F.struct(s["token"].alias("token"), start.alias("start_char"), end.alias("end_char"), label(start, end).alias("label"))

    def label_of(start: Column, end: Column) -> Column:
        near = F.get("bins", _bin_of(start) - _bin_of(F.col("start_char")))
        around = F.filter(near, lambda e: (e["from"] <= start) & (end <= e["to"]))
        return F.coalesce(F.when(F.size(near) > 0, F.array_max(around)["label"]), F.lit(C.OUTSIDE))

    def labelled(found: Column) -> Column:
        outside = F.transform(found, lambda s: placed(s, lambda *_: F.lit(C.OUTSIDE)))
        return F.when(F.col("bins").isNull(), outside).otherwise(F.transform(found, lambda s: placed(s, label_of)))

    spans = let(T.spans_of(F.col("sentence"), pattern), labelled)
    rows = joined.select("doc_id", "sentence_index", F.posexplode(spans).alias("token_index", "s"))
    return rows.select("doc_id", "sentence_index", "token_index", "s.*")
