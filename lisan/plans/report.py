"""The summary report and the whole analysis of an English and an Arabic corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lisan import constants as C
from lisan.data import tables
from lisan.functions import text as T
from lisan.operators import bigrams, corpus, entities, evaluate, generate, split, stats, tagging
from lisan.session import written
from lisan.sources.files import write_csv, write_lines


def english_grams(docs: DataFrame) -> tuple[DataFrame, split.Cut]:
    """Counts over lower-case word tokens; test bigrams inside sentences only."""
    cut = split.locate_cut(split.sentence_counts(docs))
    tokens = corpus.tokenized(corpus.sentences(docs), T.word_tokenize, lowercase=True)
    return bigrams.count_grams(tokens, cut, boundaries=False), cut


def arabic_grams(docs: DataFrame) -> tuple[DataFrame, split.Cut]:
    """Counts over word and punctuation runs; test bigrams with sentence boundaries."""
    cut = split.locate_cut(split.sentence_counts(docs))
    tokens = corpus.tokenized(corpus.sentences(docs), T.wordpunct_tokenize)
    return bigrams.count_grams(tokens, cut, boundaries=True), cut


def _quoted(text: Column) -> Column:
    """A string as Python's repr shows it, for text without control characters."""
    plain = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    has_single, has_double = F.contains(text, F.lit("'")), F.contains(text, F.lit('"'))
    return (
        F.when(has_single & ~has_double, F.concat(F.lit('"'), plain, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def tagged_line(tagged: DataFrame) -> DataFrame:
    """``line``: the tagged tokens of each sentence as a list of pairs."""
    pairs = F.zip_with(
        "tokens", "tags", lambda w, t: F.concat(F.lit("("), _quoted(w), F.lit(", "), _quoted(t), F.lit(")"))
    )
    return tagged.select(F.concat(F.lit("["), F.array_join(pairs, ", "), F.lit("]")).alias("line"))


def summary_report(
    english: DataFrame,
    arabic: DataFrame,
    english_model: DataFrame,
    arabic_model: DataFrame,
    english_sample: DataFrame,
    arabic_sample: DataFrame,
    pos_sample: DataFrame,
    stamp: str | None = None,
    note: str | None = None,
) -> DataFrame:
    """``(ord, line)`` of the run summary.

    Takes the corpora, one-row model summaries, one-row ``text`` samples and a one-row ``line`` POS
    sample. The time stamp is passed in, so the same input gives the same report.
    """
    spark = english.sparkSession
    s = C.SUMMARY

    def fixed(ord: int, *texts: str) -> DataFrame:
        return spark.createDataFrame([(ord + i, x) for i, x in enumerate(texts)], "ord int, line string")

    def filled(ord: int, form: str, frame: DataFrame, value: Column) -> DataFrame:
        return frame.select(F.lit(ord).alias("ord"), F.format_string(form, value).alias("line"))

    def model(ord: int, name: str, summary: DataFrame, sample: DataFrame) -> list[DataFrame]:
        shown = F.format_string("%.6f", "perplexity")
        return [
            fixed(ord, s[f"{name}_model"]),
            filled(ord + 1, s[f"{name}_vocabulary"], summary, F.col("vocabulary")),
            filled(ord + 2, s[f"{name}_perplexity"], summary, shown),
            filled(ord + 3, s[f"{name}_sample"], sample, F.col("text")),
            fixed(ord + 4, ""),
        ]

    count = F.count(F.lit(1)).alias("n")
    parts = [
        *([fixed(0, s["stamp"] % stamp, "")] if stamp else []),
        fixed(2, s["data"]),
        filled(3, s["english_articles"], english.agg(count), F.col("n")),
        filled(4, s["arabic_articles"], arabic.agg(count), F.col("n")),
        fixed(5, ""),
        *model(6, "english", english_model, english_sample),
        *model(11, "arabic", arabic_model, arabic_sample),
        fixed(16, s["pos"]),
        pos_sample.select(F.lit(17).alias("ord"), "line"),
        *([fixed(18, "", s["note"], note)] if note else []),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def analyse_corpus(
    english: DataFrame,
    arabic: DataFrame,
    english_gazetteer: DataFrame | None = None,
    arabic_gazetteer: DataFrame | None = None,
    english_seed: str = "the",
    arabic_seed: str = "العالم",
    output: str | None = None,
    stamp: str | None = None,
) -> dict[str, DataFrame]:
    """Everything the two corpora are asked for, as a dict of DataFrames; written below ``output`` if given.

    What feeds several results and is much smaller than the text (n-gram counts, entities, tag pair
    counts) is written once to the scratch folder. Sentences are not: splitting again costs less.
    """
    spark = english.sparkSession
    english_gazetteer = english_gazetteer or entities.gazetteer_table(spark, tables.ENGLISH_GAZETTEER)
    arabic_gazetteer = arabic_gazetteer or entities.gazetteer_table(spark, tables.ARABIC_GAZETTEER)

    english_sents = corpus.located_sentences(english)
    arabic_sents = corpus.sentences(arabic, T.split_arabic_sentences)
    english_counts, english_cut = english_grams(english)
    arabic_counts, arabic_cut = arabic_grams(arabic)
    english_counts, arabic_counts = written(english_counts), written(arabic_counts)

    def sample(grams: DataFrame, seed: str, steps: int) -> DataFrame:
        seeds = spark.createDataFrame([(0, seed)], "seed_id bigint, seed string")
        return generate.generate_sample(grams, seeds, steps)

    first = corpus.sentences(corpus.nth_article(english, 0)).where("sentence_index = 0")
    first_tagged = tagging.tagged_sentences(first)
    english_pos = tagging.pos_table(english_sents)
    arabic_pos = tagging.pos_table(
        corpus.sentences(arabic), tagging.ARABIC, "pos_tag"
    )
    first_arabic = tagging.pos_table(
        corpus.sentences(corpus.nth_article(arabic, 0)), tagging.ARABIC, "pos_tag"
    )
    english_entities = written(entities.extract_entities(english_sents, english_gazetteer))
    arabic_entities = written(entities.extract_entities_by_sentence(arabic_sents, arabic_gazetteer))
    english_model = bigrams.model_summary(english_counts, english_cut)
    arabic_model = bigrams.model_summary(arabic_counts, arabic_cut)
    tagged = tagging.tagged_sentences(english_sents)
    pairs = written(
        evaluate.confusion_counts(
            tagged.select(F.inline(evaluate.align_arrays(F.col("tags"), F.col("base_tags"))))
        )
    )
    arabic_tags = tagging.tagged_sentences(corpus.sentences(arabic), tagging.ARABIC)
    arabic_pairs = written(
        evaluate.confusion_counts(
            arabic_tags.select(F.inline(evaluate.align_arrays(F.col("tags"), F.col("base_tags"))))
        )
    )
    results = {
        "normalized_arabic": corpus.normalize_corpus(arabic),
        "english_model": english_model,
        "arabic_model": arabic_model,
        "EN_POS_ALL": english_pos.drop("token_index"),
        "AR_POS_ALL": arabic_pos.select("token", "pos_tag"),
        "EN_POS_sample": first_tagged.select(
            F.inline(F.arrays_zip(F.col("tokens").alias("token"), F.col("tags").alias("pos")))
        ),
        "AR_POS_sample": first_arabic.select("token", "pos_tag"),
        "EN_noun_phrases": tagging.noun_phrases(tagged),
        "EN_POS_confusion": evaluate.confusion_matrix(pairs),
        "EN_POS_scores": evaluate.prf1(pairs),
        "AR_POS_confusion": evaluate.confusion_matrix(arabic_pairs),
        "EN_NER_ALL": english_entities,
        "AR_NER_ALL": arabic_entities,
        "NER_EN_entity_type_counts": stats.entity_type_counts(english_entities),
        "NER_EN_top_entities": stats.top_values(english_entities, "text"),
        "NER_AR_entity_type_counts": stats.entity_type_counts(arabic_entities),
        "NER_AR_top_entities": stats.top_values(arabic_entities, "entity"),
        "summary": summary_report(
            english,
            arabic,
            english_model,
            arabic_model,
            sample(english_counts, english_seed, 5).select(F.col("generated").alias("text")),
            sample(arabic_counts, arabic_seed, 10),
            tagged_line(first_tagged),
            stamp,
            "Full Arabic POS is saved separately in AR_POS_ALL",
        ),
    }
    if output:
        for name, frame in results.items():
            if name == "summary":
                write_lines(frame, f"{output}/summary")
            elif name != "normalized_arabic":
                write_csv(frame, f"{output}/{name}", bom=name in ("AR_POS_ALL", "AR_POS_sample"))
            else:
                frame.write.parquet(f"{output}/{name}")
    return results
