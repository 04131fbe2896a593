"""Stored models against fresh counts, and draws against their weights."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lisan.operators import generate, stored

TOKENS = "doc_id bigint, sentence_index int, tokens array<string>"


def rows(seed: int, n: int) -> list[tuple]:
    draw = random.Random(seed)
    return [(i, 0, draw.choices(["a", "b", "c", f"w{i}", "the", "the"], k=draw.randrange(0, 8))) for i in range(n)]


def plain(found: list[tuple]) -> Counter:
    return Counter(p for _, _, ts in found for p in zip(["<s>", *ts], [*ts, "</s>"]))


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "it's here")
    found = rows(1, 40)
    stored.save_model(stored.training_bigrams(spark.createDataFrame(found, TOKENS)), path, buckets=4)
    return found, path


def test_another_session_loads_it(spark, model):
    found, path = model
    again = stored.load_model(spark.newSession(), path)
    assert {(r.context, r.word): r.n for r in again.bigrams.collect()} == plain(found)
    totals = Counter()
    for (context, _), n in plain(found).items():
        totals[context] += n
    assert {r.context: r.n for r in again.contexts.collect()} == totals
    assert again.buckets == 4


def test_merged_counts_are_those_of_both(spark, model, tmp_path):
    found, path = model
    more = rows(2, 30)
    merged = stored.merge_model(stored.load_model(spark, path), stored.training_bigrams(spark.createDataFrame(more, TOKENS)), str(tmp_path / "m"))
    assert {(r.context, r.word): r.n for r in merged.bigrams.collect()} == plain(found + more)
    fresh = stored.save_model(stored.training_bigrams(spark.createDataFrame(found + more, TOKENS)), str(tmp_path / "f"))
    assert sorted(merged.contexts.collect()) == sorted(fresh.contexts.collect())


@pytest.mark.parametrize("boundaries", [True, False])
def test_scores_of_other_text(spark, model, boundaries):
    found, path = model
    other = rows(3, 20) + [(99, 0, ["new", "a", "new"]), (100, 0, [])]
    counts = plain(found)
    totals = Counter()
    for (context, _), n in counts.items():
        totals[context] += n
    vocabulary = {w for p in counts for w in p}
    asked = Counter()
    for _, _, ts in other:
        padded = ["<s>", *ts, "</s>"] if boundaries else ts
        asked.update(zip(padded, padded[1:]))
    got = stored.score_other(stored.load_model(spark, path), spark.createDataFrame(other, TOKENS), boundaries).collect()
    look = lambda w: w if w in vocabulary else "<UNK>"
    want = {
        (c, w): (look(c), look(w), m, counts[c, w], totals[c], (counts[c, w] + 1) / (totals[c] + len(vocabulary) + 1))
        for (c, w), m in asked.items()
    }
    assert {(r.context, r.word): (r.context_lookup, r.word_lookup, r.m, r.n, r.context_n, pytest.approx(r.score)) for r in got} == want


def test_the_model_is_not_shuffled(spark, model):
    """Each exchange of the joins is above the other text; the model's buckets are read as they lie."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loaded = stored.load_model(spark, model[1])
        scored = stored.score_other(loaded, spark.createDataFrame(rows(3, 20), TOKENS))
        lines = scored._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = lambda line: len(re.match(r"[\s:+\-*|]*", line).group())
    scans = [k for k, line in enumerate(lines) if "FileScan parquet" in line and "Bucketed: true" in line]
    assert len(scans) >= 3
    for k in scans[:3]:
        level = depth(lines[k])
        for line in reversed(lines[:k]):
            if depth(line) < level:
                level = depth(line)
                if "SortMergeJoin" in line:
                    break
                assert "Exchange" not in line


def test_empty_models(spark, tmp_path):
    none = spark.createDataFrame([], TOKENS)
    empty = stored.save_model(stored.training_bigrams(none), str(tmp_path / "e"), buckets=2)
    assert empty.bigrams.count() == 0 and empty.vocabulary_size().first().v == 1
    one = spark.createDataFrame([(1, 0, ["x", "y"])], TOKENS)
    got = stored.score_other(empty, one).collect()
    assert [(r.context_lookup, r.word_lookup, r.score) for r in got] == [("<UNK>", "<UNK>", 1.0)]
    assert stored.perplexity_other(empty, none).first().perplexity is None


GRAMS = "context string, word string, n bigint, m bigint"


def grams(followers: dict[str, dict[str, int]]) -> list[tuple]:
    return [(None, w, 1, 0) for w in followers] + [(c, w, n, 0) for c, ws in followers.items() for w, n in ws.items()]


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_draws_follow_the_weights(spark, monkeypatch, block):
    monkeypatch.setattr(generate, "BLOCK_WORDS", block)
    followers = {"the": {f"w{k}": k + 1 for k in range(10)}, "w3": {"</s>": 1}, **{f"w{k}": {"the": 2} for k in range(10) if k != 3}}
    table = generate.draw_table(spark.createDataFrame(grams(followers), GRAMS))
    n = 4_000
    seeds = spark.createDataFrame([(i, "the") for i in range(n)] + [(n, "nobody"), (n + 1, "</s>")], "seed_id bigint, seed string")
    got = generate.generate_drawn(table, seeds, 2).collect()
    assert len(got) == n + 2
    first = Counter(r.generated.split()[0] for r in got if r.seed_id < n)
    whole = sum(k + 2 for k in range(10))
    chi = sum((first[f"w{k}"] - n * (k + 2) / whole) ** 2 / (n * (k + 2) / whole) for k in range(10))
    assert chi < 30  # nine degrees of freedom: one in two thousand
    assert {r.generated.split()[1] for r in got if r.seed_id < n and not r.generated.startswith("w3 ")} == {"the"}
    words = set(followers) | {"</s>"}
    assert {w for r in got if r.seed_id >= n for w in r.generated.split()} <= words | {f"w{k}" for k in range(10)}
    cells = table.cells.where("context = 'the'").collect()
    assert sorted(w for c in cells for w in c.words) == sorted(followers["the"])


def test_draws_do_not_depend_on_the_other_seeds(spark, monkeypatch):
    followers = {"a": {"a": 1, "b": 5}, "b": {"a": 2, "</s>": 1}}
    table = generate.draw_table(spark.createDataFrame(grams(followers), GRAMS))
    many = spark.createDataFrame([(i, "a") for i in range(50)], "seed_id bigint, seed string")
    all_ = {r.seed_id: r.text for r in generate.generate_drawn(table, many, 4).collect()}
    monkeypatch.setattr(generate, "NAMED_CONTEXTS", 0)
    few = generate.generate_drawn(table, many.where("seed_id < 5"), 4).collect()
    assert all(all_[r.seed_id] == r.text for r in few) and len(few) == 5
    assert generate.generate_drawn(table, many.limit(0), 2).count() == 0


def test_first_above(spark):
    upto = [3, 4, 9, 10, 25]
    frame = spark.range(25).select("id", generate._first_above(F.array(*map(F.lit, upto)), F.col("id")).alias("k"))
    assert all(r.k == next(k for k, u in enumerate(upto) if u > r.id) for r in frame.collect())
