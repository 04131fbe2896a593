"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, held_out, slices, stable, with_row_id, written
from .exact_dedup import drop_rows

UNKNOWN = "und"
#: N-grams of 1 to LONGEST letters; the TOP most frequent make a profile.
LONGEST, TOP = 3, 400
#: N-grams that a task holds at most before it counts them, of all languages together, and those of one more text.
HELD = 1_000_000
#: Profiles are sent to every task; more languages than this are refused, not cut.
MOST_LANGUAGES = 10_000


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """By code point: 2 for a letter, 1 for a mark, else 0."""
    return np.array([{"L": 2, "M": 1}.get(category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def grams(text: str | None, longest: int = LONGEST) -> np.ndarray:
    """All letter n-grams of the whole lower-cased text as numbers; a word's begin and end count as a blank."""
    cp = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    kind = _kinds()[cp]
    if not (kind == 2).any():
        return np.empty(0, np.int64)
    cp = np.concatenate([[32], np.where(kind > 0, cp, 32), [32]])
    cp = cp[np.append(True, (cp[1:] != 32) | (cp[:-1] != 32))]
    out, key = [cp[cp != 32]], cp
    for n in range(2, longest + 1):
        key = (key[:-1] << 21) | cp[n - 1 :]
        inside = np.ones(len(key), bool)
        for k in range(1, n - 1):
            inside &= cp[k : k + len(key)] != 32
        out.append(key[inside])
    return np.concatenate(out)


def ranked(keys: np.ndarray, top: int = TOP) -> np.ndarray:
    """The ``top`` most frequent keys, most frequent first, ties by key."""
    found, counts = np.unique(keys, return_counts=True)
    return found[np.argsort(-counts, kind="stable")[:top]]


def gram_counts(batches: Iterator[pa.RecordBatch], held: int = HELD) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of rows (lang, text), counted in parts: whenever more than ``held`` n-grams wait, of all languages.

    What a task holds depends neither on the rows of a batch nor on the number of languages.
    """
    waiting: dict[str, list[np.ndarray]] = {}
    n = 0

    def counted() -> Iterator[pa.RecordBatch]:
        while waiting:
            lang, parts = waiting.popitem()
            keys, times = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(times.astype(np.int64))],
                names=["lang", "gram", "n"],
            )

    for batch in (part for whole in batches for part in slices(whole)):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = grams(text)
            if not len(found):
                continue
            waiting.setdefault(lang, []).append(found)
            n += len(found) + 16  # an array itself takes as much as 16 n-grams
            if n > held:
                yield from counted()
                n = 0
    yield from counted()


def train_profiles(docs: DataFrame, lang: str = "lang", text: str = "text", top: int = TOP) -> DataFrame:
    """(lang, gram, rank): each language's most frequent n-grams over the whole texts of all its documents."""
    rows = docs.where(F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")
    )

    counts = rows.mapInArrow(gram_counts, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < top).drop("n")


class Profiles:
    """The profiles as a matrix: the rank of each known n-gram by language, ``top`` where it has none."""

    def __init__(self, rows: list, top: int = TOP):
        self.langs = sorted({r["lang"] for r in rows})
        self.keys = np.array(sorted({r["gram"] for r in rows}), np.int64)
        self.ranks = np.full((len(self.langs), len(self.keys) + 1), -1, np.int32)
        row = {lang: i for i, lang in enumerate(self.langs)}
        for r in rows:
            self.ranks[row[r["lang"]], np.searchsorted(self.keys, r["gram"])] = r["rank"]
        self.top = top

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of the least out-of-place distance, ties by name, and 1 less its share of the greatest."""
        doc = ranked(grams(text), self.top)
        if not len(doc) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.keys, doc)
        at[self.keys[np.minimum(at, len(self.keys) - 1)] != doc] = len(self.keys)
        there = self.ranks[:, at]
        apart = np.where(there < 0, self.top, np.abs(there - np.arange(len(doc))))
        far = apart.sum(axis=1)
        best = int(np.argmin(far))
        return self.langs[best], 1.0 - float(far[best]) / (self.top * len(doc))


def load_profiles(profiles: DataFrame, top: int = TOP) -> Profiles:
    """The profiles for use in tasks. Their size is bounded: languages x ``top`` rows, and the languages are counted."""
    n = profiles.select("lang").distinct().count()
    if n > MOST_LANGUAGES:
        raise ValueError(f"{n} languages; at most {MOST_LANGUAGES} are supported")
    return Profiles(profiles.collect(), top)


def identify(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    top: int = TOP,
) -> DataFrame:
    """The language of every whole text: __row, doc_id, held_out, lang_pred, score.

    Profiles are learned from the documents that are not held out and have a language; all of them count. A
    prediction reads the text only. Texts that are null or have no letter, and all texts if nothing could be
    learned, get ``und`` with score 0. Ties go to the language first by code point. Repeated rows are scored one by
    one; other columns are not read; an empty table gives no rows.
    """
    training = docs.where(~held_out(F.col(f"`{doc_id}`")))
    profiles = load_profiles(train_profiles(training, lang, text, top), top)
    rows = with_row_id(docs, doc_id, text).select(
        ROW, F.col(f"`{doc_id}`").alias("doc_id"), held_out(F.col(f"`{doc_id}`")).alias("held_out"), f"`{text}`"
    )
    shape = rows.select(
        ROW, "doc_id", "held_out", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            found = [profiles.predict(t) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                ],
                names=shape.names,
            )

    return rows.mapInArrow(run, shape)


def keep_known(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents whose language could be told, with all their columns; only texts without letters go."""
    docs = stable(docs)
    found = written(identify(docs, doc_id, text, lang))
    return drop_rows(docs, found.where(F.col("lang_pred") == UNKNOWN))
