"""Token counts from distinct pre-tokens."""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, with_row_id

#: Rows of one file, and bytes of text, that are counted together.
BLOCK_ROWS, BLOCK_BYTES = 8_192, 32_000_000
#: A pre-token in more documents of a block than this is spread over SALTS tasks.
FREQUENT, SALTS = 256, 64
ENTRY = np.dtype([("doc", "<u2"), ("n", "<u2")])
SUM = np.dtype([("doc", "<u2"), ("n", "<i8")])


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def piece_counts(path: str, words: list[str]) -> np.ndarray:
    """How many tokens the library makes of each word, without begin, end or added special tokens."""
    found = _tokenizer(path).encode_batch_fast(words, add_special_tokens=False)
    return np.array([len(x) for x in found], np.int64)


def frequencies(rows: DataFrame, text: str = "text") -> DataFrame:
    """(word, f, base, salt, entries) of rows (__row, text): in which documents of a block a pre-token occurs.

    A pre-token is a run between ASCII white space. The block is at most BLOCK_ROWS neighbouring rows of a file
    from ``base`` on; ``entries`` packs (row - base, count) pairs.
    """
    rows = rows.select(f"{ROW}.f", f"{ROW}.r", f"`{text}`")

    def flush(f: int, base: int, ids: dict[bytes, int], found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not ids:
            return
        key, n = np.unique(np.concatenate(found), return_counts=True)
        times = -(-n // 65_535)
        key, n = np.repeat(key, times), np.repeat(n, times)
        n[:-1][key[:-1] == key[1:]] = 65_535
        last = np.append(key[:-1] != key[1:], True)
        n[last] -= 65_535 * (np.repeat(times, times)[last] - 1)
        entries = np.empty(len(key), ENTRY)
        entries["doc"], entries["n"] = key % BLOCK_ROWS, n
        ends = np.searchsorted(key, np.arange(1, len(ids) + 1) * BLOCK_ROWS)
        sizes = np.diff(ends, prepend=0)
        offsets = np.concatenate([[0], ends]).astype(np.int32) * ENTRY.itemsize
        size = len(ids)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(ids), pa.binary()),
                pa.array(np.full(size, f, np.int64)),
                pa.array(np.full(size, base, np.int64)),
                pa.array(np.where(sizes > FREQUENT, (base // BLOCK_ROWS + f) % SALTS, 0).astype(np.int32)),
                pa.BinaryArray.from_buffers(
                    pa.binary(), size, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(entries.tobytes())]
                ),
            ],
            names=["word", "f", "base", "salt", "entries"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = base = None
        ids, found, held = defaultdict(count().__next__), [], 0
        for batch in batches:
            for file, row, text in zip(*(c.to_pylist() for c in batch.columns)):
                if f != file or held >= BLOCK_BYTES or not 0 <= row - base < BLOCK_ROWS:
                    yield from flush(f, base, ids, found)
                    f, base, ids, found, held = file, row, defaultdict(count().__next__), [], 0
                if text:
                    body = text.encode()
                    words = body.split()
                    word = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
                    found.append(word * BLOCK_ROWS + (row - base))
                    held += len(body)
        yield from flush(f, base, ids, found)

    return rows.mapInArrow(run, "word binary, f long, base long, salt int, entries binary")


def _summed(batches: Iterator[pa.RecordBatch], column: int, kind: np.dtype, weights) -> Iterator[tuple]:
    """By (f, base): the rows' numbers, times a weight by input row, summed; emitted from time to time."""
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        if not len(batch):
            continue
        f, base = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        packed = batch.column(column)
        sizes = np.array([len(x) for x in packed.to_pylist()], np.int64) // kind.itemsize
        entries = np.frombuffer(b"".join(packed.to_pylist()), kind)
        blocks, at = np.unique(np.rec.fromarrays([f, base]), return_inverse=True)
        where = np.repeat(at, sizes) * BLOCK_ROWS + entries["doc"]
        amount = entries["n"] * np.repeat(weights(batch), sizes)
        sums = np.bincount(where, weights=amount, minlength=len(blocks) * BLOCK_ROWS).reshape(-1, BLOCK_ROWS)
        for block, row in zip(blocks.tolist(), sums):
            old = held.get(block)
            held[block] = row if old is None else old + row
        if len(held) > 1_000:
            yield from held.items()
            held = {}
    yield from held.items()


def token_sums(words: DataFrame, vocabulary: str) -> DataFrame:
    """(f, r, n_tokens) of the documents that have a word.

    The rows of a pre-token come together, sorted, so its pieces are counted once (once per salt if it is
    frequent) and multiplied into the frequencies of its documents; no token id is kept.
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: list = [None, 0]

        def pieces(batch: pa.RecordBatch) -> np.ndarray:
            word = batch.column(0).to_pylist()
            new = list({w for w in word if w != before[0]})
            found = dict(zip(new, piece_counts(vocabulary, [w.decode() for w in new]).tolist()))
            found[before[0]] = found.get(before[0], before[1])
            before[:] = [word[-1], found[word[-1]]]
            return np.array([found[w] for w in word], np.int64)

        for (f, base), sums in _summed(batches, 4, ENTRY, pieces):
            doc = np.flatnonzero(sums)
            out = np.empty(len(doc), SUM)
            out["doc"], out["n"] = doc, sums[doc]
            yield pa.RecordBatch.from_arrays(
                [pa.array([None], pa.binary()), pa.array([f]), pa.array([base]), pa.array([out.tobytes()])],
                names=["word", "f", "base", "sums"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (f, base), sums in _summed(batches, 3, SUM, lambda batch: np.ones(len(batch), np.int64)):
            doc = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(doc), f)), pa.array(base + doc), pa.array(sums[doc].astype(np.int64))],
                names=["f", "r", "n"],
            )

    dealt = words.repartition("word", "salt").sortWithinPartitions("word")
    parts = dealt.mapInArrow(multiply, "word binary, f long, base long, sums binary")
    rows = parts.repartition("f", "base").mapInArrow(add, "f long, r long, n long")
    return rows.groupBy("f", "r").agg(F.sum("n").alias("n_tokens"))


def token_counts(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", limit: int = 2048
) -> DataFrame:
    """The number of tokens of every whole text: __row, doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the vocabulary's own library; special strings inside texts are treated as it does by
    default. For vocabularies that drop white space; others are refused. Null counts as empty, with
    no bytes and no tokens; repeated rows are counted one by one; other columns are not read; an empty table gives
    no rows.
    """
    if piece_counts(vocabulary, [" \t\n"])[0]:
        raise ValueError("this vocabulary keeps white space; counts of words would not add up")
    base = with_row_id(docs, doc_id, text)
    rows = base.select(
        ROW,
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.octet_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long").alias("n_bytes"),
    )
    sums = token_sums(frequencies(base.select(ROW, f"`{text}`"), text), vocabulary)
    sums = sums.select(F.struct("f", "r").alias(ROW), "n_tokens")
    n = F.coalesce("n_tokens", F.lit(0)).cast("long")
    return rows.join(sums, ROW, "left").select(
        ROW, "doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit")
    )
