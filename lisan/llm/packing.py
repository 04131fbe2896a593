"""Best-two-fit packing of token sequences."""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from re import compile as pattern

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, with_row_id, written

CAPACITY = 2048
SEPARATOR = 0
#: Entries of a worker's memory of words already encoded; beyond it words are encoded anew.
MEMORY = 300_000
#: Fixed value: marks that end a word of letters and begin a new token.
MARKS = ".,;:!?|*$&%#"
#: Text whose words are encoded together, and words in one call of the library.
CHUNK_BYTES, TOGETHER = 2_000_000, 1_000
#: All white space but the line feed, and some more, inside a class of Arrow's regular expressions.
_BLANKS = r"\x00-\x09\x0b-\x20\x7f-\x{a0}\p{Z}"
#: Rows that one sort within a length is meant for.
RANK_ROWS = 100_000


def _listed(values: pa.Array) -> list:
    return values.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Whole texts to token ids, each distinct word of some megabytes of text encoded once.

    A text is cut before every blank or line feed that a character other than white space follows, and a word of
    letters before the marks at its end. The tokenizer's own rules cut there too, so the ids of the pieces joined are
    the ids of the text. Texts with a special string of the vocabulary are encoded in one go. Arrow cuts the texts and
    numbers the words, numpy lays out their ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = pattern(r" (?=\S)|(?=\n\S)").split
        self.stems: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids that begin with a blank or line feed
        self.opens[[i for token, i in vocabulary.items() if token[0] in "\u0120\u010a"]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 4_096):
            found = self.tokenizer.encode_batch_fast(texts[at : at + 4_096], add_special_tokens=False)
            out += [array("I", x.ids).tobytes() for x in found]
        return out

    def _joined(self, words: list[str]) -> list[bytes]:
        """The ids of words that hold no blank or line feed but the one before them, many in one call."""
        out = []
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, "<u4")
            edges = [*(4 * np.flatnonzero(self.opens[ids])).tolist(), 4 * len(ids)]
            if len(edges) != len(some) + 1:
                out += self._ids(some)
                continue
            raw = ids.tobytes()
            out += [raw[i:j] for i, j in zip(edges, edges[1:])]
        return out

    def _stem_ids(self, stems: pa.Array) -> list[bytes]:
        apart = _listed(pc.match_substring_regex(stems, "(?s) |.\n"))
        stems, known = _listed(stems), self.stems
        new = [s for s, x in zip(stems, apart) if not x and s not in known]
        found = dict(zip(new, self._joined([s if s[0] == "\n" else " " + s for s in new])))
        alone = [s for s, x in zip(stems, apart) if x and s not in known]
        found.update(zip(alone, self._ids([s if s[0] == "\n" else " " + s for s in alone])))
        if len(known) + len(found) <= MEMORY:
            known.update(found)
        return [found[s] if s in found else known[s] for s in stems]

    def _word_ids(self, words: pa.Array) -> list[bytes]:
        """The ids of distinct words that a blank comes before, or that begin with their line feed."""
        stems = pc.ascii_rtrim(words, MARKS)
        letters = pc.ascii_is_alpha(pc.ascii_ltrim(stems, "\n"))
        marks = np.asarray(pc.binary_length(words)) - np.asarray(pc.binary_length(stems))
        letters = np.array(letters.to_numpy(zero_copy_only=False))
        foreign = ~letters & (marks > 0) & ~pc.string_is_ascii(stems).to_numpy(zero_copy_only=False)
        letters[foreign] = [s.removeprefix("\n").isalpha() for s in _listed(stems.filter(pa.array(foreign)))]
        marks[~letters] = 0
        stems = pc.if_else(pa.array(letters), stems, words).dictionary_encode()
        ids, marked = self._stem_ids(stems.dictionary), np.flatnonzero(marks)
        out = list(map(ids.__getitem__, _listed(stems.indices)))
        ends = [w[-k:] for w, k in zip(_listed(words.take(pa.array(marked))), marks[marked].tolist())]
        kinds = list(dict.fromkeys(ends))
        known = dict(zip(kinds, self._ids(kinds)))
        for i, end in zip(marked.tolist(), ends):
            out[i] += known[end]
        return out

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """(first pieces, the other pieces, how many others each text has)."""

        def parted(lists: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
            size = np.diff(lists.offsets.to_numpy())
            first = np.zeros(int(size.sum()), bool)
            first[np.cumsum(size) - size] = True
            pieces = lists.flatten()
            return pieces.filter(pa.array(first)), pieces.filter(pa.array(~first)), size - 1

        firsts, words, size = parted(pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " "))
        coded = words.dictionary_encode()
        # White space that has to stay together: these texts are cut by a pattern.
        odd = pc.match_substring_regex(coded.dictionary, rf"^(\n?$|\n?[{_BLANKS}]|\n\n)").to_numpy(zero_copy_only=False)
        if not odd.any():
            return firsts, coded, size
        text = np.repeat(np.arange(len(texts)), size)
        again = np.zeros(len(texts), bool)
        again[text[odd[coded.indices.to_numpy()]]] = True
        some = pa.array([self.cut(t) for t in _listed(texts.filter(pa.array(again)))], pa.list_(pa.string()))
        other_firsts, other_words, other_size = parted(some)
        order = np.argsort(np.concatenate([np.flatnonzero(~again), np.flatnonzero(again)]), kind="stable")
        firsts = pa.concat_arrays([firsts.filter(pa.array(~again)).cast(pa.string()), other_firsts]).take(pa.array(order))
        of_word = np.concatenate([text[~again[text]], np.repeat(np.flatnonzero(again), other_size)])
        words = pa.concat_arrays([words.filter(pa.array(~again[text])).cast(pa.string()), other_words])
        words = words.take(pa.array(np.argsort(of_word, kind="stable")))
        size = np.where(again, 0, size)
        size[again] = other_size
        return firsts, words.dictionary_encode(), size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, each with the separator at its end; where each text ends)."""
        texts = pc.fill_null(texts, "")
        whole = np.zeros(len(texts), bool)
        for s in self.special:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        units = [np.array([SEPARATOR], "<u4").tobytes(), *self._ids(_listed(texts.filter(pa.array(whole))))]
        firsts, words, size = self._cut(pc.if_else(pa.array(whole), "", texts))
        firsts = firsts.dictionary_encode()
        begin = np.asarray(firsts.indices).astype(np.int64) + len(units)
        begin[whole] = np.arange(1, len(units))
        units += self._ids(_listed(firsts.dictionary))
        others = np.asarray(words.indices).astype(np.int64) + len(units)
        units += self._word_ids(words.dictionary)
        # The units of each text: its first piece, its words, the separator.
        stop = np.cumsum(size + 2)
        order = np.zeros(int(stop[-1]) if len(stop) else 0, np.int64)
        middle = np.ones(len(order), bool)
        middle[stop - 1] = middle[stop - size - 2] = False
        order[stop - size - 2] = begin
        order[middle] = others
        length = np.fromiter(map(len, units), np.int64, len(units)) // 4
        start = np.cumsum(length) - length
        each = length[order]
        ends = np.cumsum(each)
        places = np.repeat(start[order] - (ends - each), each)
        places += np.arange(len(places))
        return np.frombuffer(b"".join(units), "<u4")[places], ends[stop - 1]


def chunks(batch: pa.RecordBatch, column: int, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``size`` bytes of text, or of one row that has more."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(batch):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut_pieces(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """(__row, doc_id, piece, start, length, ids_crc32[, ids]): the documents' ids, cut where longer than ``capacity``.

    Every document ends with the separator id. Of a long one all pieces but the first have ``capacity`` ids. Null
    text counts as empty, which leaves the separator.
    """
    rows = with_row_id(docs, doc_id, text).select(ROW, F.col(f"`{doc_id}`").alias("doc_id"), f"`{text}`")
    columns = [
        ROW, "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.lit(0).cast("long").alias("length"), F.lit(0).cast("long").alias("ids_crc32"),
    ]
    shape = rows.select(*columns, *([F.lit(b"").alias("ids")] if keep_ids else [])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 2):
                yield cut(part)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, piece, start, length, crc, ids = [], [], [], [], [], []
        flat, ends = encoder(vocabulary).encode(batch.column(2))
        view, ends = memoryview(flat).cast("B"), ends.tolist()
        for k, (at, to) in enumerate(zip([0, *ends], ends)):
            n, body = to - at, view[4 * at : 4 * to]
            for j in range(-(-n // capacity)):
                stop = n - (-(-n // capacity) - 1 - j) * capacity
                begin = max(0, stop - capacity)
                part = body[4 * begin : 4 * stop]
                doc.append(k), piece.append(j), start.append(begin), length.append(stop - begin)
                crc.append(zlib.crc32(part))
                if keep_ids:
                    ids.append(bytes(part))
        arrays = [
            batch.column(0).take(pa.array(doc, pa.int64())), batch.column(1).take(pa.array(doc, pa.int64())),
            pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
            pa.array(crc, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(
            arrays + ([pa.array(ids, pa.binary())] if keep_ids else []), names=shape.names
        )

    return rows.mapInArrow(run, shape)


def best_two_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """(times, lengths) of the sequences for ``counts[n]`` pieces of length n.

    A sequence is filled greedily with the longest piece that still fits. If a gap is left, its smallest piece is
    taken out again for the two unpacked pieces that fill the widened gap best. A sequence is repeated for as long
    as its lengths last, so the work depends on the number of lengths, not of pieces.
    """
    left, lengths, out = counts.astype(np.int64).copy(), np.arange(capacity + 1), []
    while left.any():
        free, gap, bin_ = left.copy(), capacity, []
        fits = np.maximum.accumulate(np.where(free > 0, lengths, 0))
        while gap and (n := int(fits[gap])):
            bin_.append(n)
            free[n] -= 1
            gap -= n
            if not free[n]:
                fits = np.maximum.accumulate(np.where(free > 0, lengths, 0))
        if gap and bin_:
            smallest = min(bin_)
            free[smallest] += 1
            fits = np.maximum.accumulate(np.where(free > 0, lengths, 0))
            room = gap + smallest
            a = lengths[1:room][free[1:room] > 0]
            b = fits[room - a]
            b = np.where((b == a) & (free[a] < 2), fits[np.maximum(a - 1, 0)], b)
            total = np.where(b > 0, a + b, 0)
            if len(a) and total.max() > smallest:
                k = int(np.argmax(total))
                bin_.remove(smallest)
                bin_ += [int(a[k]), int(b[k])]
        used = np.bincount(bin_, minlength=capacity + 1)
        times = int((left[used > 0] // used[used > 0]).min())
        left -= used * times
        out.append((times, sorted(bin_, reverse=True)))
    return out


def slots(plan: list[tuple[int, list[int]]]) -> tuple[np.ndarray, ...]:
    """Where the pieces of each length go, as runs sorted by (length, first rank): sequence and offset of each run."""
    rows, used, sequence = [], {}, 0
    for times, lengths in plan:
        offset = 0
        for n in lengths:
            rows.append((n, used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + times
            offset += n
        sequence += times
    rows.sort()
    return tuple(np.array(x, np.int64) for x in zip(*rows)) if rows else (np.empty(0, np.int64),) * 4


def pack(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """Every document's pieces and their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids].

    The plan needs only how many pieces there are of each length, at most ``capacity`` numbers, so it is made
    once, whatever the size of the corpus; the j-th piece of a length then takes the j-th place for it. Pieces are
    numbered within a length over salted buckets, so one very common length is no single task's work. Null and
    empty texts are one separator long; repeated rows are packed one by one; an empty table gives no rows.
    """
    pieces = written(cut_pieces(docs, vocabulary, doc_id, text, capacity, keep_ids))
    by_length = pieces.groupBy("length").count().collect()
    counts = np.zeros(capacity + 1, np.int64)
    for n, c in by_length:
        counts[n] = c
    length, first, sequence, offset = slots(best_two_fit(counts, capacity))
    salt = F.pmod(F.xxhash64(ROW, "piece"), F.lit(int(counts.sum()) // RANK_ROWS + 1))
    salted = pieces.withColumn("salt", salt)
    sizes = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    place = Window.partitionBy("length", "salt").orderBy(ROW, "piece")
    ranked = salted.withColumn("rank", F.row_number().over(place) - 1).join(sizes, ["length", "salt"])
    out = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    ranked = ranked.select(*out, (F.col("rank") + F.col("before")).cast("long").alias("rank"))
    shape = ranked.select(*out, F.col("rank").alias("sequence_id"), F.col("rank").alias("offset")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (length << 44) | first
        for batch in batches:
            rank = batch.column(len(out)).to_numpy()
            at = np.searchsorted(keys, (batch.column(3).to_numpy() << 44) | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(out)], pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])],
                names=shape.names,
            )

    return ranked.mapInArrow(run, shape)
