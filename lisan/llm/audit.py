"""How filters of documents interact, decided from a sparse document-term matrix."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import sha256
from itertools import count, permutations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

#: A shard of the matrix ends after so many rows or bytes of text; a longer document is a shard of its own.
SHARD_ROWS, SHARD_BYTES = 32_768, 8_000_000
#: Words of all shards that one bucket of the dictionary takes, on average; the number of buckets follows.
BUCKET_WORDS, LEAST_BUCKETS = 2_000_000, 64
#: The filters; bit k of a document's ``fails`` is the k-th.
FILTERS = "ABCDE"
#: The bytes that filters count.
UPPER, SPECIAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
#: Bytes that continue a code point.
INNER = bytes(range(0x80, 0xC0))

_I4 = np.dtype("<u4")


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned ints byte plane by byte plane: the high bytes of small numbers are runs of zeros, which compress."""
    return numbers.astype(_I4).view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(packed) -> np.ndarray:
    """The inverse of ``pack``."""
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(4, -1).T).view(_I4)[:, 0].astype(np.int64)


def local_shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(shard, docs, words, sizes, steps, counts): blocks of documents as rows over a dictionary of their own.

    ``docs`` describes the rows: doc_id, part, digest of the text, whether filters C and D remove it. ``sizes`` are
    the nonzero columns of each row; its columns, places in ``words``, ascend and are kept as ``steps`` from one to
    the next. A text is read once and only as bytes. Words are runs without ASCII white space.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body"),
    )
    about = T.StructType(
        [rows.schema["doc_id"], rows.schema["part"], T.StructField("digest", T.BinaryType()),
         T.StructField("c", T.BooleanType()), T.StructField("d", T.BooleanType())]
    )
    shape = T.StructType(
        [T.StructField("shard", T.LongType()), T.StructField("docs", T.ArrayType(about)),
         T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("sizes", T.BinaryType()),
         T.StructField("steps", T.BinaryType()), T.StructField("counts", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 32)
        ids: dict[bytes, int] = defaultdict(count().__next__)
        sizes, steps, counts, info, held = [], [], [], [], 0

        def shard() -> pa.RecordBatch:
            doc_ids, parts, digests, c, d = zip(*info)
            columns = [pa.array(doc_ids, kind), pa.array(parts, pa.string()), pa.array(digests, pa.binary())]
            listed = pa.StructArray.from_arrays([*columns, pa.array(c), pa.array(d)], names=about.names)
            packed = [pack(np.array(sizes)), pack(np.concatenate(steps)), pack(np.concatenate(counts))]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([next(number)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(info)], pa.int32()), listed),
                    pa.array([list(ids)], pa.list_(pa.binary())),
                    *(pa.array([p], pa.binary()) for p in packed),
                ],
                names=shape.names,
            )

        for batch in batches:
            kind = batch.schema.field(0).type
            for name, where, body in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2)):
                body = body.as_py()
                found = Counter(body.split())
                column = np.fromiter(map(ids.__getitem__, found), np.int32, len(found))
                order = np.argsort(column)
                sizes.append(len(found))
                steps.append(np.diff(column[order], prepend=0))
                counts.append(np.fromiter(found.values(), np.int32, len(found))[order])
                upper = len(body) - len(body.translate(None, UPPER))
                points = len(body) if body.isascii() else len(body.translate(None, INNER))
                info.append(
                    (name, where, sha256(body).digest(), 100 * upper > 10 * points,
                     any(s in body for s in SPECIAL))
                )
                held += len(body)
                if held >= SHARD_BYTES or len(info) >= SHARD_ROWS:
                    yield shard()
                    ids = defaultdict(count().__next__)
                    sizes, steps, counts, info, held = [], [], [], [], 0
        if info:
            yield shard()

    return rows.mapInArrow(run, shape)


def encoded(shards: DataFrame) -> DataFrame:
    """(shard, at, ids, new): the ids of the words of each shard, at their places in it, and the words first met there.

    The words of a shard are dealt by checksum to as many buckets as the corpus needs, a packed list each, so a
    frequent word comes once from a shard. A bucket's lists follow each other in one task, which holds the
    dictionary of that bucket. The n-th word of bucket b has id n * buckets + b.
    """
    total = shards.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_WORDS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words.values
                bucket = np.fromiter(map(crc32, words.to_pylist()), np.int64, len(words)) % buckets
                order = np.argsort(bucket, kind="stable")
                kinds, starts = np.unique(bucket[order], return_index=True)
                ends = pa.array(np.append(starts, len(order)).astype(np.int32))
                at = [pack(part) for part in np.split(order, starts[1:])] if len(kinds) else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(kinds), pa.int64()), pa.array(kinds.astype(np.int32)),
                        pa.array(at, pa.binary()), pa.ListArray.from_arrays(ends, words.take(pa.array(order)))
                        if len(kinds) else pa.array([], pa.list_(pa.binary())),
                    ],
                    names=["shard", "bucket", "at", "words"],
                )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known = None, {}
        for batch in batches:
            for k, (shard, bucket, at) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                if bucket != current:
                    current, known = bucket, defaultdict(count().__next__)
                before, words = len(known), batch.column(3)[k].values.to_pylist()
                place = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                new = [{"word": w, "id": p * buckets + bucket} for w, p in zip(words, place.tolist()) if p >= before]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int64()), pa.array([at], pa.binary()),
                        pa.array([(place * buckets + bucket).tobytes()], pa.binary()), pa.array([new], listed),
                    ],
                    names=["shard", "at", "ids", "new"],
                )

    listed = pa.list_(pa.struct([("word", pa.binary()), ("id", pa.int64())]))
    dealt = shards.select("shard", "words").mapInArrow(deal, "shard long, bucket int, at binary, words array<binary>")
    dealt = dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(encode, "shard long, at binary, ids binary, new array<struct<word: binary, id: long>>")


def document_term_matrix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """The dictionary (word, id) and the shards (shard, docs, ids, sizes, steps, counts) of the matrix.

    A shard holds some of the rows in compressed form, to be read by ``shard_rows``. Its ``ids`` are packed lists of
    the columns in the whole matrix that its own columns stand for. An empty table gives no shards.
    """
    shards = written(local_shards(docs, doc_id, text, part))
    words = written(encoded(shards))
    ids = words.groupBy("shard").agg(F.collect_list(F.struct("at", "ids")).alias("ids"))
    matrix = shards.drop("words").join(ids, "shard", "left")
    return words.select(F.explode("new").alias("x")).select("x.*"), matrix


def shard_rows(ids: list[dict], sizes, steps, counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indptr, columns, counts) of a shard: row k has counts[indptr[k]:indptr[k + 1]] in those columns of the matrix."""
    sizes, steps = unpack(sizes), unpack(steps)
    indptr = np.concatenate([[0], np.cumsum(sizes)])
    ascending = np.concatenate([[0], np.cumsum(steps)])
    local = ascending[1:] - np.repeat(ascending[indptr[:-1]], sizes)
    whole = np.zeros(sum(len(p["at"]) // 4 for p in ids), np.int64)
    for p in ids:
        whole[unpack(p["at"])] = np.frombuffer(p["ids"], np.int64)
    return indptr, whole[local], unpack(counts)


def row_sums(matrix: DataFrame) -> DataFrame:
    """(doc_id, part, digest, c, d, n_words, n_distinct) of every row: its sum and its count of nonzero columns."""
    about = matrix.schema["docs"].dataType.elementType
    shape = T.StructType([*about.fields, T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                ids, *packed = (batch.column(c)[k] for c in range(1, 5))
                indptr, columns, counts = shard_rows(ids.as_py() or [], *(p.as_py() for p in packed))
                assert len(columns) == len(counts) == indptr[-1]
                total = np.concatenate([[0], np.cumsum(counts)])
                sums = [pa.array(np.diff(total[indptr])), pa.array(np.diff(indptr))]
                yield pa.RecordBatch.from_arrays([*batch.column(0)[k].values.flatten(), *sums], names=shape.names)

    return matrix.select("docs", "ids", "sizes", "steps", "counts").mapInArrow(run, shape)


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(doc_id, part, fails, n): how many rows of a document fail which filters; bit k of ``fails`` is the k-th.

    A: under 100 words; B: distinct words under 80 % of the words; C: A-Z over 10 % of the code points; D: holds any
    of #$%&*|; E: the same text has a smaller doc_id (a row without doc_id neither fails E nor makes others fail).
    """
    sums = row_sums(document_term_matrix(docs, doc_id, text, part)[1])
    a, b = F.col("n_words") < 100, 100 * F.col("n_distinct") < 80 * F.col("n_words")
    bits = sum(F.when(c, 1 << k).otherwise(0) for k, c in enumerate([a, b, F.col("c"), F.col("d")]))
    rows = written(sums.groupBy("digest", "doc_id", "part", bits.alias("fails")).agg(F.count("*").alias("n")))
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL")
    named = rows.where("doc_id IS NOT NULL").join(first.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    copies = F.col("fails") + F.when(F.col("first"), 0).otherwise(1 << FILTERS.index("E"))
    return named.select("doc_id", "part", copies.alias("fails"), "n").unionByName(
        rows.where("doc_id IS NULL").select("doc_id", "part", "fails", "n")
    )


def filter_audit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """Each order of the filters, step by step, within each part: what a step removes and what that costs.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley (the
    removals of the step's filter over all orders). A null part is the empty string. A document with several labels
    is good (quality 1) or toxic (toxic 1) if any of them says so; without a label, or without doc_id, neither.
    Null texts are empty, repeated rows count one by one, other columns are not read, an empty table gives no rows.
    """
    spark = docs.sparkSession
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    rows = failures(docs, doc_id, text, part)
    known = rows.where("doc_id IS NOT NULL").join(marks, "doc_id", "left").select("part", "fails", "n", "good", "toxic")
    rows = known.unionByName(
        rows.where("doc_id IS NULL").select("part", "fails", "n", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    )
    kinds = rows.groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n"))  # at most 128 rows a part
    size = len(FILTERS)
    # every (own filter, filters before it); the rest of an order does not change what the step does
    pairs = [(1 << f, b) for f in range(size) for b in range(1 << size) if not b >> f & 1]
    pair = F.explode(F.array(*[F.struct(F.lit(f).alias("own"), F.lit(b).alias("before")) for f, b in pairs]))
    cases = kinds.withColumn("case", pair).select("part", "fails", "good", "toxic", "n", "case.*")
    own = F.col("fails").bitwiseAND(F.col("own")) != 0
    gone = F.col("fails").bitwiseAND(F.col("before")) != 0

    def total(which):
        return F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0)).cast("long")

    steps = cases.groupBy("part", "own", "before").agg(
        total(~own & ~gone).alias("kept"),
        total(own & ~gone).alias("removed"),
        total(own & gone).alias("redundant"),
        total(F.col("fails") == F.col("own")).alias("unique_fails"),
        total(own & ~gone & F.col("good")).alias("good_lost"),
        total(own & ~gone & F.col("toxic")).alias("toxic_lost"),
    )
    plan = [
        ("".join(order), at + 1, 1 << FILTERS.index(order[at]), sum(1 << FILTERS.index(f) for f in order[:at]))
        for order in permutations(FILTERS)
        for at in range(size)
    ]
    plan = spark.createDataFrame(plan, "filter_order string, step int, own int, before int")
    out = steps.join(F.broadcast(plan), ["own", "before"])
    shapley = F.sum("removed").over(Window.partitionBy("part", "own"))
    return out.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        shapley.alias("shapley"),
    )
