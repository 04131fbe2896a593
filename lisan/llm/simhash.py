"""Near duplicates by SimHash with a generalised pigeonhole search."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, components, forest, slices, stable, with_row_id, written
from .exact_dedup import drop_rows

BITS = 64
#: Fingerprints drawn by hash to estimate candidate counts. The estimate steers the plan, never the result.
PLAN_SAMPLE = 2_000
#: Index rows of one bucket that one task compares; larger buckets are cut.
BUCKET = 8_192


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of one text over its word shingles, repeats included; 0 without a word."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 1 << 16):
        spans = zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist())
        hashes = np.array([digest(joined[s:e], seed) for s, e in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, seed: int = 42
) -> DataFrame:
    """(__row, doc_id, fp) of every document: XXH64 shingle hashes, a bit set if over half of them have it."""
    rows = with_row_id(docs, doc_id, text).select(ROW, F.col(f"`{doc_id}`").alias("doc_id"), f"`{text}`")
    shape = rows.select(ROW, "doc_id", F.lit(0).cast("long").alias("fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            found = np.array([fingerprint(t, shingle, seed) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=[ROW, "doc_id", "fp"]
            )

    return rows.mapInArrow(run, shape.schema)


def bit_counts(fps: DataFrame) -> np.ndarray:
    """How often two bits are set together, over all fingerprints: 64 x 64 sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            x = batch.column(0).to_numpy().astype(">i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(x, axis=1)[:, ::-1].astype(np.float32)
            total += bits.T @ bits
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "c"])

    rows = fps.select("fp").mapInArrow(run, "i long, j long, c double").groupBy("i", "j").agg(F.sum("c").alias("c"))
    out = np.zeros((BITS, BITS))
    for i, j, c in rows.collect():
        out[i, j] = c
    return out


def correlated_parts(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Deal the bits into ``m`` parts of nearly equal width; each part takes the bits most correlated with it."""
    p = np.diag(together) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, parts = set(range(BITS)), []
    for k in range(m):
        width = len(free) // (m - k)
        left = sorted(free)
        part = [left[int(np.argmax(corr[np.ix_(left, left)].sum(axis=1)))]]
        free.discard(part[0])
        while len(part) < width:
            left = sorted(free)
            part.append(left[int(np.argmax(corr[np.ix_(left, part)].mean(axis=1)))])
            free.discard(part[-1])
        parts.append(sorted(part))
    return parts


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds by part, summing to ``total``, of the least cost; ``costs[i]`` holds part i's cost by threshold."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (c, chosen) in best.items():
            for e, x in cost.items():
                if spent + e not in step or c + x < step[spent + e][0]:
                    step[spent + e] = (c + x, [*chosen, e])
        best = step
    return best.get(total, (float("inf"), []))


def plan_search(sample: np.ndarray, together: np.ndarray, n: int, distance: int) -> tuple[list[list[int]], list[int]]:
    """Parts of the bits and their thresholds.

    If two fingerprints differ in at most ``distance`` bits, then in some part i they differ in at most e_i bits,
    as long as the e_i sum to ``distance - m + 1`` (a threshold of -1 leaves the part out). For every number of
    parts the thresholds come from dynamic programming over the estimated work: signatures to write plus
    candidate pairs to verify. Any plan finds all pairs.
    """
    plans = []
    a, b = np.triu_indices(len(sample), 1)
    apart = sample[a] ^ sample[b]
    for m in range(2, distance + 2):
        parts, costs = correlated_parts(together, n, m), []
        for part in parts:
            mask = np.uint64(sum(1 << x for x in part))
            far = np.bitwise_count(apart & mask)
            cost, signatures = {-1: 0.0}, 0
            for e in range(0, min(3, distance - m + 2) + 1):
                signatures += comb(len(part), e)
                if signatures > 4_000:
                    break
                share = max(float((far <= e).mean()) if len(far) else 0.0, signatures / 2.0 ** len(part))
                cost[e] = 50.0 * n * (signatures + (e > 0)) + 0.5 * share * n * n
            costs.append(cost)
        plans.append((*allocate(costs, distance - m + 1), parts))
    cost, thresholds, parts = min(plans, key=lambda x: x[0])
    return parts, thresholds


def part_value(fp: Column, part: list[int]) -> Column:
    """The bits of ``part`` as one number."""
    out = F.lit(0).cast("long")
    for k, bit in enumerate(part):
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, bit).bitwiseAND(F.lit(1).cast("long")), k))
    return out


def signatures(fps: DataFrame, parts: list[list[int]], thresholds: list[int]) -> DataFrame:
    """(part, value, probe, fp): each fingerprint under its own values and, where e > 0, under all within e."""
    rows = None
    for i, (part, e) in enumerate(zip(parts, thresholds)):
        if e < 0:
            continue
        value = part_value(F.col("fp"), part)
        flips = [sum(1 << k for k in ks) for r in range(e + 1) for ks in combinations(range(len(part)), r)]
        new = fps.select(F.lit(i).alias("part"), value.alias("value"), F.lit(False).alias("probe"), "fp")
        if e > 0:
            masks = F.array(*[F.lit(x).cast("long") for x in flips])
            probes = fps.select("fp", value.alias("own"), F.explode(masks).alias("flip"))
            new = new.unionByName(
                probes.select(
                    F.lit(i).alias("part"),
                    F.col("own").bitwiseXOR(F.col("flip")).alias("value"),
                    F.lit(True).alias("probe"),
                    "fp",
                )
            )
        rows = new if rows is None else rows.unionByName(new)
    return rows


def cut_buckets(rows: DataFrame, loose: list[int], bucket: int = BUCKET) -> DataFrame:
    """Adds ``cell``: buckets of more than ``bucket`` index rows are cut into cells of about that many.

    An index row lies in one cell; a row that looks for partners goes to all cells of its bucket, and in parts
    whose threshold is 0 an index row looks in the cells after its own. Every pair still meets, in one cell.
    """
    large = (
        rows.where(~F.col("probe"))
        .groupBy("part", "value")
        .count()
        .where(F.col("count") > bucket)
        .select("part", "value", F.ceil(F.col("count") / bucket).cast("int").alias("cells"))
    )
    rows = rows.join(large, ["part", "value"], "left")
    one = F.coalesce("cells", F.lit(1))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), one).cast("int")
    probes = F.col("part").isin(loose)
    cells = F.when(F.col("probe"), F.sequence(F.lit(0), one - 1)).when(probes, F.array(own)).otherwise(
        F.sequence(own, one - 1)
    )
    return rows.withColumn("own", own).withColumn("cell", F.explode(cells)).select(
        "part", "value", "cell", (F.col("probe") | (F.col("cell") != F.col("own"))).alias("probe"), "fp"
    )


def links_within(key: np.ndarray, probe: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of equal ``key`` (sorted) of which one at least is an index row, folded to a forest."""
    ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
    last = np.repeat(ends, np.diff(ends, prepend=0))
    at = np.flatnonzero(last - np.arange(len(key)) > 1)
    a, b, held, k = [], [], 0, 1
    while len(at):
        near = (np.bitwise_count(fp[at] ^ fp[at + k]) <= distance) & ~(probe[at] & probe[at + k])
        hit = at[near]
        if len(hit):
            a.append(fp[hit])
            b.append(fp[hit + k])
            held += len(hit)
            if held > 1_000_000:
                x, y = forest(np.concatenate(a), np.concatenate(b))
                a, b, held = [x], [y], len(x)
        k += 1
        at = at[last[at] - at > k]
    if not a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return forest(np.concatenate(a), np.concatenate(b))


def near_links(fps: DataFrame, distance: int = 4, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints with at most ``distance`` differing bits.

    What is connected is exact. Of a cell's links only as many are returned as keep it connected, so a group of
    copies gives no quadratic number of rows. ``fps`` must be distinct and is read several times.
    """
    n = fps.count()
    drawn = [r[0] for r in fps.orderBy(F.xxhash64("fp", F.lit(11)), "fp").limit(PLAN_SAMPLE).collect()]
    parts, thresholds = plan_search(np.array(drawn, np.int64).view(np.uint64), bit_counts(fps), n, distance)
    loose = [i for i, e in enumerate(thresholds) if e > 0]
    rows = cut_buckets(signatures(fps, parts, thresholds), loose, bucket)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def out(x: list[np.ndarray]) -> pa.RecordBatch:
            change = np.zeros(len(x[0]), bool)
            change[1:] = (x[0][1:] != x[0][:-1]) | (x[1][1:] != x[1][:-1]) | (x[2][1:] != x[2][:-1])
            a, b = links_within(np.cumsum(change), x[3], x[4], distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            new[4] = new[4].view(np.uint64)
            if not len(new[0]):
                continue
            x = new if rest is None else [np.concatenate(p) for p in zip(rest, new)]
            same = (x[0] == x[0][-1]) & (x[1] == x[1][-1]) & (x[2] == x[2][-1])
            cut = int(np.argmax(same))
            rest = [c[cut:] for c in x]
            if cut:
                yield out([c[:cut] for c in x])
        if rest is not None:
            yield out(rest)

    dealt = rows.repartition("part", "value", "cell").sortWithinPartitions("part", "value", "cell")
    return dealt.mapInArrow(run, "a long, b long")


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4
) -> DataFrame:
    """The group of near copies of every document: __row, doc_id, fingerprint, component_id, kept.

    Fingerprints with at most ``distance`` differing bits link; component_id is the smallest doc_id that links
    lead to, the document's own included (null doc_ids are passed over, and a group of only such has null).
    Null and empty texts have fingerprint zero, linked like any other. Exactly one row of a group is kept, that of
    the smallest doc_id. Copies meet once, as one fingerprint. Other columns are not read.
    """
    rows = written(fingerprints(docs, doc_id, text, shingle))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", ROW))
    fps = written(rows.groupBy("fp").agg(best.alias("best")))
    roots = written(components(near_links(fps.select("fp"), distance)))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "best", F.coalesce("root", "fp").alias("root")
    )
    groups = named.groupBy("root").agg(F.min("best").alias("first"))
    by_fp = written(named.join(groups, "root").select("fp", "first"))
    return rows.join(by_fp, "fp").select(
        ROW,
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        (F.col(ROW) == F.col(f"first.{ROW}")).alias("kept"),
    )


def drop_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near copies, with all its columns."""
    docs = stable(docs)
    return drop_rows(docs, near_groups(docs, doc_id, text).where("NOT kept"))
