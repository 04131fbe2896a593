"""Exact top-k search by integer inner product: ball trees per shard, branch and bound."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

TOP, SCALE = 5, 256
#: A shard holds at most so many vectors and bytes, a leaf of its tree so many vectors, a block so many queries.
SHARD_ROWS, SHARD_BYTES, LEAF, BLOCK = 8_192, 8_000_000, 64, 1_024
#: Shards form around pivots drawn from a bounded sample; each vector is then assigned, and large ones are cut.
PIVOT_SAMPLE, PIVOTS = 4_096, 256
#: How many shards a block of queries visits between two exchanges of the k-th scores; then all that are left.
WAVES = (1, 16, None)
#: Blocks that one task compares with a shard, and shards whose bounds are read together.
VISITS, PACK = 16, 256
#: Scaled components beyond this, and scores beyond a long, saturate.
MOST, LONGEST = 2.0**52, 2**63 - 1
#: Stands in for a missing vec_id, which comes last among equal scores; such rows have a negative ``rid``.
LAST = np.iinfo(np.int64).max


def scaled(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(rid, vec_id, dim, x, key): floor(256 * component) as packed doubles, a name for the row, a digest of x.

    Vectors that are null, empty or hold a null or non-finite component are left out. ``rid`` is -1 - rid and
    ``vec_id`` the largest long where the vec_id is null.
    """
    base = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            flat = lists.values
            values = np.asarray(flat.to_numpy(zero_copy_only=False), float)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])  # a null is read as no number
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.clip(np.floor(SCALE * values), -MOST, MOST) + 0.0
            start, stop = ends[:-1], ends[1:]
            keep = lists.is_valid().to_numpy(zero_copy_only=False) & (stop > start) & (bad[stop] == bad[start])
            at = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    pa.array((stop - start)[at].astype(np.int32)),
                    pa.array([values[start[k] : stop[k]].tobytes() for k in at], pa.binary()),
                ],
                names=["vec_id", "dim", "x"],
            )

    named = base.mapInArrow(run, "vec_id long, dim int, x binary").withColumn("rid", F.monotonically_increasing_id())
    rid = F.when(F.col("vec_id").isNull(), -1 - F.col("rid")).otherwise(F.col("rid"))
    return named.select(
        rid.alias("rid"), F.coalesce("vec_id", F.lit(int(LAST))).alias("vec_id"), "dim", "x",
        F.unhex(F.sha2("x", 256)).alias("key"),
    )


def _matrix(packed) -> np.ndarray:
    packed = list(packed)
    return np.frombuffer(b"".join(packed)).reshape(len(packed), -1)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of q and x, which hold whole numbers; they saturate at a long."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < 2.0**53:
        return (q @ x.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(q) @ whole(x).T
    return np.clip(exact, -LONGEST, LONGEST).astype(np.int64)


class BallTree:
    """Nested balls over the rows of x: each node halves its points along the line between two far ones.

    ``x`` is reordered by ``order`` so that a node's points are a range. ``least`` is the smallest id in a node.
    """

    FIELDS = ("start", "stop", "left", "centre", "radius", "least")

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(x))
        nodes = [(0, len(x))]
        self.left, centre, radius = [], [], []
        for node, (start, stop) in enumerate(nodes):  # grows while it is read
            own = x[self.order[start:stop]]
            c = own.mean(axis=0)
            apart = np.sqrt(((own - c) ** 2).sum(axis=1))
            centre.append(c), radius.append(apart.max())
            self.left.append(-1)
            if stop - start > leaf and radius[-1] > 0:
                a = own[apart.argmax()]
                b = own[((own - a) ** 2).sum(axis=1).argmax()]
                middle = (stop - start) // 2
                halves = np.argpartition(own @ (b - a), middle)
                self.order[start:stop] = self.order[start:stop][halves]
                self.left[node] = len(nodes)
                nodes += [(start, start + middle), (start + middle, stop)]
        self.x, self.ids = x[self.order], ids[self.order]
        self.start, self.stop = np.array(nodes).T
        self.left, self.centre, self.radius = np.array(self.left), np.array(centre), np.array(radius)
        self.least = np.array([self.ids[a:b].min() for a, b in nodes])

    def pack(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(getattr(self, name)).tobytes() for name in ("x", "ids", *self.FIELDS)}

    @classmethod
    def unpack(cls, row, dim: int) -> BallTree:
        tree = cls.__new__(cls)
        for name in ("x", "ids", *cls.FIELDS):
            kind = float if name in ("x", "centre", "radius") else np.int64
            setattr(tree, name, np.frombuffer(row[name], kind))
        tree.x, tree.centre = tree.x.reshape(-1, dim), tree.centre.reshape(-1, dim)
        return tree


def upper_bounds(q: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """What no inner product of a row of q with a point of a ball exceeds; rounding included."""
    size = np.sqrt((q * q).sum(axis=1))
    reach = size[:, None] * (np.sqrt((centre * centre).sum(axis=1)) + radius)[None, :]
    return np.floor(q @ centre.T + size[:, None] * radius[None, :] + 1e-9 * reach + 1e-6)


def _open(bound: np.ndarray, least: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> np.ndarray:
    """Whether a node may hold a better row than the k-th found so far: a higher score, or its tie's smaller id."""
    return (bound > score) | ((bound == score) & (least < vec_id))


def search(tree: BallTree, rids: np.ndarray, q: np.ndarray, kth: np.ndarray, kth_id: np.ndarray, k: int):
    """The best k rows of a shard for each row of q as (scores, ids, rids), worse than the k-th so far left out.

    Nodes are opened by the best bound any query has on them, for the queries that still need them; what a leaf
    gives raises the k-th score for all later nodes. Empty places have rid ``LAST``.
    """
    m = len(q)
    scores, ids, names = np.full((m, k), -LONGEST - 1), np.full((m, k), LAST), np.full((m, k), LAST)
    kth, kth_id = kth.copy(), kth_id.copy()

    def push(node: int, rows: np.ndarray) -> None:
        bound = upper_bounds(q[rows], tree.centre[node : node + 1], tree.radius[node : node + 1])[:, 0]
        still = _open(bound, tree.least[node], kth[rows], kth_id[rows])
        if still.any():
            heappush(heap, (-bound[still].max(), node, rows[still], bound[still]))

    heap: list = []
    push(0, np.arange(m))
    while heap:
        _, node, rows, bound = heappop(heap)
        rows = rows[_open(bound, tree.least[node], kth[rows], kth_id[rows])]
        if not len(rows):
            continue
        if tree.left[node] >= 0:
            push(tree.left[node], rows)
            push(tree.left[node] + 1, rows)
            continue
        for a in range(tree.start[node], tree.stop[node], 4 * LEAF):
            part = slice(a, min(a + 4 * LEAF, tree.stop[node]))
            new = products(q[rows], tree.x[part])
            all_scores = np.concatenate([scores[rows], new], axis=1)
            all_ids = np.concatenate([ids[rows], np.broadcast_to(tree.ids[part], new.shape)], axis=1)
            all_names = np.concatenate([names[rows], np.broadcast_to(rids[part], new.shape)], axis=1)
            first = _ranked(all_scores, all_ids)[:, :k]
            scores[rows] = np.take_along_axis(all_scores, first, 1)
            ids[rows] = np.take_along_axis(all_ids, first, 1)
            names[rows] = np.take_along_axis(all_names, first, 1)
            better = (scores[rows, -1] > kth[rows]) | ((scores[rows, -1] == kth[rows]) & (ids[rows, -1] < kth_id[rows]))
            full = rows[better & (names[rows, -1] != LAST)]
            kth[full], kth_id[full] = scores[full, -1], ids[full, -1]
    return scores, ids, names


def _ranked(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places by falling score, then rising id, in each row."""
    return np.lexsort((ids, ~scores), axis=1)


def _pivots(vectors: DataFrame) -> dict[int, np.ndarray]:
    """By dimension as many vectors as it has shards, at most PIVOTS, far apart within a bounded sample."""
    sizes = {r["dim"]: r["count"] for r in vectors.groupBy("dim").count().collect()}
    rows = max(1, min(PIVOT_SAMPLE, (1 << 24) // (8 * max([1, *sizes]))))
    drawn = vectors.orderBy("key", "rid").select("dim", "x").limit(rows).collect()
    out = {}
    for dim, n in sizes.items():
        x = _matrix([r["x"] for r in drawn if r["dim"] == dim] or [np.zeros(dim).tobytes()])
        most = min(PIVOTS, len(x), -(-n // shard_rows(dim)))
        chosen, far = [0], ((x - x[0]) ** 2).sum(axis=1)
        while len(chosen) < most and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        out[dim] = x[chosen]
    return out


def shard_rows(dim: int) -> int:
    """Vectors of a shard."""
    return max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * dim)))


def assign(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``vectors`` with the place of their nearest pivot."""
    names = [c for c in vectors.columns if c not in ("dim", "x")]
    vectors = vectors.select("dim", "x", *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(0).to_numpy()
            pivot = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims).tolist():
                at, p = np.flatnonzero(dims == dim), pivots[dim]
                x = _matrix(batch.column(1).take(pa.array(at)).to_pylist())
                pivot[at] = ((p * p).sum(axis=1)[None, :] - 2 * (x @ p.T)).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot)], names=[*batch.schema.names, "pivot"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(run, f"{shape}, pivot int")


def _cut(placed: DataFrame, rows, name: str) -> DataFrame:
    """``placed`` with its part of its pivot's vectors: cut by digest so that a part holds about ``rows``."""
    sizes = placed.groupBy("dim", "pivot").agg(F.ceil(F.count("*") / rows).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("key", "rid"), F.col("parts"))
    return placed.join(F.broadcast(sizes), ["dim", "pivot"]).withColumn(name, F.struct("pivot", part.alias("part"))).drop("parts", "pivot")


def build_trees(placed: DataFrame) -> DataFrame:
    """(dim, shard, centre, radius, least, tree, rids): one ball tree per shard of (rid, vec_id, dim, x, key, pivot)."""
    rows = F.greatest(F.lit(1), F.least(F.lit(SHARD_ROWS), F.floor(F.lit(SHARD_BYTES / 8) / F.first("dim")))) * 0.8
    dealt = _cut(placed, rows, "shard")
    packed = ("x", "ids", *BallTree.FIELDS)
    shape = "dim int, pivot int, part long, centre0 binary, radius0 double, least0 long, rids binary, " + ", ".join(
        f"{c} binary" for c in packed
    )

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["vec_id", "rid"])
        tree = BallTree(_matrix(pdf["x"]), pdf["vec_id"].to_numpy())
        one = {
            "dim": pdf["dim"].iloc[0], "pivot": pdf["pivot"].iloc[0], "part": pdf["part"].iloc[0],
            "centre0": tree.centre[0].tobytes(), "radius0": tree.radius[0], "least0": tree.least[0],
            "rids": pdf["rid"].to_numpy()[tree.order].tobytes(),
        }
        return pd.DataFrame([{**one, **tree.pack()}])

    flat = dealt.select("dim", "shard.pivot", "shard.part", "vec_id", "rid", "x")
    trees = flat.groupBy("dim", "pivot", "part").applyInPandas(build, shape)
    return trees.select(
        "dim", F.struct("pivot", "part").alias("shard"), F.col("centre0").alias("centre"), F.col("radius0").alias("radius"),
        F.col("least0").alias("least"), F.struct(*packed).alias("tree"), "rids",
    )


def _blocks(queries: DataFrame, top: DataFrame | None, k: int) -> DataFrame:
    """(dim, block, queries): the queries of each block with the k-th row found so far, of at most about BLOCK."""
    kth = F.lit(int(-LONGEST - 1)).alias("score"), F.lit(int(LAST)).alias("vec_id")
    if top is None:
        known = queries.select("dim", "block", "key", "x", *kth)
    else:
        last = top.where(F.col("place") == k).select("key", "score", "vec_id")
        known = queries.join(last, "key", "left").select(
            "dim", "block", "key", "x", F.coalesce("score", kth[0]).alias("score"), F.coalesce("vec_id", kth[1]).alias("vec_id")
        )
    return known.groupBy("dim", "block").agg(F.collect_list(F.struct("key", "x", "score", "vec_id")).alias("queries"))


def _visits(blocks: DataFrame, packs: DataFrame, most: int) -> DataFrame:
    """(dim, block, shard, bound): shards that may still better a query of a block, with its highest bound there."""
    shape = "dim int, block struct<pivot: int, part: long>, shard struct<pivot: int, part: long>, bound double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(at, 1).to_pylist()[0] for at in range(len(batch))):
                q = _matrix(r["x"] for r in row["queries"])
                score, ids = (np.array([r[c] for r in row["queries"]], np.int64) for c in ("score", "vec_id"))
                bound = upper_bounds(
                    q, _matrix(s["centre"] for s in row["shards"]), np.array([s["radius"] for s in row["shards"]])
                )
                least = np.array([s["least"] for s in row["shards"]])
                open_ = _open(bound, least[None, :], score[:, None], ids[:, None])
                at = np.flatnonzero(open_.any(axis=0))
                best = np.where(open_, bound, -np.inf).max(axis=0)[at] if len(at) else np.zeros(0)
                yield pa.RecordBatch.from_pylist(
                    [
                        {"dim": row["dim"], "block": row["block"], "shard": row["shards"][j]["shard"], "bound": b}
                        for j, b in zip(at.tolist(), best.tolist())
                    ],
                    schema=VISIT,
                )

    number = F.explode(F.sequence(F.lit(0), F.lit(most)))
    spread = blocks.withColumn("pack", number).join(packs, ["dim", "pack"])
    return spread.select("dim", "block", "queries", "shards").repartition("dim", "block").mapInArrow(run, shape)


PLACE = pa.struct([("pivot", pa.int32()), ("part", pa.int64())])
VISIT = pa.schema([("dim", pa.int32()), ("block", PLACE), ("shard", PLACE), ("bound", pa.float64())])


def _compare(visits: DataFrame, blocks: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """(key, score, vec_id, rid): rows of the visited shards that better a query's k-th row."""
    turn = F.row_number().over(Window.partitionBy("dim", "shard").orderBy("block"))
    dealt = visits.withColumn("slice", F.floor((turn - 1) / VISITS))
    left = dealt.join(blocks, ["dim", "block"]).select("dim", "shard", "slice", "queries")
    right = dealt.select("dim", "shard", "slice").distinct().join(trees, ["dim", "shard"])
    right = right.select(
        F.col("dim").alias("own_dim"), F.col("shard").alias("own_shard"), F.col("slice").alias("own_slice"), "tree.*", "rids"
    )

    def run(asked: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(shard):
            return pd.DataFrame({"key": [], "score": [], "vec_id": [], "rid": []})
        row = shard.iloc[0]
        tree, rids = BallTree.unpack(row, int(row["own_dim"])), np.frombuffer(row["rids"], np.int64)
        out = []
        for queries in asked["queries"]:
            q = _matrix(r["x"] for r in queries)
            score, ids = (np.array([r[c] for r in queries], np.int64) for c in ("score", "vec_id"))
            scores, found, names = search(tree, rids, q, score, ids, k)
            at, place = np.nonzero(names != LAST)
            out.append(
                pd.DataFrame(
                    {
                        "key": [queries[j]["key"] for j in at], "score": scores[at, place],
                        "vec_id": found[at, place], "rid": names[at, place],
                    }
                )
            )
        return pd.concat(out)

    both = left.groupBy("dim", "shard", "slice").cogroup(right.groupBy("own_dim", "own_shard", "own_slice"))
    return both.applyInPandas(run, "key binary, score long, vec_id long, rid long")


def top_k(
    rows: DataFrame, is_query, vec_id: str = "vec_id", embedding: str = "embedding", k: int = TOP
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its k highest inner products with all other rows.

    A component x counts as floor(256 * x). ``is_query`` is a condition on vec_id. Ties go to the smaller vec_id, a
    null one last. A row is never its own candidate, other rows with its id are; a query id that comes twice gets
    its list twice. Only vectors of the same length are compared. Vectors that are null, empty or hold a null or
    non-finite component take no part. Other columns are not read; an empty table gives no rows.

    Of equal vectors only the first k + 1 can be in any list, so only they are searched, and queries with the same
    vector are searched once. A query's list holds k + 1 rows until its own is taken out.
    """
    base = written(scaled(rows, vec_id, embedding))
    order = Window.partitionBy("key").orderBy("vec_id", "rid")
    some = base.withColumn("copy", F.row_number().over(order)).where(F.col("copy") <= k + 1).drop("copy")
    pivots = _pivots(base)
    trees = written(build_trees(written(assign(some, pivots))))
    asked = base.where(F.col("rid") >= 0).where(is_query)
    queries = asked.groupBy("key").agg(F.first("dim").alias("dim"), F.first("x").alias("x"), F.min("rid").alias("rid"))
    queries = written(_cut(assign(queries, pivots), F.lit(BLOCK * 0.8), "block").select("key", "dim", "x", "block"))
    number = F.row_number().over(Window.partitionBy("dim", F.pmod(F.xxhash64("shard"), F.lit(64))).orderBy("shard"))
    packs = trees.withColumn("pack", (F.floor((number - 1) / PACK) * 64 + F.pmod(F.xxhash64("shard"), F.lit(64))).cast("int"))
    packs = packs.groupBy("dim", "pack").agg(F.collect_list(F.struct("shard", "centre", "radius", "least")).alias("shards"))
    packs = written(packs)
    most = packs.agg(F.max("pack")).first()[0]
    top = seen = None
    for size in WAVES:
        if most is None:
            break
        blocks = written(_blocks(queries, top, k + 1))
        visits = _visits(blocks, packs, most)
        if seen is not None:
            visits = visits.join(seen, ["dim", "block", "shard"], "left_anti")
        if size is not None:
            turn = F.row_number().over(Window.partitionBy("dim", "block").orderBy(F.desc("bound"), "shard"))
            visits = visits.withColumn("turn", turn).where(F.col("turn") <= size)
        visits = written(visits.select("dim", "block", "shard"))
        if visits.isEmpty():
            break
        found = _compare(visits, blocks, trees, k + 1)
        if top is not None:
            found = found.unionByName(top.drop("place"))
            seen = seen.unionByName(visits)
        else:
            seen = visits
        place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id", "rid"))
        top = written(found.withColumn("place", place).where(F.col("place") <= k + 1))
    if top is None:
        top = queries.select("key", *(F.lit(0).cast("long").alias(c) for c in ("score", "vec_id", "rid"))).limit(0)
    lists = top.groupBy("key").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("low"), "vec_id", "rid"))).alias("best"))
    own = asked.select(F.col("vec_id").alias("query_id"), F.col("rid").alias("own"), "key")
    rest = F.slice(F.filter("best", lambda r: r["rid"] != F.col("own")), 1, k)
    return own.join(lists, "key").select("query_id", F.posexplode(rest).alias("at", "row")).select(
        "query_id", (F.col("at") + 1).alias("rank"),
        F.when(F.col("row.rid") >= 0, F.col("row.vec_id")).alias("vec_id"), (-F.col("row.low")).alias("score"),
    )
