"""Near-duplicate embeddings by dual traversal of cover trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, components, forest, with_row_id, written

THRESHOLD = 0.95
#: Vectors of a tile; two tiles are compared by one task.
TILE = 8_192
#: The top of the tree is laid out over a bounded sample, at most PIVOTS cells; every vector is then assigned.
PIVOT_SAMPLE, PIVOTS = 4_096, 256
#: Slack of the bounds against rounding.
SLACK = 1e-6


def unit_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(__row, vec_id, unit, dim): unit vectors as packed doubles; null for vectors that link with nothing."""
    base = with_row_id(rows, vec_id, embedding).select(
        ROW, F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v")
    )
    shape = base.select(ROW, "vec_id", F.lit(b"").alias("unit"), F.lit(0).alias("dim")).schema
    shape["unit"].nullable = shape["dim"].nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, dims = [], []
            for v in batch.column(2):
                x = None if v.as_py() is None else np.array(v.as_py(), float)
                if x is not None and len(x) and np.isfinite(x).all() and x.any():
                    x = x / np.abs(x).max()
                    units.append((x / np.sqrt(x @ x)).tobytes())
                    dims.append(len(x))
                else:
                    units.append(None)
                    dims.append(None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(units, pa.binary()), pa.array(dims, pa.int32())], names=shape.names
            )

    return base.mapInArrow(run, shape)


def net(x: np.ndarray, radius: float, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Centres (places in ``x``, ``first`` among them) more than ``radius`` apart that cover x, and each one's centre."""
    centre = np.full(len(x), -1)
    centres: list[int] = []
    open_ = np.concatenate([[first], np.delete(np.arange(len(x)), first)])
    while len(open_):
        batch, chosen = open_[:128], []
        apart = _distance(x[batch], x[batch])
        for k in range(len(batch)):
            if not chosen or apart[k, chosen].min() > radius:
                chosen.append(k)
        new = batch[chosen]
        far = _distance(x[open_], x[new])
        near = far.argmin(axis=1)
        covered = far[np.arange(len(open_)), near] <= radius
        own = np.isin(open_, new)
        centre[open_[covered]] = new[near[covered]]
        centre[open_[own]] = open_[own]
        centres += new.tolist()
        open_ = open_[~(covered | own)]
    return np.array(centres), centre


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class CoverTree:
    """Nested levels of nodes over unit vectors; each level's centres cover their points within half the last radius.

    Levels that hardly divide the nodes further are passed over. ``levels`` holds (centres, covering radii, parent of
    each node in the level before), from the root on; ``points`` are places in x by node of the last level.
    """

    def __init__(self, x: np.ndarray, smallest: float):
        self.x = x
        node = np.zeros(len(x), int)
        centres = np.zeros(1, int)
        self.levels = [(centres, np.array([_distance(x, x[:1]).max()]), np.zeros(1, int))]
        radius, kept, kept_centres = 1.0, node, centres
        while radius >= smallest:
            order = np.argsort(node, kind="stable")
            new, found = np.empty(len(x), int), []
            for k, part in enumerate(np.split(order, np.cumsum(np.bincount(node, minlength=len(centres)))[:-1])):
                if len(part) == 1:
                    new[part] = len(found)
                    found.append(centres[k])
                    continue
                own, of = net(x[part], radius, int(np.flatnonzero(part == centres[k])[0]))
                place = np.full(len(part), -1)
                place[own] = np.arange(len(own)) + len(found)
                new[part] = place[of]
                found += part[own].tolist()
            node, centres = new, np.array(found)
            radius /= 2
            if len(centres) >= 2 * len(kept_centres) or radius < smallest:
                if len(centres) > len(kept_centres):
                    parent = np.empty(len(centres), int)
                    parent[node] = kept
                    far = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", x, x[centres[node]]), 0))
                    radii = np.zeros(len(centres))
                    np.maximum.at(radii, node, far)
                    self.levels.append((centres, radii, parent))
                    kept, kept_centres = node, centres
        order = np.argsort(kept, kind="stable")
        self.points = np.split(order, np.cumsum(np.bincount(kept, minlength=len(kept_centres)))[:-1])


def node_pairs(a: CoverTree, b: CoverTree, reach: float) -> np.ndarray:
    """Pairs of last-level nodes that may hold points within ``reach``: both trees are descended together."""
    alive = np.ones((1, 1), bool)
    for k in range(max(len(a.levels), len(b.levels))):
        (ca, ra, pa_), (cb, rb, pb) = a.levels[min(k, len(a.levels) - 1)], b.levels[min(k, len(b.levels) - 1)]
        rows = pa_ if k < len(a.levels) else np.arange(len(ca))
        cols = pb if k < len(b.levels) else np.arange(len(cb))
        below = np.empty((len(ca), len(cb)), bool)
        for at in range(0, len(ca), 1024):
            part = slice(at, at + 1024)
            bound = reach + SLACK + ra[part, None] + rb[None, :]
            below[part] = alive[rows[part]][:, cols] & (_distance(a.x[ca[part]], b.x[cb]) <= bound)
        alive = below
    return np.argwhere(alive)


def tile_links(x: np.ndarray, y: np.ndarray | None, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of links (places in x, places in y) with cosine >= threshold; within x, each pair once, if y is None."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    a = CoverTree(x, reach / 4)
    b = a if y is None else CoverTree(y, reach / 4)
    pairs = node_pairs(a, b, reach)
    if y is None:
        pairs = pairs[pairs[:, 0] <= pairs[:, 1]]
        pairs = pairs[(pairs[:, 0] != pairs[:, 1]) | np.array([len(a.points[k]) > 1 for k in pairs[:, 0]], bool)]
    starts = np.flatnonzero(np.diff(pairs[:, 0], prepend=-1))
    for part in np.split(pairs, starts[1:]) if len(pairs) else []:
        left = a.points[part[0, 0]]
        right = np.concatenate([b.points[k] for k in part[:, 1]])
        for at in range(0, len(left), 1024):
            i, j = np.nonzero(a.x[left[at : at + 1024]] @ b.x[right].T >= threshold)
            i, j = left[at + i], right[j]
            if y is None:
                inner = np.isin(j, left)
                i, j = i[~inner | (i < j)], j[~inner | (i < j)]
            yield i, j


def _matrix(units: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(units), float).reshape(len(units), -1)


def pivots(units: list[tuple[int, bytes]], sizes: dict[int, int], tile: int) -> list[tuple[int, np.ndarray]]:
    """(dim, pivots): of each dimension as many as it has tiles, from the first level of a cover tree that has them."""
    out = []
    for dim, n in sorted(sizes.items()):
        x = np.array([np.frombuffer(u) for d, u in units if d == dim]).reshape(-1, dim)
        if not len(x):
            x = np.eye(1, dim)
        most, radius, centres = min(PIVOTS, -(-n // tile)), 1.0, np.zeros(1, int)
        while len(centres) < min(most, len(x)) and radius > SLACK:
            centres, _ = net(x, radius)
            radius /= 2
        out.append((dim, x[centres[:most]]))
    return out


def deal_tiles(vectors: DataFrame, threshold: float, tile: int) -> tuple[DataFrame, DataFrame]:
    """(tile, id, unit, n) of all vectors, and the pairs (a, b) of tiles that may hold links.

    Each vector joins the cell of its nearest pivot. A cell is cut into shells by distance from its pivot, and a
    shell that is still large by a hash. Two tiles are a pair unless the pivots' distance, the covering radii or
    the shells rule out that they hold two vectors close enough.
    """
    spark, reach = vectors.sparkSession, float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    sizes = {r["dim"]: r["count"] for r in vectors.groupBy("dim").count().collect()}
    rows = max(1, min(PIVOT_SAMPLE, (1 << 24) // (8 * max([1, *sizes]))))
    drawn = vectors.orderBy(F.xxhash64("unit"), "id").select("dim", "unit").limit(rows).collect()
    chosen = pivots([(r["dim"], bytes(r["unit"])) for r in drawn], sizes, tile)
    base, total = {}, 0
    for dim, p in chosen:
        base[dim], total = (total, p), total + len(p)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, units = batch.column(3).to_numpy(), batch.column(1).to_pylist()
            cell, far = np.zeros(len(dims), np.int64), np.zeros(len(dims))
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                first, p = base[dim]
                apart = _distance(np.frombuffer(b"".join([units[k] for k in at])).reshape(-1, dim), p)
                near = apart.argmin(axis=1)
                cell[at], far[at] = first + near, apart[np.arange(len(at)), near]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cell), pa.array(far)], names=["id", "unit", "n", "cell", "far"])

    placed = written(
        vectors.select("id", "unit", "n", "dim").mapInArrow(assign, "id long, unit binary, n long, cell long, far double")
    )
    steps = F.array(*[F.lit(k / 64) for k in range(1, 64)])
    stats = placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("far").alias("radius"), F.percentile_approx("far", steps, 10_000).alias("cuts")
    ).collect()  # at most PIVOTS rows a dimension
    cuts = []
    for r in stats:
        shells = min(64, -(-r["n"] // tile))
        cuts.append((r["cell"], sorted({r["cuts"][64 * k // shells - 1] for k in range(1, shells)})))
    cuts = spark.createDataFrame(cuts, "cell long, cuts array<double>")
    shelled = placed.join(cuts, "cell").withColumn("shell", F.size(F.filter("cuts", lambda c: c < F.col("far"))))
    shells = shelled.groupBy("cell", "shell").agg(
        F.ceil(F.count("*") / tile).cast("int").alias("parts"), F.min("far").alias("low"), F.max("far").alias("high")
    )
    shells = written(shells)
    name = F.col("cell") * (1 << 40) + F.col("shell") * (1 << 24)
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    dealt = shelled.join(shells, ["cell", "shell"]).select((name + part).alias("tile"), "id", "unit", "n")
    all_tiles = shells.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    all_tiles = all_tiles.select("cell", (name + F.col("part")).alias("tile"), "low", "high")
    radius = {r["cell"]: r["radius"] for r in stats}
    near = []
    for dim, (first, p) in base.items():
        apart = _distance(p, p)
        own = [k for k in range(len(p)) if first + k in radius]
        near += [
            (first + i, first + j, float(apart[i, j]))
            for i in own
            for j in own
            if i <= j and apart[i, j] <= reach + radius[first + i] + radius[first + j]
        ]
    near = spark.createDataFrame(near, "ca long, cb long, apart double")
    a, b = all_tiles.alias("a"), all_tiles.alias("b")
    same = (
        (F.col("a.tile") <= F.col("b.tile"))
        & (F.col("a.low") - F.col("b.high") <= reach)
        & (F.col("b.low") - F.col("a.high") <= reach)
    )
    other = F.col("apart") <= reach + F.col("a.high") + F.col("b.high")
    pairs = near.join(a, F.col("ca") == F.col("a.cell")).join(b, F.col("cb") == F.col("b.cell"))
    pairs = pairs.where(F.when(F.col("ca") == F.col("cb"), same).otherwise(other))
    return dealt, pairs.select(F.col("a.tile").alias("a"), F.col("b.tile").alias("b"))


def compare_tiles(dealt: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b, links): links as forests (a, b), and for each vector how many it has in a pair of tiles (b null)."""
    left = pairs.join(dealt.withColumnRenamed("tile", "a"), "a").withColumn("side", F.lit(0))
    right = pairs.where("a <> b").join(dealt.withColumnRenamed("tile", "b"), "b").withColumn("side", F.lit(1))
    rows = left.unionByName(right)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "id"])
        one = (pdf["side"] == 0).to_numpy()
        alone = bool((pdf["a"] == pdf["b"]).iloc[0])
        ids, n = pdf["id"].to_numpy(), pdf["n"].to_numpy()
        x = _matrix(pdf["unit"][one]) if one.any() else None
        y = None if alone or one.all() else _matrix(pdf["unit"][~one])
        shift = 0 if alone else int(one.sum())
        links, a, b, held = np.zeros(len(ids)), [], [], 0
        if x is not None and (alone or y is not None):
            for i, j in tile_links(x, y, threshold):
                j = j + shift
                links += np.bincount(i, weights=n[j], minlength=len(ids))
                links += np.bincount(j, weights=n[i], minlength=len(ids))
                a.append(ids[i]), b.append(ids[j])
                held += len(i)
                if held > 1_000_000:
                    k, m = forest(np.concatenate(a), np.concatenate(b))
                    a, b, held = [k], [m], len(k)
        k, m = forest(np.concatenate(a), np.concatenate(b)) if a else (ids[:0], ids[:0])
        has = np.flatnonzero(links)
        return pd.DataFrame(
            {
                "a": np.concatenate([k, ids[has]]),
                "b": pd.array([*m.tolist(), *[None] * len(has)], dtype="Int64"),
                "links": np.concatenate([np.zeros(len(k)), links[has]]).astype(np.int64),
            }
        )

    return rows.groupBy("a", "b").applyInPandas(run, "a long, b long, links long")


def near_vectors(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD,
    tile: int = TILE,
) -> DataFrame:
    """The links of every vector: __row, vec_id, n_links, component_id, kept.

    Two vectors link if their cosine, in double precision, is at least ``threshold``; only vectors of the same
    length are compared. Null, empty and zero vectors and those with a null or non-finite component link with
    nothing. n_links counts other rows, copies included; component_id is the smallest vec_id that links lead to
    (nulls are passed over). Copies are folded first and compared once. Other columns are not read; an empty table
    gives no rows.
    """
    units = unit_vectors(rows, vec_id, embedding).withColumn("key", F.unhex(F.sha2("unit", 256)))
    units = written(units)
    folded = units.where("unit IS NOT NULL").groupBy("key").agg(
        F.first("unit").alias("unit"), F.first("dim").alias("dim"), F.count("*").alias("n"),
        F.min("vec_id").alias("least"),
    )
    vectors = written(folded.withColumn("id", F.monotonically_increasing_id()))
    found = written(compare_tiles(*deal_tiles(vectors, threshold, tile), threshold))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "id")
    named = vectors.select("id", "key", "n", "least").join(roots, "id", "left").join(links, "id", "left")
    named = written(named.withColumn("root", F.coalesce("root", "id")))
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_key = named.join(groups, "root").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    out = units.select(ROW, "vec_id", "key").join(by_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        ROW, "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
