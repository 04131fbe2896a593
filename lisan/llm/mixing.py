"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

from math import floor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, WORD, stable, whole_rows, with_row_id, written

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3.0
#: Documents of a source that one flight takes; what each leaves open (at most two) flies again with others.
BLOCK = 10_000
#: Documents that the landing of a source rounds together.
LANDING = 12
SEED = 42
#: Sources are listed on the driver; more than this are refused, not cut.
MOST_SOURCES = 1_000_000


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> dict:
    """Words to take from each source. ``weights`` repeat over the sources by code point, null last.

    The sources share all words by weight. No target exceeds ``most`` times its source; the excess is shared
    again by weight among the others until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, open_ = {}, float(sum(sizes.values())), list(order)
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return out | share
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def flight(p: list[float], size: list[int], draw: list[float]) -> list[float]:
    """The flight phase: probabilities move until at most two are strictly between 0 and 1.

    Each step moves three open probabilities along the direction that changes neither the expected number of
    documents nor that of words, up to the side of the cube drawn with the odds that keep their means.
    """
    p, live = list(p), []
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        live.append(i)
        while len(live) >= 2:
            if len(live) == 2:
                if size[live[0]] != size[live[1]]:
                    break
                u = (1.0, -1.0)
            else:
                a, b, c = (size[k] for k in live)
                u = (float(b - c), float(c - a), float(a - b))
                if u == (0.0, 0.0, 0.0):
                    u = (1.0, -1.0, 0.0)
            up = min((1.0 - p[k]) / v if v > 0 else -p[k] / v for k, v in zip(live, u) if v)
            down = min(p[k] / v if v > 0 else (p[k] - 1.0) / v for k, v in zip(live, u) if v)
            step = up if draw[i] * (up + down) < down else -down
            for k, v in zip(live, u):
                x = p[k] + step * v
                p[k] = 0.0 if x < 1e-9 else 1.0 if x > 1.0 - 1e-9 else x
            before = len(live)
            live = [k for k in live if 0.0 < p[k] < 1.0]
            if len(live) == before:
                break
    return p


def land(p: list[float], size: list[int]) -> list[float]:
    """The landing phase: of all ways to round what is open (at most LANDING), the one nearest to the expectations.

    Words count first, then documents, then the order of the ways.
    """
    live = [i for i, x in enumerate(p) if 0.0 < x < 1.0]
    ways = (np.arange(1 << len(live))[:, None] >> np.arange(len(live))) & 1
    off = ways - np.array([p[i] for i in live])
    words = np.abs(off @ np.array([size[i] for i in live], float))
    best = ways[np.lexsort((np.abs(off.sum(axis=1)), np.round(words, 6)))[0]]
    p = list(p)
    for i, w in zip(live, best):
        p[i] = float(w)
    return p


def settle(p: list[float], size: list[int], draw: list[float]) -> list[float]:
    """Flight, then landing. Documents spread over the sizes stay out of the flight and make the landing fine."""
    live = [i for i, x in enumerate(p) if 0.0 < x < 1.0]
    spare = min(LANDING - 2, len(live))
    apart = {live[(k * len(live) + len(live) // 2) // spare] for k in range(spare)}
    rest = [i for i in range(len(p)) if i not in apart]
    for i, x in zip(rest, flight([p[i] for i in rest], [size[i] for i in rest], [draw[i] for i in rest])):
        p[i] = x
    return land(p, size)


def _fly(rows: DataFrame) -> DataFrame:
    """One flight in every (source, block); what is open of a source that has one block lands."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "draw", "doc_id"], ascending=[False, True, True], na_position="last")
        step = settle if pdf["blocks"].iloc[0] == 1 else flight
        return pdf.assign(p=step(pdf["p"].tolist(), pdf["size"].tolist(), pdf["draw"].tolist()))

    return rows.groupBy("source", "block").applyInPandas(run, rows.schema)


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED,
) -> DataFrame:
    """How often the mix takes each document: __row, doc_id, size, source_size, target, copies, taken.

    Size is the number of words (runs without ASCII white space; null text: 0). A source is taken target / size
    times: whole times surely, and the fraction by the cube method, balanced on documents and words. Flights run
    in blocks of a source dealt by a hash of the document, so a large source is many tasks' work; what they leave
    open flies again until a source has one block, and lands there, whatever the other sources have. Draws are hashes of doc_id, size and ``seed``:
    reruns over the same rows agree. Null sources form one source, last in order. Sources without a word have
    target 0 and nothing is taken from them. Repeated rows are drawn one by one; an empty table gives no rows.
    """
    size = F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = written(
        with_row_id(docs, doc_id, text, source).select(
            ROW,
            F.col(f"`{doc_id}`").alias("doc_id"),
            F.col(f"`{source}`").cast("string").alias("source"),
            size.alias("size"),
        )
    )
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    found = totals.limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    target = targets({r["source"]: r["source_size"] for r in found}, weights, most)
    rates = []
    for r in found:
        rate = target[r["source"]] / r["source_size"] if r["source_size"] else 0.0
        whole = floor(rate + 1e-12)
        rates.append((r["source"], r["source_size"], target[r["source"]], whole, max(0.0, rate - whole), r["n"]))
    spark = docs.sparkSession
    table = spark.createDataFrame(
        rates, "source string, source_size long, target double, whole int, p double, n long"
    )
    key = F.xxhash64("doc_id", "size", F.lit(seed))
    state = rows.alias("a").join(table.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select(
        ROW, "doc_id", "a.source", "size", "source_size", "target", "whole", "p",
        (F.pmod(key, F.lit(1 << 52)) / float(1 << 52)).alias("draw"),
        F.pmod(F.xxhash64(key), F.ceil(F.col("n") / BLOCK)).alias("block"),
        F.ceil(F.col("n") / BLOCK).alias("blocks"),
    )
    blocks = max([1, *(-(-r["n"] // BLOCK) for r in found)])
    sure, out = state.where("p <= 0"), []
    open_ = state.where("p > 0")
    while True:
        flown = written(_fly(open_))
        out.append(flown.where("p = 0 OR p = 1"))
        if blocks == 1:
            break
        open_ = flown.where("p > 0 AND p < 1").withColumns(
            {"block": F.floor(F.col("block") / (BLOCK // 4)), "blocks": F.ceil(F.col("blocks") / (BLOCK // 4))}
        )
        blocks = -(-blocks // (BLOCK // 4))
    result = sure
    for x in out:
        result = result.unionByName(x)
    copies = (F.col("whole") + F.col("p").cast("int")).cast("int")
    return result.select(
        ROW, "doc_id", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken")
    )


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken."""
    docs = stable(docs)
    taken = mix(docs, doc_id, text, source).where("copies > 0").select(ROW, F.col("copies").alias("__copies"))
    rows = whole_rows(docs).join(taken, ROW)
    return rows.select("__doc", F.explode(F.sequence(F.lit(1), "__copies"))).select("__doc.*")
