"""Document quality by attention-based multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, held_out, with_row_id, written

#: Words of a passage.
PASSAGE = 64
#: The classifier is fitted on all passages of at most so many labelled documents of at most so many bytes in all,
#: drawn by a hash of their id; a document of more than an eighth of these bytes is not drawn. The driver holds less
#: than two bytes of features for each byte. Scoring reads all passages of all documents.
TRAIN_DOCS, TRAIN_BYTES = 4_000, 32_000_000
#: Passages of one step of the fit, unless a single document has more.
STEP_PASSAGES = 8_192
HIDDEN, ATTENTION, EPOCHS, BATCH, RATE, SEED = 24, 12, 25, 64, 0.01, 42
THRESHOLD = 0.7
#: Bytes whose features are computed together.
STEP = 2_000_000

#: Fixed value: characters that make a class of bytes of their own.
MARKS = b" \n.,!?;:'\"-()*%&$#|@/<>_="
COARSE = 12


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """The class of every byte: fine (marks one by one) and coarse."""
    fine, coarse = np.zeros(256, np.int64), np.zeros(256, np.int64)
    for b in range(256):
        c = chr(b)
        kind = 0
        if b >= 0x80:
            kind = 1
        elif c in "aeiou":
            kind = 2
        elif c.islower():
            kind = 3
        elif c in "AEIOU":
            kind = 4
        elif c.isupper():
            kind = 5
        elif c.isdigit():
            kind = 6
        fine[b] = kind
        coarse[b] = {0: 10, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6}[kind]
    for k, b in enumerate(MARKS):
        fine[b] = 7 + k
    for group, name in ((7, b" \t\x0b\x0c\r"), (8, b"\n"), (9, b".,;:?'\"-()"), (11, b"!*%&$#|@")):
        coarse[list(name)] = group
    return fine, coarse


FINE, ROUGH = _classes()
KINDS = 7 + len(MARKS)
FEATURES = KINDS + COARSE * COARSE + 5
BLANK_BYTES = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def passage_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of stripped, non-empty texts, and how many passages each text has.

    A passage is PASSAGE words long. Its features are shares of byte classes and of pairs of them, word lengths,
    and how many words repeat one of the three before.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    blank = BLANK_BYTES[data]
    first = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    stop = np.flatnonzero(blank & np.append(False, ~blank[:-1]))
    doc = np.searchsorted(ends, first, side="right")
    words = np.bincount(doc, minlength=len(texts))
    at = np.arange(len(first)) - np.repeat(np.cumsum(words) - words, words)
    n = -(-words // PASSAGE)
    passage = (np.cumsum(n) - n)[doc] + at // PASSAGE
    total = int(n.sum())
    byte = np.repeat(passage, np.diff(np.append(first, len(data))))
    size = np.bincount(byte, minlength=total)[:, None]
    fine = np.bincount(byte * KINDS + FINE[data], minlength=total * KINDS).reshape(total, KINDS) / size
    rough = ROUGH[data]
    pair = byte[:-1] * COARSE * COARSE + rough[:-1] * COARSE + rough[1:]
    inside = np.ones(len(data), bool)
    inside[ends - 1] = False
    pairs = np.bincount(pair[inside[:-1]], minlength=total * COARSE * COARSE).reshape(total, -1) / size
    power = np.cumprod(np.full(len(data), 0x9E3779B97F4A7C15, np.uint64))
    inverse = np.cumprod(np.full(len(data), pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64))
    sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power))
    name = (sums[stop] - sums[first]) * inverse[first]
    length = stop - first
    count = np.bincount(passage, minlength=total)
    more = [count / PASSAGE, np.bincount(passage, weights=np.minimum(length, 50), minlength=total) / count / 10]
    for lag in (1, 2, 3):
        same = np.zeros(len(name))
        same[lag:] = (name[lag:] == name[:-lag]) & (at[lag:] >= lag)
        more.append(np.bincount(passage, weights=same, minlength=total) / count)
    return np.hstack([fine, pairs, np.array(more).T]).astype(np.float32), n


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Passage features of whole texts and the number of passages of each; a text without a word is one of zeros."""
    bodies, owner = [], []
    for k, text in enumerate(texts):
        body = (text or "").encode().strip(b" \t\n\x0b\x0c\r")
        if len(body) > 2 * STEP:
            data = BLANK_BYTES[np.frombuffer(body, np.uint8)]
            cuts = np.flatnonzero(~data & np.append(True, data[:-1]))[:: PASSAGE * 4096].tolist()
            parts = [body[a:b] for a, b in zip(cuts, [*cuts[1:], len(body)])]
        else:
            parts = [body] if body else []
        bodies += parts
        owner += [k] * len(parts)
    n = np.zeros(len(texts), np.int64)
    found, at = [], 0
    while at < len(bodies):
        stop, held = at, 0
        while stop < len(bodies) and (stop == at or held + len(bodies[stop]) <= STEP):
            held += len(bodies[stop])
            stop += 1
        x, counts = passage_features(bodies[at:stop])
        np.add.at(n, owner[at:stop], counts)
        found.append(x)
        at = stop
    x = np.vstack(found) if found else np.empty((0, FEATURES), np.float32)
    empty = np.flatnonzero(n == 0)
    if len(empty):
        x = np.insert(x, (np.cumsum(n) - n)[empty], 0, axis=0)
        n[empty] = 1
    return x, n


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class AttentionModel:
    """Passage encoder, gated attention over passages, and a logistic score of the weighted passage."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        shapes = {"w": (FEATURES, HIDDEN), "b": HIDDEN, "v": (HIDDEN, ATTENTION), "u": (HIDDEN, ATTENTION), "q": ATTENTION}
        self.p = {k: rng.normal(0, 0.1, s) for k, s in shapes.items()} | {"c": rng.normal(0, 0.1, HIDDEN), "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)

    def forward(self, x: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
        """Everything that the score of bags of ``n`` passages is made of."""
        p, starts = self.p, np.cumsum(n) - n
        bag = np.repeat(np.arange(len(n)), n)
        h = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = (t * g) @ p["q"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["d"]), "starts": starts}

    def score(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.forward(x, n)["y"]

    def gradient(self, x: np.ndarray, n: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss."""
        p, s = self.p, self.forward(x, n)
        off = (s["y"] - y) / len(y)
        dz = off[:, None] * p["c"]
        spread = dz[s["bag"]]
        da = (s["h"] * spread).sum(axis=1)
        de = s["a"] * (da - np.add.reduceat(s["a"] * da, s["starts"])[s["bag"]])
        dtg = de[:, None] * p["q"]
        dt, dg = dtg * s["g"] * (1 - s["t"] ** 2), dtg * s["t"] * s["g"] * (1 - s["g"])
        dh = (s["a"][:, None] * spread + dt @ p["v"].T + dg @ p["u"].T) * (1 - s["h"] ** 2)
        scaled = np.clip((x - self.mean) / self.scale, -8, 8)
        return {
            "w": scaled.T @ dh, "b": dh.sum(axis=0), "v": s["h"].T @ dt, "u": s["h"].T @ dg,
            "q": (s["t"] * s["g"]).T @ de, "c": s["z"].T @ off, "d": off.sum(keepdims=True),
        }

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> AttentionModel:
        """Adam over mini-batches of documents, in an order that only ``seed`` decides."""
        x = np.vstack(bags)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        rng, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        for epoch in range(epochs):
            for part in batches_of(rng.permutation(len(bags)), [len(b) for b in bags]):
                n = np.array([len(bags[i]) for i in part])
                step += 1
                for k, grad in self.gradient(np.vstack([bags[i] for i in part]), n, labels[part]).items():
                    grad = grad + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad**2
                    rate = RATE * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.p[k] = self.p[k] - rate * m[k] / (np.sqrt(v[k]) + 1e-8)
        return self


def batches_of(order: np.ndarray, sizes: list[int], docs: int = BATCH, passages: int = STEP_PASSAGES) -> Iterator[list]:
    """The documents in their order, in batches of at most ``docs`` documents and ``passages`` passages, or one document."""
    part, held = [], 0
    for i in order.tolist():
        if part and (len(part) == docs or held + sizes[i] > passages):
            yield part
            part, held = [], 0
        part.append(i)
        held += sizes[i]
    if part:
        yield part


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES,
) -> AttentionModel | None:
    """A model fitted on labelled documents that are not held out, a bounded sample of them; None without any.

    Several labels of a document are averaged and rounded; null labels and null ids are passed over. Of the rows of a
    repeated id one is drawn, that of the least hash of its text.
    """
    own = labels.where(F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{doc_id}`").alias("__id"))
    own = own.agg((F.avg(F.col(f"`{label}`").cast("double")) >= 0.5).cast("double").alias("__label"))
    own = own.where(~held_out(F.col("__id")))
    ids = docs.select(F.col(f"`{doc_id}`").alias("__id")).distinct()
    drawn = ids.join(own, "__id").orderBy(F.xxhash64("__id", F.lit(SEED)), "__id").limit(train_docs)
    drawn = F.broadcast(drawn)  # at most train_docs rows
    base = with_row_id(docs, doc_id, text)
    base = base.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("text"), ROW)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), ROW, size)).alias("one")
    held = base.join(drawn, "__id").groupBy("__id", "__label").agg(one).where(F.col("one.size") <= train_bytes // 8)
    before = F.sum("one.size").over(Window.orderBy(F.xxhash64("__id", F.lit(SEED)), "__id"))  # of train_docs rows
    chosen = held.withColumn("bytes", before).where(F.col("bytes") <= train_bytes)
    chosen = written(chosen.select(F.col(f"one.{ROW}").alias(ROW), "__label"))
    rows = base.join(F.broadcast(chosen), ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n = encode(batch.column(1).to_pylist())
            bags = [part.tobytes() for part in np.split(x, np.cumsum(n)[:-1])] if len(n) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(2), pa.array(bags, pa.binary())],
                names=["id", "label", "bag"],
            )

    found = rows.select("__id", "text", "__label").mapInArrow(run, "id string, label double, bag binary").collect()
    found.sort(key=lambda r: (r["id"], bytes(r["bag"])))
    if not found:
        return None
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in found]
    return AttentionModel().fit(bags, np.array([r["label"] for r in found]))


def score(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """How likely each whole text has label 1: __row, doc_id, held_out, score, predicted.

    A score reads the text only. Null and empty texts are one passage without features. Without a usable label
    every score is 0.5. Repeated rows are scored one by one; an empty table gives no rows.
    """
    model = train(docs, labels, doc_id, text, label)
    rows = with_row_id(docs, doc_id, text).select(
        ROW, F.col(f"`{doc_id}`").alias("doc_id"), held_out(F.col(f"`{doc_id}`")).alias("held_out"), f"`{text}`"
    )
    shape = rows.select(ROW, "doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                if model is None:
                    found = np.full(len(batch), 0.5)
                else:
                    found = model.score(*encode(batch.column(3).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                    names=shape.names,
                )

    return rows.mapInArrow(run, shape)
