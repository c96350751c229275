"""Quality classifier on random-indexing word vectors.

Every bucket of words has a sparse random index vector. A word vector is the sum of the
index vectors of the words around it, over the whole corpus. Vectors are pooled per
document, and a two-layer network with calibrated temperature judges the pooled vector.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelake.llm.common import held_out, on_workers
from sievelake.llm.training import labelled_sample

SAMPLE = 10_000
THRESHOLD = 0.3
SEED = 11
# Words share buckets, so the vectors have a fixed size (4 MB) however many words there are.
BUCKETS, DIMS, NONZERO, WINDOW = 1 << 15, 32, 2, 2
# The first buckets are for tokens of signs and tokens that end in several; 0 parts documents.
SIGN_BUCKETS = 256
HIDDEN, EPOCHS, RATE, DECAY = 24, 400, 0.02, 1e-3
KEPT_TOKENS = 400_000

SIGN_END = re.compile(r"[^\w\s]{2,}$|^[^\w\s]+$")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def bucket(token: str) -> int:
    signs = SIGN_END.search(token)
    if signs:
        return 1 + zlib.crc32(signs[0][-3:].encode()) % (SIGN_BUCKETS - 1)
    word = EDGES.sub("", token) or token
    return SIGN_BUCKETS + zlib.crc32(word.encode()) % (BUCKETS - SIGN_BUCKETS)


class Tokens:
    """Buckets of a text's tokens, with those seen before at hand."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = (text or "").lower().split()
        if len(self.known) > KEPT_TOKENS:
            self.known.clear()
        for token in set(tokens):
            if token not in self.known:
                self.known[token] = bucket(token)
        return np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Place and sign of the nonzero components of each bucket's index vector."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, DIMS, (BUCKETS, NONZERO)), rng.choice([-1, 1], (BUCKETS, NONZERO))


def _contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of neighbours' index vectors over all texts of a task, by bucket."""
    place, sign = index_vectors()
    tokens, total = Tokens(), np.zeros(BUCKETS * DIMS)
    gap = np.zeros(WINDOW, np.int64)

    def add(ids: np.ndarray) -> None:
        for away in range(1, WINDOW + 1):
            for a, b in ((ids[:-away], ids[away:]), (ids[away:], ids[:-away])):
                for k in range(NONZERO):
                    at = a * DIMS + place[b, k]
                    np.add(total, np.bincount(at, sign[b, k] * (b > 0), len(total)), out=total)

    pending: list[np.ndarray] = []
    for frame in frames:
        for text in frame["text"]:
            pending += [gap, tokens(text)]
            if sum(map(len, pending[-2:])) > 500_000 or len(pending) > 2000:
                add(np.concatenate([*pending, gap]))
                pending = []
    if pending:
        add(np.concatenate([*pending, gap]))
    sums = total.reshape(BUCKETS, DIMS).astype(np.int64)
    some = np.flatnonzero(sums.any(axis=1))
    yield pd.DataFrame({"bucket": some.astype(np.int32)} | {f"c{i}": sums[some, i] for i in range(DIMS)})


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all buckets, out of every document; whole numbers until the end, so
    that the order of adding does not matter."""
    columns = [f"c{i}" for i in range(DIMS)]
    schema = "bucket int, " + ", ".join(f"{c} long" for c in columns)
    rows = docs.select("text").mapInPandas(_contexts, schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
    out = np.zeros((BUCKETS, DIMS))
    out[rows["bucket"].to_numpy(np.int64)] = rows[columns].to_numpy(np.float64)
    out[0] = 0
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1)).astype(np.float32)


PLACE, SIGN = index_vectors()


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector of a document, its length, and how much its tokens repeat."""
    n = len(ids)
    if not n:
        return np.zeros(DIMS + 6)
    mean = vectors[ids].mean(axis=0, dtype=np.float64)
    index = np.bincount(PLACE[ids].ravel(), SIGN[ids].ravel(), DIMS) / n
    again = (ids[1:] == ids[:-1]).mean() if n > 1 else 0.0
    signs = (ids < SIGN_BUCKETS).mean()
    different = len(np.unique(ids)) / n
    return np.concatenate(
        [mean, [np.linalg.norm(mean), np.linalg.norm(index), np.sqrt(again), np.sqrt(signs), different, np.log1p(n)]]
    )


@dataclass(frozen=True)
class Network:
    """Two layers on standardised inputs; ``temperature`` divides the logit."""

    middle: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.middle) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Full-batch Adam on the log loss."""
    rng = np.random.default_rng(SEED)
    middle, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = (x - middle) / scale
    parts = [rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN), rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
    moment = [np.zeros_like(p) for p in parts]
    square = [np.zeros_like(p) for p in parts]
    for step in range(1, EPOCHS + 1):
        w1, b1, w2, b2 = parts
        h = np.tanh(z @ w1 + b1)
        wrong = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -30, 30))) - y) / len(y)
        back = wrong[:, None] * w2 * (1 - h * h)
        slopes = [z.T @ back + DECAY * w1, back.sum(axis=0), h.T @ wrong + DECAY * w2, wrong.sum(keepdims=True)]
        for p, g, m, s in zip(parts, slopes, moment, square, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    w1, b1, w2, b2 = parts
    return Network(middle, scale, w1, b1, w2, float(b2[0]), 1.0)


def _calibrated(net: Network, x: np.ndarray, y: np.ndarray) -> Network:
    """The temperature with the least log loss on rows that the fit has not seen."""
    logit = net.logits(x)

    def loss(t: float) -> float:
        z = np.clip(logit / t, -30, 30)
        return float(np.mean(np.log1p(np.exp(-z)) + (1 - y) * z))

    best = min(np.geomspace(0.25, 8, 61), key=loss)
    return Network(net.middle, net.scale, net.w1, net.b1, net.w2, net.b2, float(best))


@dataclass(frozen=True)
class Model:
    """Word vectors and network; without both labels, the one label's share alone."""

    vectors: np.ndarray
    network: Network | None
    constant: float

    def score(self, ids: list[np.ndarray]) -> np.ndarray:
        if self.network is None or not ids:
            return np.full(len(ids), self.constant)
        return self.network.probabilities(np.stack([pooled(i, self.vectors) for i in ids]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model out of all documents (the word vectors) and a bounded labelled sample.

    The driver gets a pooled vector of 38 numbers for each sampled text. A fifth of them is
    used for the temperature only. Without any label every score is 1.
    """
    on_workers(docs.sparkSession)
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = Tokens()
        for frame in frames:
            x = [pooled(tokens(text), shared.value).tolist() for text in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"].astype("int32"), "x": x})

    rows = labelled_sample(docs, labels, "quality", sample).mapInPandas(pool, "doc_id long, label int, x array<double>")
    rows = rows.toPandas().sort_values("doc_id")
    y = rows["label"].to_numpy(np.float64)
    if len(set(y)) < 2:
        return Model(vectors, None, float(y.mean()) if len(y) else 1.0)
    x = np.stack(rows["x"].to_numpy())
    aside = np.array([zlib.crc32(str(i).encode()) % 5 == 1 for i in rows["doc_id"]])
    if len(set(y[~aside])) < 2 or len(set(y[aside])) < 2:
        return Model(vectors, _fit(x, y), 0.0)
    return Model(vectors, _calibrated(_fit(x[~aside], y[~aside]), x[aside], y[aside]), 0.0)


def with_score(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with a double column ``name``: how likely the whole text is of quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = Tokens()
        for batch in batches:
            yield pd.Series(shared.value.score([tokens(text) for text in batch]), dtype="float64")

    return docs.withColumn(name, F.pandas_udf(score, "double")(F.col("text")))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs (doc_id, text)``.

    ``labels`` has ``doc_id, quality``. Held-out ids (a fifth, by CRC-32 of the id as text)
    take no part in training; neither do null ids or labels. Null and empty texts are
    scored as texts without words. Repeated rows are scored each; other columns are ignored.
    """
    model = train(docs, labels, sample)
    scored = with_score(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
