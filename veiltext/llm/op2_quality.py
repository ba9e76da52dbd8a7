"""Quality of documents by a convolutional network over their bytes."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiltext.llm.common import Work, batches, fold, labelled, logistic

CHUNK, HOP, STRIDE, WIDTH, DEPTH, FILTERS = 512, 448, 4, 8, 8, 32


def chunks(text: bytes) -> np.ndarray:
    """Overlapping chunks that cover the whole text, one at least; the last is filled up with zeros."""
    n = max(1, -(-max(len(text) - (CHUNK - HOP), 1) // HOP))
    padded = np.zeros((n - 1) * HOP + CHUNK, dtype=np.uint8)
    padded[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::HOP]


class ByteNet:
    """Byte embedding, one layer of learned filters, maximum over a chunk, one logit per chunk."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32)
        self.filters = rng.normal(0, 1 / np.sqrt(WIDTH * DEPTH), (WIDTH * DEPTH, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.3, FILTERS).astype(np.float32)
        self.shift = np.zeros(1, np.float32)
        self.final = np.zeros(4)

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.shift]

    def _windows(self, x: np.ndarray) -> np.ndarray:
        steps = self.embed[x].reshape(len(x), CHUNK // STRIDE, STRIDE * DEPTH)
        return np.concatenate([steps[:, :-1], steps[:, 1:]], axis=2)

    def logits(self, x: np.ndarray, block: int = 128) -> np.ndarray:
        out = np.empty(len(x))
        for at in range(0, len(x), block):
            windows = self._windows(x[at : at + block])
            top = (windows.reshape(-1, WIDTH * DEPTH) @ self.filters).reshape(*windows.shape[:2], FILTERS).max(axis=1)
            out[at : at + block] = np.maximum(top + self.bias, 0) @ self.out + self.shift[0]
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        windows = self._windows(x)
        values = (windows.reshape(-1, WIDTH * DEPTH) @ self.filters).reshape(*windows.shape[:2], FILTERS)
        best = values.argmax(axis=1)
        top = np.take_along_axis(values, best[:, None], 1)[:, 0] + self.bias
        live = np.maximum(top, 0)
        error = ((1 / (1 + np.exp(-np.clip(live @ self.out + self.shift[0], -30, 30))) - y) / len(y)).astype(np.float32)
        back = error[:, None] * self.out * (top > 0)
        chosen = np.take_along_axis(windows, best[:, :, None], 1)  # chunk, filter, width x depth
        inner = back[:, :, None] * self.filters.T
        where = (best * STRIDE)[:, :, None] + np.arange(WIDTH)
        bytes_ = np.take_along_axis(x, where.reshape(len(x), -1), 1).reshape(-1)
        embed = np.zeros_like(self.embed)
        np.add.at(embed, bytes_, inner.reshape(-1, DEPTH))
        return [embed, np.einsum("cf,cfw->wf", back, chosen, optimize=True), back.sum(axis=0), live.T @ error, np.array([error.sum()], np.float32)]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 4e-3, seed: int = 7) -> ByteNet:
        """Adam on shuffled chunks; both labels weigh the same in total."""
        rng = np.random.default_rng(seed)
        sets = [np.flatnonzero(y == k) for k in (0, 1)]
        if not all(map(len, sets)):
            return self
        first, second = [np.zeros_like(p) for p in self.parts()], [np.zeros_like(p) for p in self.parts()]
        steps = max(40, epochs * len(y) // batch)
        for step in range(1, steps + 1):
            rows = np.concatenate([rng.choice(s, batch // 2) for s in sets])
            pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for p, g, m, v in zip(self.parts(), self.gradients(x[rows], y[rows]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return self

    def features(self, texts: list[bytes]) -> np.ndarray:
        """The mean, largest and smallest logit of each text's chunks."""
        each = [chunks(t) for t in texts]
        bounds = np.cumsum([0, *map(len, each)])
        logits = self.logits(np.concatenate(each))
        return np.column_stack([np.add.reduceat(logits, bounds[:-1]) / np.diff(bounds), *(f.reduceat(logits, bounds[:-1]) for f in (np.maximum, np.minimum))])

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.final[:-1] + self.final[-1], -30, 30)))


def _samples(columns, most: int):
    """Up to `most` chunks of each labelled text, spread over it, beginning at a place that depends on its length."""
    for batch, texts in batches(columns):
        rows = []
        for y, text in zip(batch.column("y").to_pylist(), texts, strict=True):
            every = chunks(text)
            step = max(1, len(every) // most)
            rows.extend((y, c.tobytes()) for c in every[len(text) % step :: step][:most])
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.binary()), strict=True)], names=["y", "chunk"])


def _features(columns, net):
    for batch, texts in batches(columns):
        got = net.value.features(texts)
        yield pa.RecordBatch.from_arrays([batch.column("y"), *(pa.array(got[:, k]) for k in range(3))], names=["y", "a", "b", "c"])


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, out: int = 0, max_train: int = 4000, chunks_each: int = 4) -> ByteNet:
    """A network from at most `max_train` labelled documents and `chunks_each` chunks of each (8 MB on the driver),
    combined over whole documents by a logistic regression on the same documents' chunk logits."""
    spark = docs.sparkSession
    known = labelled(docs, labels, "quality", folds, out, max_train)
    known = known.select(F.col("y"), F.coalesce("text", F.lit("")).alias("text"))
    rows = known.mapInArrow(partial(_samples, most=chunks_each), "y int, chunk binary").toPandas()
    net = ByteNet()
    if not len(rows):
        return net
    rows = rows.sort_values(["chunk", "y"], ignore_index=True)  # the order of partitions plays no part
    x = np.frombuffer(b"".join(map(bytes, rows["chunk"])), dtype=np.uint8).reshape(-1, CHUNK)
    net.fit(x, rows["y"].to_numpy().astype(np.float32))
    got = known.mapInArrow(partial(_features, net=spark.sparkContext.broadcast(net)), "y int, a double, b double, c double").toPandas()
    got = got.sort_values(["a", "b", "c", "y"], ignore_index=True)
    net.final = logistic(got[["a", "b", "c"]].to_numpy(), got["y"].to_numpy().astype(float))
    return net


def _score(columns, net):
    for batch, texts in batches(columns):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(net.value.scores(net.value.features(texts)))], names=["doc_id", "score"])


def quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, out: int = 0, max_train: int = 4000, threshold: float = 0.3
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    The score is the probability of label 1. Only the text's bytes go into it: filters over 8 bytes, learned on a
    bounded sample of labelled rows outside fold `out`, run over overlapping chunks of the whole text; a chunk's
    logit combines the filters' maxima, and a document's probability combines its chunks' mean, largest and smallest logit.

    Null or empty text: one chunk of zeros, so a score like any other. A null id: scored, not held out. Repeated rows: each
    scored. No usable labels: every score is the prior of the labels seen, 0.5 without any. No rows: none.
    """
    Work(docs.sparkSession)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    net = train(texts, labels.select("doc_id", "quality"), folds, out, max_train)
    scored = texts.mapInArrow(partial(_score, net=docs.sparkSession.sparkContext.broadcast(net)), "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
