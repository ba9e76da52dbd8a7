"""Language-model scores by a hashed maximum-entropy model over word classes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiltext.llm.common import Work, batches, fold, replayed, word_hashes

#: Word classes (the last one is that of the end), buckets of each kind of context, features of a place besides the constant.
CLASSES, BUCKETS, KINDS = 32, 4096, 3
FEATURES = 1 + KINDS * BUCKETS
END = b"\n"  # no word can hold it
#: Text bytes of a block, the unit in which words are counted and texts are scored.
BLOCK_BYTES = 10 << 20
_SLICE = 2 << 20


#: Classes of words by their last two bytes (0 before a word of one), so that unseen words have a class as well.
_MIX = ((np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(CLASSES - 1)).astype(np.int32)


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in runs of about _SLICE bytes, to bound what arrays over bytes and lists of words take."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= _SLICE:
            yield texts[begin : i + 1]
            begin, size = i + 1, 0
    if begin < len(texts):
        yield texts[begin:]


class Block:
    """The tokens of some texts as numbers: classes, context features and word hashes of each place and, if `named`, the words.

    A context bucket is a word's hash, 1 and up; 0 stands for what is before a text.
    """

    def __init__(self, texts: list[bytes], named: bool = True):
        places, hashed, spelled, targets, features, lengths = [], [], [], [], [], []
        for some in _slices(texts):
            hashes, first, starts, ends = word_hashes(some)
            n = np.diff(first)
            lengths.append(n + 1)
            place = np.arange(len(hashes)) + np.repeat(np.arange(len(some)), n)  # one end for each text before
            size = len(hashes) + len(some)
            whole = np.frombuffer(b"\n".join(some).lower() + b"\n", dtype=np.uint8).astype(np.int32)
            target = np.full(size, CLASSES - 1, np.int32)
            target[place] = _MIX[whole[ends - 1] * 256 + np.where(ends - starts > 1, whole[np.maximum(ends - 2, 0)], 0)]
            bucket = np.zeros(size, np.int32)  # of an end: 0
            bucket[place] = (hashes % np.uint64(BUCKETS - 1)).astype(np.int32) + 1
            before, skipped = np.zeros(size, np.int32), np.zeros(size, np.int32)
            before[1:], skipped[2:] = bucket[:-1], bucket[:-2]
            begun = np.cumsum(np.concatenate([[0], n + 1]))[:-1]
            skipped[begun] = 0
            skipped[begun[n > 0] + 1] = 0
            features.append(np.column_stack([1 + before, 1 + BUCKETS + skipped, 1 + 2 * BUCKETS + (before * 31337 + skipped * 7919) % BUCKETS]))
            targets.append(target)
            places.append(place + sum(map(len, targets[:-1])))
            hashed.append(hashes)
            if named:
                spelled.append((b"\n".join(some).lower(), starts, ends))
        self.bounds = np.cumsum(np.concatenate([[0], *lengths]))
        self.target = np.concatenate(targets)
        self.features = np.concatenate(features)
        self.places, self.hashes = np.concatenate(places), np.concatenate(hashed)  # of the words; the other places are ends
        if named:
            self._name(hashed, spelled)

    def _name(self, hashed: list[np.ndarray], spelled: list) -> None:
        """words with their classes, and ids: which word stands at each place (0: the end). Words of a block are told apart by 64-bit hashes."""
        _, first, inverse = np.unique(self.hashes, return_index=True, return_inverse=True)
        self.words = [END]
        slices = np.cumsum([0, *map(len, hashed)])
        which = np.searchsorted(slices, first, side="right") - 1
        for k, at in zip(which.tolist(), (first - slices[which]).tolist(), strict=True):
            text, starts, ends = spelled[k]
            self.words.append(text[starts[at] : ends[at]])
        self.classes = np.concatenate([[CLASSES - 1], self.target[self.places[first]]]).astype(np.int32)
        self.ids = np.zeros(len(self.target), np.int32)
        self.ids[self.places] = inverse + 1

    def counts(self, words: list[bytes], c: np.ndarray) -> np.ndarray:
        """Of each place the count of its word, from a table of words; 0 for words that it lacks."""
        out = np.zeros(len(self.target))
        ends = np.array([w == END for w in words], dtype=bool)
        if ends.any():
            out[:] = c[ends][0]
            out[self.places] = 0
        if not ends.all():
            known = word_hashes([b" ".join(w for w in words if w != END)])[0]
            order = np.argsort(known)
            at = np.minimum(np.searchsorted(known[order], self.hashes), len(known) - 1)
            out[self.places] = np.where(known[order][at] == self.hashes, c[~ends][order][at], 0)
        return out


def logits(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Log probabilities of the classes at each place: a sparse sum of weight rows."""
    x = weights[features[:, 0]]
    for k in range(1, KINDS):
        x += weights[features[:, k]]
    x += weights[0]
    x -= x.max(axis=1, keepdims=True)
    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
    return x


def observed(block: Block, into: np.ndarray, keep: np.ndarray | slice = slice(None)) -> None:
    """Adds how often each feature and class occur together (in the places to keep)."""
    target, features = block.target[keep], block.features[keep]
    into[0] += np.bincount(target, minlength=CLASSES)
    for k in range(KINDS):
        low = 1 + k * BUCKETS
        cell = (features[:, k] - low) * CLASSES + target
        into[low : low + BUCKETS] += np.bincount(cell, minlength=BUCKETS * CLASSES).reshape(BUCKETS, CLASSES)


def expected(weights: np.ndarray, block: Block, into: np.ndarray, rows: int = 1 << 15) -> None:
    """Adds how often the model expects them to."""
    for at in range(0, len(block.target), rows):
        features = block.features[at : at + rows]
        p = np.exp(logits(weights, features))
        into[0] += p.sum(axis=0)
        by_class = np.ascontiguousarray(p.T, dtype=np.float64)
        for k in range(KINDS):
            low = 1 + k * BUCKETS
            own = (features[:, k] - low).astype(np.intp)
            for c in range(CLASSES):
                into[low : low + BUCKETS, c] += np.bincount(own, weights=by_class[c], minlength=BUCKETS)


def _joined(held: list[tuple[pa.RecordBatch, list[bytes]]]) -> tuple[list[bytes], pa.RecordBatch]:
    """The texts of a block, and its other columns in one piece."""
    others = [batch.drop_columns(["text"]) for batch, _ in held]
    return [t for _, some in held for t in some], pa.Table.from_batches(others).combine_chunks().to_batches()[0]


def _blocks(columns) -> Iterator[tuple[int, list[bytes], pa.RecordBatch]]:
    """The task's texts in blocks of about BLOCK_BYTES; numbers derive from the partition, so that every run cuts alike."""
    base, number, held, size = TaskContext.get().partitionId() << 24, 0, [], 0
    for batch, texts in batches(columns):
        begin = 0
        for i, text in enumerate(texts):
            size += len(text) + 1
            if size >= BLOCK_BYTES:
                held.append((batch.slice(begin, i + 1 - begin), texts[begin : i + 1]))
                yield base + number, *_joined(held)
                number, held, size, begin = number + 1, [], 0, i + 1
        if begin < len(texts):
            held.append((batch.slice(begin), texts[begin:]))
    if held:
        yield base + number, *_joined(held)


COUNTED = "block long, word binary, class int, n long, feature int, cells binary"


def _counted(columns):
    """For each block its words with their number in training texts; for the task, the observed cells of its training texts."""
    cells = np.zeros((FEATURES, CLASSES))
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    names = ["block", "word", "class", "n", "feature", "cells"]

    def row_batch(size, **given):
        return pa.RecordBatch.from_arrays([given[c] if c in given else pa.nulls(size, k) for c, k in zip(names, kinds, strict=True)], names=names)

    for number, texts, batch in _blocks(columns):
        train = batch.column("train").to_numpy(zero_copy_only=False)
        every = Block(texts)
        in_train = np.repeat(train, np.diff(every.bounds))
        n = np.bincount(every.ids[in_train], minlength=len(every.words))
        observed(every, cells, in_train)
        for at in range(0, len(n), 100_000):
            some = slice(at, at + 100_000)
            words = pa.array(every.words[some], pa.binary())
            yield row_batch(
                len(words), block=pa.array(np.full(len(words), number)), word=words, n=pa.array(n[some]), **{"class": pa.array(every.classes[some])}
            )
    used = np.flatnonzero(cells.any(axis=1))
    if len(used):
        yield row_batch(len(used), feature=pa.array(used.astype(np.int32)), cells=pa.array([c.astype("<f4").tobytes() for c in cells[used]], pa.binary()))


def _both(columns, weights):
    """Observed and expected cells of a task's texts, joined: one row for each feature that occurs."""
    cells, model = np.zeros((2, FEATURES, CLASSES)), weights.value
    for _, texts, _ in _blocks(columns):
        block = Block(texts, named=False)
        observed(block, cells[0])
        expected(model, block, cells[1])
    used = np.flatnonzero(cells[0].any(axis=1))
    if len(used):
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array([c.astype("<f4").tobytes() for c in np.concatenate([cells[0], cells[1]], axis=1)[used]], pa.binary())],
            names=["feature", "cells"],
        )


def _added(columns):
    """Sums the rows of a task by feature; used before and after the shuffle."""
    sums: dict[int, np.ndarray] = {}
    for batch in columns:
        for feature, cells in zip(batch.column("feature").to_pylist(), batch.column("cells").to_pylist(), strict=True):
            own = np.frombuffer(cells, "<f4").astype(np.float64)
            sums[feature] = sums[feature] + own if feature in sums else own
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([c.astype("<f4").tobytes() for c in sums.values()], pa.binary())], names=["feature", "cells"]
        )


def _gathered(rows: DataFrame, width: int) -> np.ndarray:
    """Sums of cells by feature: FEATURES rows at most come to the driver, however large the corpus."""
    summed = rows.repartition("feature").mapInArrow(_added, "feature int, cells binary").collect()
    out = np.zeros((FEATURES, width))
    for row in summed:
        out[row.feature] = np.frombuffer(row.cells, "<f4")
    return out


def _first_weights(cells: np.ndarray) -> np.ndarray:
    """The constant holds the classes' log frequencies, each context half of what it alone says beyond them."""
    total = cells[0] + 0.5
    share = total / total.sum()
    seen = cells[1:].sum(axis=1, keepdims=True)
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    weights[0] = np.log(share)
    weights[1:] = 0.5 * (np.log((cells[1:] + 4 * share) / (seen + 4)) - np.log(share))
    return weights


def _answers(key, docs: pd.DataFrame, known: pd.DataFrame, weights, classes, totals) -> pd.DataFrame:
    """Scores of one block's documents, from its texts and the counts of its words."""
    block = Block(docs["text"].tolist(), named=False)
    c = block.counts(known["word"].tolist(), known["c"].to_numpy(dtype=np.float64))
    n, v = totals
    base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    own = classes.value[block.target]
    inside = np.log10((c + 0.5) / (own[:, 0] + 0.5 * (own[:, 1] + 1)))
    model, outside = weights.value, np.empty(len(block.target))
    for at in range(0, len(block.target), 1 << 14):
        p = logits(model, block.features[at : at + (1 << 14)])
        outside[at : at + (1 << 14)] = p[np.arange(len(p)), block.target[at : at + (1 << 14)]] / np.log(10)
    sums = [np.add.reduceat(x, block.bounds[:-1]) for x in ((c > 0).astype(np.int64), base, inside + outside)]
    return pd.DataFrame(
        {"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": np.diff(block.bounds), "n_known": sums[0], "base_score": sums[1], "score": sums[2]}
    )


def _cut(columns):
    """The documents with their block, as in counting."""
    for number, texts, batch in _blocks(columns):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(texts), number)), batch.column("doc_id"), batch.column("held_out"), pa.array(texts, pa.binary())], names=["block", "doc_id", "held_out", "text"]
        )


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, out: int = 1, updates: int = 3, rate: float = 0.5) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs.

    Tokens: lower-cased (A-Z) words and one end. P(token) = P(class | the two words before) * P(token | class). The class
    is chosen by a maximum-entropy model with three hashed features: the word before, the word before that (a skip), and both.
    Within a class a token has its add-half share of the class's training tokens, unseen tokens of a class being one more,
    so that the probabilities of a class sum to 1. score is the log10 probability of the whole text.

    Word counts are of all training texts, exact: blocks of texts send their different words, and get back the counts of
    these. Weights start from the observed counts of all training texts and then take `updates` gradient steps; in
    each, every task sends what it observed and what the model expects in its share of the training texts (shares are
    drawn by hash, together they are all texts), a step divides the difference by the larger of both. The weights, 3 MB,
    and sums of a fixed size are all that comes to the driver.

    Null or empty text: the end alone. A null id: fold 0, hence learned from. Repeated rows: each counted and scored.
    Without training texts every count is 0. No rows: none.
    """
    spark = docs.sparkSession
    work = Work(spark)
    held = (fold(docs[id_col], folds) == out).alias("held_out")
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    source = replayed(docs.select(docs[id_col].cast("long").alias("doc_id"), held, text, (fold(docs[id_col], folds) != out).alias("train")), work)
    counted = work.save(source.mapInArrow(_counted, COUNTED))
    by_word = "partition by word"
    words = work.save(
        counted.where("word is not null").selectExpr("block", "word", "class", f"sum(n) over ({by_word}) as c", f"min(block) over ({by_word}) = block as once").where("c > 0")
    )
    sizes = {r["class"]: (r.n, r.v) for r in words.where("once").groupBy("class").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    classes = np.array([sizes.get(k, (0, 0)) for k in range(CLASSES)], dtype=np.float64)
    n, v = (int(x) for x in classes.sum(axis=0))

    weights = _first_weights(_gathered(counted.where("feature is not null").select("feature", "cells"), CLASSES))
    work.drop(counted)
    share = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(max(updates, 1)))
    for step in range(updates):
        part = source.where(F.col("train") & (share == step)).select("text", "doc_id")
        cells = _gathered(part.mapInArrow(partial(_both, weights=spark.sparkContext.broadcast(weights)), "feature int, cells binary"), 2 * CLASSES)
        seen, meant = cells[:, :CLASSES], cells[:, CLASSES:]
        weights = (weights + rate / (1 + step) * (seen - meant) / (np.maximum(seen, meant) + 4)).astype(np.float32)

    score = partial(
        _answers, weights=spark.sparkContext.broadcast(weights), classes=spark.sparkContext.broadcast(classes), totals=(n, v)
    )
    texts = source.mapInArrow(_cut, "block long, doc_id long, held_out boolean, text binary")
    known = words.select("block", "word", "c")

    def answer(key, left, right):
        return score(key, left, right)

    scored = texts.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(
        answer, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
