"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, exact similarity of bags of shingles."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiltext.llm.common import Work, batches, keyed, replayed, shingle_hashes, word_hashes

SHINGLE = 5
#: Fingerprints of 64 bits in 8 blocks: within RADIUS, some block differs in at most one bit.
BLOCKS, RADIUS = 8, 15
#: Text bytes of the items that one pass over the documents looks for; more items take more passes.
PASS_BYTES = 8 << 20


def _shingles(words: list[bytes], k: int) -> list[tuple[bytes, ...]]:
    return list(zip(*(words[i:] for i in range(k)), strict=False))


def weighted_jaccard(a: Counter, b: Counter, weight: dict) -> float:
    """Shared over joint weight of two bags of shingles; a shingle without a weight weighs 1."""
    keys = a.keys() | b.keys()
    joint = sum(weight.get(s, 1.0) * max(a[s], b[s]) for s in keys)
    return sum(weight.get(s, 1.0) * min(a[s], b[s]) for s in a.keys() & b.keys()) / joint if joint else 0.0


def _sums(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weighted signs of each bit, summed up to each place."""
    signs = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64) * 2 - 1
    sums = np.zeros((len(hashes) + 1, 64))
    np.cumsum(signs * weights[:, None], axis=0, out=sums[1:])
    return sums


def _prints(sums: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of `size` shingles from these places: the sign of each bit's sum."""
    return np.packbits(sums[begin + size] - sums[begin] > 1e-9, axis=1, bitorder="little").view(np.uint64)[:, 0]


def _fingerprints(hashes: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every window of `size` shingles."""
    return _prints(_sums(hashes, weights), np.arange(len(hashes) - size + 1), size)


class Items:
    """Benchmark items by length, with postings of their shingles.

    rarity: a shingle weighs one over the number of items that hold it, else 1. `frequency` has that number, where it is
    not 1, for shingles (words joined by blanks) over a benchmark of which these are a part.
    """

    def __init__(self, rows: list[tuple[int | None, bytes]], rarity: bool = True, frequency: dict[bytes, int] | None = None):
        self.ids, self.words, self.bags = [], [], []
        self.by_size: dict[tuple[int, int], list[int]] = defaultdict(list)
        counted: Counter = Counter()
        for item_id, text in rows:
            words = text.lower().split()
            if not words:
                continue
            k = min(SHINGLE, len(words))
            bag = Counter(_shingles(words, k))
            counted.update(bag.keys())
            self.by_size[k, len(words)].append(len(self.ids))
            self.ids.append(item_id)
            self.words.append(words)
            self.bags.append(bag)
        if not rarity:
            self.weight = {}
        elif frequency is not None:
            self.weight = {s: 1 / frequency.get(b" ".join(s), 1) for s in counted}
        else:
            self.weight = {s: 1 / n for s, n in counted.items()}  # text that many items share says less
        self.hashed: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.postings: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.keys_of: list[np.ndarray] = [np.zeros(0, np.int64)] * len(self.ids)
        self.mass = np.array([sum(self.weight.get(s, 1.0) * n for s, n in bag.items()) for bag in self.bags])
        for k in {k for k, _ in self.by_size}:
            found: dict[int, float] = {}
            for words, bag in zip(self.words, self.bags, strict=True):
                if min(SHINGLE, len(words)) == k:
                    found.update(zip(self._hashes(words, k).tolist(), (self.weight.get(s, 1.0) for s in _shingles(words, k)), strict=True))
            keys = np.array(sorted(found), dtype=np.uint64)
            seen = np.zeros(1 << 20, dtype=bool)
            seen[(keys >> np.uint64(44)).astype(np.int64)] = True
            self.hashed[k] = keys, np.array([found[x] for x in keys.tolist()]), seen
            self._post(k)

    def _post(self, k: int) -> None:
        """For each shingle of k words the items that hold it, with its weight there, repeats included."""
        keys, weight, _ = self.hashed[k]
        key, holder, weighed = [], [], []
        for item, words in enumerate(self.words):
            if min(SHINGLE, len(words)) == k:
                own, times = np.unique(np.searchsorted(keys, self._hashes(words, k)), return_counts=True)
                self.keys_of[item] = own
                key.append(own)
                holder.append(np.full(len(own), item))
                weighed.append(weight[own] * times)
        every = np.concatenate(key)
        order = np.argsort(every, kind="stable")
        self.postings[k] = np.concatenate(holder)[order], np.concatenate(weighed)[order], np.searchsorted(every[order], np.arange(len(keys) + 1))

    @cached_property
    def index(self) -> dict:
        """The index of the fingerprints' blocks for each size."""
        return {size: self._indexed(*size, items) for size, items in self.by_size.items()}

    @staticmethod
    def _hashes(words: list[bytes], k: int) -> np.ndarray:
        return shingle_hashes(word_hashes([b" ".join(words)])[0], k)

    def found(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are an item's, and their numbers among the items' shingles."""
        keys, _, seen = self.hashed[k]
        maybe = np.flatnonzero(seen[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(keys, hashes[maybe]), len(keys) - 1)
        same = keys[at] == hashes[maybe]
        return maybe[same], at[same]

    def weights(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each hash, and whether it is an item's."""
        out, hit = np.ones(len(hashes)), np.zeros(len(hashes), dtype=bool)
        at, key = self.found(hashes, k)
        out[at], hit[at] = self.hashed[k][1][key], True
        return out, hit

    def candidates(self, every: np.ndarray, k: int, similarity: float) -> set[tuple[int, int, int]]:
        """item, first place and number of the shingles of each window that can be similar to an item.

        The windows whose fingerprints are within RADIUS of an item's, all of which the blocks find; and, as a similar
        window's may lie further off, those that the postings say share enough.
        """
        return {*self.near_windows(every, k), *self.sharing(every, k, similarity)}

    def near_windows(self, every: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
        """item, first place and number of the shingles of each window within RADIUS of an item of its size that shares a shingle."""
        weights, hit = self.weights(every, k)
        sums, hits = _sums(every, weights), np.concatenate([[0], np.cumsum(hit)])
        for size in self.by_size:
            n = min(size[1] - k + 1, len(every))  # a shorter text is one window
            if size[0] != k or n < 1:
                continue
            begin = np.flatnonzero(hits[n:] > hits[:-n])
            if len(begin):
                at, item = self.near(size, _prints(sums, begin, n))
                yield from zip(item.tolist(), begin[at].tolist(), [n] * len(at), strict=True)

    def sharing(self, every: np.ndarray, k: int, similarity: float) -> Iterator[tuple[int, int, int]]:
        """item, first place and number of the shingles of each window that shares enough to be similar: all of them.

        Similar bags share `similarity` of the weight of the larger one at least, hence of the item's.
        """
        at, key = self.found(every, k)
        own = np.unique(key)
        holder, weighed, bounds = self.postings[k]
        count = bounds[own + 1] - bounds[own]
        listed = np.repeat(bounds[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        shared = np.bincount(holder[listed], weights=weighed[listed], minlength=len(self.ids))
        least = similarity * self.mass - 1e-9
        for item in np.flatnonzero((shared >= least) & (shared > 0)).tolist():
            n = min(len(self.words[item]) - k + 1, len(every))  # a shorter text is one window
            mine = np.isin(key, self.keys_of[item])
            total = np.zeros(len(every) + 1)
            total[at[mine] + 1] = self.hashed[k][1][key[mine]]
            total = np.cumsum(total)
            for begin in np.flatnonzero(total[n:] - total[:-n] >= least[item]).tolist():
                yield item, begin, n

    def _indexed(self, k: int, n_words: int, items: list[int]):
        """Fingerprints of the items of one length, and for each block and value the items within one bit of it."""
        prints = []
        for i in items:
            hashes = self._hashes(self.words[i], k)
            prints.append(_fingerprints(hashes, self.weights(hashes, k)[0], n_words - k + 1)[0])
        prints = np.array(prints, dtype=np.uint64)
        values = prints.view(np.uint8).reshape(-1, BLOCKS)
        near = values[:, :, None] ^ np.concatenate([[0], 1 << np.arange(8)]).astype(np.uint8)
        cell = (np.arange(BLOCKS)[None, :, None] * 256 + near).ravel()
        item = np.repeat(np.arange(len(items)), BLOCKS * 9)
        order = np.argsort(cell, kind="stable")
        return np.array(items), prints, item[order], np.searchsorted(cell[order], np.arange(BLOCKS * 256 + 1))

    def near(self, size: tuple[int, int], windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window numbers and items within RADIUS of each other: all of them, as some block then differs in a bit at most."""
        items, prints, listed, bounds = self.index[size]
        cells = (np.arange(BLOCKS) * 256 + windows.view(np.uint8).reshape(-1, BLOCKS)).ravel()
        count = bounds[cells + 1] - bounds[cells]
        begun = np.cumsum(count) - count
        at = np.repeat(bounds[cells] - begun, count) + np.arange(count.sum())
        pair = np.unique(np.repeat(np.arange(len(cells)) // BLOCKS, count) * len(items) + listed[at])
        window, item = pair // len(items), pair % len(items)
        close = np.bitwise_count(windows[window] ^ prints[item]) <= RADIUS
        return window[close], items[item[close]]


def _search(words: list[bytes], hashes: dict[int, np.ndarray], items: Items, similarity: float) -> list[tuple[int, int, int, float]]:
    """item, start_word, n_words, similarity: the best window of the text for each item that one matches."""
    best: dict[int, tuple[float, int, int]] = {}
    for k, every in hashes.items():
        for item, at, n in sorted(items.candidates(every, k, similarity)):
            n_words = n + k - 1
            value = weighted_jaccard(Counter(_shingles(words[at : at + n_words], k)), items.bags[item], items.weight)
            if value >= similarity and (item not in best or value > best[item][0]):
                best[item] = value, at, n_words
    return [(item, at, n_words, value) for item, (value, at, n_words) in sorted(best.items())]


def _matches(columns, items, similarity: float):
    items = items.value
    for batch, texts in batches(columns, most=2 << 20):
        words, first, _, _ = word_hashes(texts)
        docs = set()
        for k in items.hashed:
            last = first[1:] - k  # the last shingle that begins in a text
            every = shingle_hashes(words, k)
            at = np.flatnonzero(items.weights(every, k)[1])
            of = np.searchsorted(first, at, side="right") - 1
            docs.update(of[at <= last[of]].tolist())
        rows = []
        doc_ids = batch.column("doc_id")
        for doc in sorted(docs):
            own = words[first[doc] : first[doc + 1]]
            hashes = {k: shingle_hashes(own, k) for k in items.hashed}
            for item, at, n, value in _search(texts[doc].lower().split(), hashes, items, similarity):
                rows.append((doc_ids[doc].as_py(), items.ids[item], at, n, value))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "start_word", "n_words", "similarity"]
            )


def _item_shingles(columns):
    """The different shingles of each item, words joined by blanks."""
    for batch in columns:
        every = [{b" ".join(s) for s in _shingles(w, min(SHINGLE, len(w)))} for w in (t.as_py().encode().lower().split() for t in batch.column("text")) if w]
        yield pa.RecordBatch.from_arrays([pa.array([s for some in every for s in some], pa.binary())], names=["shingle"])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = 0.8,
    pass_bytes: int = PASS_BYTES,
    rarity: bool = True,
) -> DataFrame:
    """doc_id, item_id, start_word, n_words, similarity: each document's best window for each item it holds.

    Texts are lower-cased (A-Z) words. For each item the windows of its number of words whose SimHash of 5-word shingles
    (all words of a shorter item) is within RADIUS bits of the item's are found by blocks of the fingerprints, and
    compared by the Jaccard similarity of the bags of shingles. Of windows of similarity 0.8 one or two in a hundred lie
    beyond that radius: postings of the shingles name all that share enough to be similar, so that none is left out. With `rarity` a shingle of items weighs one over the
    number of items of the whole benchmark that hold it, and one of the document alone 1, so that a changed copy of an item like many
    others falls behind; without it, as in the query and the pipeline, all weigh the same. Documents are read where they
    lie; items go to the tasks in groups of about `pass_bytes` of text, one pass over the documents for each group,
    and the groups do not matter for the result. A text shorter than an item is one window.

    Equal item texts are one item with their smallest id. Null or empty texts and items without words match nothing; null ids
    are returned as null. Repeated rows: each returned. No rows on either side: none.
    """
    spark = docs.sparkSession
    work = Work(spark)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    items = benchmark.select(benchmark[item_col].cast("long").alias("item_id"), benchmark[item_text_col].cast("string").alias("text")).where("text is not null")
    items = items.groupBy("text").agg(F.min("item_id").alias("item_id"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).head().n or 0
    groups = max(1, -(-size // pass_bytes))
    shared = None
    if rarity and groups > 1:
        shared = work.save(items.mapInArrow(_item_shingles, "shingle binary").groupBy("shingle").count().where("count > 1"))
    out = None
    for group in range(groups):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(groups)) == group)
        frequency = None
        if shared is not None:
            frequency = {bytes(r.shingle): r["count"] for r in shared.join(part.mapInArrow(_item_shingles, "shingle binary").distinct(), "shingle").collect()}
        rows = part.collect()
        index = Items(sorted(((r.item_id, r.text.encode()) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])), rarity, frequency)
        found = texts.mapInArrow(
            partial(_matches, items=spark.sparkContext.broadcast(index), similarity=similarity), "doc_id long, item_id long, start_word long, n_words long, similarity double"
        )
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, with all their columns, that hold no benchmark item. Each row goes or stays by its own text,
    also one without an id or with an id that another row has."""
    work = Work(docs.sparkSession)
    names = [f"c{i}" for i in range(len(docs.columns))]
    source = replayed(docs.toDF(*names), work)
    rows = keyed(source, names[docs.columns.index(id_col)], names[docs.columns.index(text_col)])
    found = contaminated(rows, benchmark, "row_key", "text", **options)
    gone = work.save(found.select(F.col("doc_id").alias("row_key")).distinct())
    kept = source.withColumn("row_key", F.monotonically_increasing_id()).join(gone, "row_key", "left_anti")
    return kept.select(*names).toDF(*docs.columns)
