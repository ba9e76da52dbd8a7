"""Hard negatives of anchors: exact searches in cover trees over norm-augmented vectors, block by block."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veiltext.llm.common import Work

#: Rows of a block, about. A pivot's rows are dealt to as many blocks as they need.
BLOCK = 2048
#: The most rows drawn as centres of the first level; the bound of what is collected and sent for them.
PIVOTS = 256
#: Anchors of a pass over the index, about: the bound of what the driver holds and sends at a time.
ANCHORS = 4096
#: A child's covering radius is at most its parent's divided by this; nodes of so few rows are leaves.
SHRINK, LEAF = 1.3, 32
#: Scores of a block that are compared with windows at a time.
CELLS = 4_000_000
#: Below this product of norms a float64 holds every sum of a score exactly; beyond the other a score may exceed a long.
EXACT, TOO_LONG = 2.0**53, 2.0**62

INDEX = "ids binary, labels binary, vectors binary, size int, centre array<int>, radius array<double>, begin array<int>, end array<int>, parent array<int>"


def cover_tree(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """An order of the rows of x, and centre, radius, begin, end and parent of the nodes, level by level.

    A node covers the rows begin to end of that order within its radius around its centre. Its children's centres are
    its own and, one after the other, the row farthest from all so far, until each row is within radius / SHRINK of one.
    Where that takes a quarter of the rows, no smaller ball holds several rows, and the node stays a leaf.
    """
    square = np.einsum("ij,ij->i", x, x)
    order = np.arange(len(x))
    near = np.sqrt(np.maximum(square + square[0] - 2 * (x @ x[0]), 0))
    nodes = [(0, float(near.max(initial=0)), 0, len(x), -1)]
    at = 0
    while at < len(nodes):
        centre, radius, begin, end, _ = nodes[at]
        rows = order[begin:end]
        if len(rows) > LEAF and radius > 0:
            own, part = x[rows], square[rows]

            def distance(c: int, own=own, part=part) -> np.ndarray:
                return np.sqrt(np.maximum(part + square[c] - 2 * (own @ x[c]), 0))

            dist, owner, centres = distance(centre), np.zeros(len(rows), np.int64), [centre]
            while len(centres) <= len(rows) // 4 and dist.max() > radius / SHRINK:
                centres.append(rows[int(dist.argmax())])
                d = distance(centres[-1])
                closer = d < dist
                owner[closer], dist[closer] = len(centres) - 1, d[closer]
            if dist.max() <= radius / SHRINK:
                by = np.argsort(owner, kind="stable")
                order[begin:end] = rows[by]
                edges = begin + np.searchsorted(owner[by], np.arange(len(centres) + 1))
                for k, c in enumerate(centres):
                    nodes.append((int(c), float(dist[owner == k].max(initial=0)), int(edges[k]), int(edges[k + 1]), at))
        at += 1
    place = np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    columns = [np.array(c) for c in zip(*nodes, strict=True)]
    columns[0] = place[columns[0]]
    return order, columns


def augmented(x: np.ndarray, square: float) -> np.ndarray:
    """x with one more component, so that all rows have this squared norm: the nearest to an anchor then has the largest product."""
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(square - np.einsum("ij,ij->i", x, x), 0))])


def _indexed(table: pa.Table, square: float) -> pa.Table:
    """One row of the index from the rows of a block."""
    table = table.sort_by([("id", "ascending"), ("label", "ascending")])
    ids, labels = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False).astype("<i8") for c in ("id", "label"))
    x = table.column("q").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    order, nodes = cover_tree(augmented(x, square))
    arrays = [ids[order].tobytes(), labels[order].tobytes(), x[order].astype("<i4").tobytes(), len(ids), *(c.tolist() for c in nodes)]
    names = [c.split()[0] for c in INDEX.split(", ")]
    types = [pa.binary()] * 3 + [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()), *[pa.list_(pa.int32())] * 3]
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(arrays, types, strict=True)], names=names)


@dataclass
class Searches:
    """What a pass looks for: anchors, and windows (anchor, least and largest score) over rows of the anchor's label or of others."""

    vectors: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    most: int


class Found:
    """The first `most` rows of each window so far: window, score, id, in this order."""

    def __init__(self, searches: Searches):
        self.s = searches
        self.window, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = searches.low.copy()  # a row must reach this score; at the same score have a smaller id than this
        self.before = np.full(len(searches.low), np.iinfo(np.int64).max)

    def add(self, window: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        window, score, ident = (np.concatenate(c) for c in ((self.window, window), (self.score, score), (self.id, ident)))
        order = np.lexsort((ident, -score, window))
        window = window[order]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        kept = order[rank < self.s.most]
        full = order[rank == self.s.most - 1]
        self.window, self.score, self.id = window[rank < self.s.most], score[kept], ident[kept]
        full_windows = window[rank == self.s.most - 1]
        self.least[full_windows], self.before[full_windows] = score[full], ident[full]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor the least and the largest score that any of its windows still takes."""
        low, high = (np.full(len(self.s.ids), v, np.float64) for v in (np.inf, -np.inf))
        np.minimum.at(low, self.s.anchor, self.least)
        np.maximum.at(high, self.s.anchor, self.s.high)
        return low, high


def _leaves(row: dict, x: np.ndarray, s: Searches, norms: np.ndarray, square: float, found: Found) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaves that windows may need, by their largest bound: node, and for each anchor the bounds of a score in it.

    Level by level: a node's radius bounds the scores of its rows both through the anchor's norm and through the distance
    between the anchor and the centre in the augmented space; children are looked at only where the parent's bounds meet a window.
    """
    centre, radius, parent = (np.array(row[c]) for c in ("centre", "radius", "parent"))
    inner = np.zeros(len(centre), bool)
    inner[parent[1:]] = True
    low, high = found.anchors()
    level, alive = np.array([0]), np.ones((len(s.ids), 1), bool)
    out = []
    while len(level):
        score = s.vectors.astype(np.float64) @ x[centre[level]].astype(np.float64).T
        r, far = radius[level], np.sqrt(np.maximum((norms**2 + square)[:, None] - 2 * score, 0))
        slack = 1 + 1e-9 * norms[:, None] * np.sqrt(square)
        most = score + np.minimum(norms[:, None] * r, np.where(far > r, far * r - r * r / 2, np.inf)) + slack
        least = score - np.minimum(norms[:, None] * r, far * r + r * r / 2) - slack
        alive &= (most >= low[:, None]) & (least <= high[:, None])
        used = alive.any(axis=0)
        ends = used & ~inner[level]
        out.append((level[ends], np.where(alive, most, -np.inf)[:, ends]))
        above = level[used & inner[level]]
        column = np.full(len(centre), -1)
        column[level] = np.arange(len(level))
        level = np.flatnonzero(np.isin(parent, above) & (parent >= 0))
        alive = alive[:, column[parent[level]]]
    nodes, bounds = np.concatenate([n for n, _ in out]), np.concatenate([b for _, b in out], axis=1)
    order = np.argsort(-bounds.max(axis=0, initial=-np.inf), kind="stable")
    return nodes[order], bounds[:, order], np.array([row["end"][n] - row["begin"][n] for n in nodes[order]], np.int64)


def search(row: dict, s: Searches, square: float, found: Found) -> None:
    """Adds to `found` what a block has for the windows: best leaves first, only for anchors whose bounds still reach a window."""
    n, d = row["size"], s.vectors.shape[1]
    ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
    x = np.frombuffer(row["vectors"], "<i4").reshape(n, d)
    kind = s.vectors.dtype
    norms = np.sqrt(np.einsum("ij,ij->i", s.vectors.astype(np.float64), s.vectors.astype(np.float64)))
    nodes, bounds, sizes = _leaves(row, x, s, norms, square, found)
    step = max(1, CELLS // max(1, len(s.low)))
    at = 0
    while at < len(nodes):
        upto = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), step, side="right")))
        low, _ = found.anchors()
        wanted = (bounds[:, at:upto] >= low[:, None]).any(axis=1)
        chosen = np.flatnonzero(wanted[s.anchor])
        points = np.concatenate([np.arange(row["begin"][k], row["end"][k]) for k in nodes[at:upto]])
        at = upto
        for p in np.split(points, range(step, len(points), step)) if len(chosen) else ():
            who, back = np.unique(s.anchor[chosen], return_inverse=True)
            score = (s.vectors[who] @ x[p].astype(kind).T).astype(np.int64)
            fits = (labels[p] == s.labels[who][:, None]) == s.same
            fits &= ids[p] != s.ids[who][:, None]
            score, fits = score[back], fits[back]
            least = found.least[chosen][:, None]
            fits &= (score > least) | ((score == least) & (ids[p] < found.before[chosen][:, None]))
            fits &= score <= s.high[chosen][:, None]
            w, k = np.nonzero(fits)
            if len(w):
                found.add(chosen[w], score[w, k], ids[p][k])


def _searched(index: DataFrame, s: Searches, square: float) -> DataFrame:
    """w, score, id, rank: the first rows of each window over all blocks. Each task keeps `most` rows a window."""
    sent = index.sparkSession.sparkContext.broadcast(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Found(sent.value)
        for batch in batches:
            for k in range(batch.num_rows):
                search(batch.slice(k, 1).to_pylist()[0], sent.value, square, found)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (found.window, found.score, found.id)], names=["w", "score", "id"])

    best = Window.partitionBy("w").orderBy(F.desc("score"), "id")
    rows = index.mapInArrow(run, "w long, score long, id long")
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= s.most)


def quantised(rows: DataFrame, id_col: str, vector_col: str, label: Column, anchors: Column, scale: int) -> DataFrame:
    """id, label, q, anchor of the rows that take part, identical ones once; q: floor(scale * x) of each component x."""
    vector = rows[vector_col]
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    taken = rows.where(rows[id_col].isNotNull() & label.isNotNull() & vector.isNotNull() & whole)
    q = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return taken.select(rows[id_col].cast("long").alias("id"), label.cast("long").alias("label"), q.alias("q"), F.coalesce(anchors, F.lit(False)).alias("anchor")).distinct()


def cover_index(table: DataFrame, square: float, count: int, work: Work) -> DataFrame:
    """A saved table of one row per block (INDEX) from id, label, q of equal lengths.

    Pivots, the first level, are at most PIVOTS rows drawn by a hash of the id; each row goes to the nearest one in the
    augmented space, and a pivot's rows, however many, are dealt by hash to blocks of about BLOCK rows.
    """
    drawn = table.orderBy(F.xxhash64("id"), "id", "label", "q").limit(max(1, min(PIVOTS, count // BLOCK))).collect()
    pivots = augmented(np.array([r.q for r in drawn], np.int64), square)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("q").flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, pivots.shape[1] - 1))
            nearest = np.argmax(augmented(x, square) @ pivots.T, axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "label", "q")), pa.array(nearest)], names=["id", "label", "q", "pivot"])

    rows = work.save(table.select("id", "label", "q").mapInArrow(assigned, "id long, label long, q array<long>, pivot int"))
    parts = {r.pivot: -(-r["count"] // BLOCK) for r in rows.groupBy("pivot").count().collect()}
    several = F.create_map(*(F.lit(v) for kv in parts.items() for v in kv))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id", "q"), several[F.col("pivot")]))
    return work.save(dealt.groupBy("pivot", "part").applyInArrow(lambda t: _indexed(t, square), INDEX))


NEGATIVES = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 10,
    percent: tuple[int, int] = (30, 90),
    scale: int = 256,
) -> DataFrame:
    """For each anchor and each of its positives the first `negatives` rows of other labels in the positive's window (NEGATIVES).

    A score is the integer inner product with the anchor of floor(scale * x); higher scores come first, ties by smaller id.
    An anchor's positives are its first `positives` other rows of its label; a negative's score is between the two shares
    (in percent) of the positive's. Fewer rows: all of them. Every row is indexed and each pass of about ANCHORS anchors is
    compared with all blocks; scores are exact, bounds of the tree only skip what no window can take.

    Rows with a null id, label, vector or component, or with a component that is not finite, take no part. Identical rows
    count once; rows of the anchor's own id are neither its positives nor its negatives. Shorter vectors are filled up with
    zeros. A positive with a negative score has an empty window. No rows or no anchors: none. Vectors so long that
    a score may exceed a long are refused. Columns of any other name do not matter.
    """
    work = Work(rows.sparkSession)
    label = F.col(label) if isinstance(label, str) else label
    table = work.save(quantised(rows, id_col, vector_col, label, anchors, scale))
    norm = F.aggregate("q", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    size = table.agg(F.count("*").alias("n"), F.max(norm).alias("square"), F.max(F.size("q")).alias("d"), F.count_if("anchor").alias("anchors")).head()
    if not size.anchors:
        return rows.sparkSession.createDataFrame([], NEGATIVES)
    if size.square >= TOO_LONG:
        raise ValueError("vectors too long: an inner product may exceed a long")
    d = max(1, size.d)
    table = table.withColumn("q", F.concat("q", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("q"))))
    index = cover_index(table, size.square, size.n, work)
    groups = -(-size.anchors // ANCHORS)
    chosen = work.save(table.where("anchor").select("id", "label", "q", F.pmod(F.xxhash64("id", "q"), F.lit(groups)).alias("g")))
    kind = np.float64 if size.square < EXACT else np.int64
    out = []
    for g in range(groups):
        here = chosen.where(F.col("g") == g).orderBy("id", "label", "q").collect()
        if not here:
            continue
        vectors = np.array([r.q for r in here], np.int64).astype(kind)
        own = (vectors, np.array([r.id for r in here]), np.array([r.label for r in here]))
        end = np.iinfo(np.int64)
        first = Searches(*own, np.arange(len(here)), np.full(len(here), end.min), np.full(len(here), end.max), True, positives)
        pairs = sorted((r.w, r.rank, r.id, r.score) for r in _searched(index, first, size.square).collect())
        low, high = [-((-percent[0] * p[3]) // 100) for p in pairs], [percent[1] * p[3] // 100 for p in pairs]
        open_ = [k for k in range(len(pairs)) if low[k] <= high[k]]
        if not open_:
            continue
        anchor = np.array([pairs[k][0] for k in open_])
        second = Searches(*own, anchor, np.array([low[k] for k in open_]), np.array([high[k] for k in open_]), False, negatives)
        names = rows.sparkSession.createDataFrame([(w, here[pairs[k][0]].id, pairs[k][2], pairs[k][3]) for w, k in enumerate(open_)], "w long, anchor_id long, positive_id long, positive_score long")
        found = _searched(index, second, size.square).join(F.broadcast(names), "w")
        out.append(work.save(found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))))
    if not out:
        return rows.sparkSession.createDataFrame([], NEGATIVES)
    whole = out[0]
    for more in out[1:]:
        whole = whole.union(more)
    return whole
