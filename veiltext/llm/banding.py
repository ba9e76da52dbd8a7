"""Components of items that meet in bands and are verified by exact Jaccard similarity."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiltext.llm.common import Work
from veiltext.llm.components import components

#: 64-bit words of the sketch of a set.
WORDS = 8
#: Items of a band up to which its pairs are few: so many are compared by their sets if their marks are alike.
CROWD = 8
#: Parts of the crowded bands that are compared one after the other, so that the disk holds what is shuffled for one of them.
PARTS = 2


class May(NamedTuple):
    """What tells of two nodes whether they may be similar: marks (node and more columns), and a test on the marks of two."""

    marks: DataFrame
    alike: Callable[[Callable[[str], Column], Callable[[str], Column]], Column]

    def of(self, side: str) -> Callable[[str], Column]:
        return lambda name: F.col(f"{name}_{side}")

    def side(self, rows: DataFrame, node: str, side: str) -> DataFrame:
        """rows with the marks of their node, named name_side."""
        own = self.marks.select(F.col("node").alias(node), *(F.col(c).alias(f"{c}_{side}") for c in self.marks.columns if c != "node"))
        return rows.join(own, node)

    def __call__(self, rows: DataFrame, a: str, b: str) -> DataFrame:
        """The rows whose two nodes may be similar."""
        both = self.side(self.side(rows, a, "a"), b, "b")
        return both.where(self.alike(self.of("a"), self.of("b"))).select(*rows.columns)


def bands_for(similarity: float, rows: int, recall: float) -> int:
    """The least number of bands of `rows` minima that find a pair of this similarity with this probability."""
    bands = 1
    while 1 - (1 - similarity**rows) ** bands < recall:
        bands += 1
    return bands


def meetings(items: DataFrame, work: Work, passes: int = 1) -> DataFrame:
    """band, node, head of the items (node, bands) in bands of two and more; head is the band's smallest node.

    A band's key must tell its place in `bands`, if there are several passes: each of them shuffles a part of the places.
    """
    met = []
    for k in range(passes):
        own = F.filter("bands", lambda _, place: place % passes == k) if passes > 1 else F.col("bands")
        bands = items.select("node", F.explode(own).alias("band")).repartition("band")  # one shuffle for both sides
        heads = bands.groupBy("band").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head <> last").select("band", "head")
        met.append(work.save(bands.join(heads, "band").select("band", "node", "head")))
    return reduce(DataFrame.union, met)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A sketch of WORDS longs for each set of different 64-bit hashes: whether it has an odd number of each class of them."""
    size = 64 * WORDS
    out = np.zeros((len(sets), WORDS), np.int64)
    for begin in range(0, len(sets), 1024):
        part = sets[begin : begin + 1024]
        classes = np.concatenate(part).view(np.uint64) % np.uint64(size)
        place = np.repeat(np.arange(len(part)) * size, [len(x) for x in part]) + classes.astype(np.int64)
        odd = (np.bincount(place, minlength=len(part) * size) & 1).astype(np.uint8).reshape(len(part), size)
        out[begin : begin + len(part)] = np.packbits(odd, axis=1, bitorder="little").view(np.int64)
    return out


def _room(a: str, b: str, n: Column, m: Column, similarity: float) -> Column:
    """Whether two sketches leave room for a similarity of the sets. Each bit in which they differ stands for a hash that one set
    alone has, so no similar pair fails; the small number is for rounding."""
    differ = reduce(Column.__add__, (F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(WORDS)))
    return differ <= (n + m) * ((1 - similarity) / (1 + similarity)) + 1e-6


def _close(a: str, b: str, similarity: float, room: tuple[str, str] | None = None) -> Column:
    """Whether two sets are similar; their sketches (columns `room`) and their sizes are looked at first, and the hashes once."""
    n, m = F.size(a), F.size(b)
    least = F.floor((n + m) * (similarity / (1 + similarity)))
    enough = lambda shared: shared >= similarity * (n + m - shared)
    need = F.when(enough(least), least).when(enough(least + 1), least + 1).otherwise(least + 2)
    shared = F.size(F.array_intersect(a, b))
    may = (F.least(n, m) >= similarity * F.greatest(n, m)) & (shared >= need)
    return _room(*room, n, m, similarity) & may if room else may


def _kept_close(similarity: float) -> Callable[[DataFrame, str, str], DataFrame]:
    return lambda rows, a, b: rows.where(_close(a, b, similarity))


def _relabelled(rows: DataFrame, links: DataFrame, work: Work) -> DataFrame:
    """rows with their labels replaced by those of the components that the links (a, b) between labels make; the links are dropped."""
    found = components(links, work).select(F.col("node").alias("label"), F.col("label").alias("new"))
    new = work.save(rows.join(found, "label", "left").withColumn("label", F.coalesce("new", "label")).drop("new"))
    work.drop(found, links)
    return new


def _undecided(rows: DataFrame) -> DataFrame:
    """The rows of the bands that still hold several labels."""
    several = rows.groupBy("band").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most").select("band")
    return rows.join(several, "band")


def _alike(rows: DataFrame, may: May) -> DataFrame:
    """a, b, node_a, node_b: nodes of different labels in one band that may be similar. The marks are looked at inside the
    join, so that pairs which only meet are never rows."""
    left, right = (may.side(rows.select(F.col("band").alias(f"band_{x}"), F.col("label").alias(x), F.col("node").alias(f"node_{x}")), f"node_{x}", x) for x in "ab")
    apart = (F.col("band_a") == F.col("band_b")) & (F.col("a") < F.col("b")) & may.alike(may.of("a"), may.of("b"))
    return left.join(right, apart).select("a", "b", "node_a", "node_b")


def _apart(rows: DataFrame, near: Callable[[str, str], Column] = lambda a, b: F.lit(True)) -> DataFrame:
    """Two rows of a band with different labels a < b, their other columns named name_a and name_b, for which `near` holds inside the join."""
    left, right = (rows.select(F.col("label").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in rows.columns if c != "label")) for x in "ab")
    return left.join(right, (F.col("band_a") == F.col("band_b")) & (F.col("a") < F.col("b")) & near("a", "b"))


def _near(rows: DataFrame, similarity: float) -> DataFrame:
    """a, b of the pairs of similar sets in a band (band, label, set, sketch); pairs that are not similar are never rows."""
    return _apart(rows, lambda a, b: _close(f"set_{a}", f"set_{b}", similarity, (f"sketch_{a}", f"sketch_{b}"))).select("a", "b")


def similar(
    met: DataFrame,
    sets: DataFrame,
    work: Work,
    similarity: float,
    rounds: int = 2,
    close: Callable[[DataFrame, str, str], DataFrame] | None = None,
    may: May | None = None,
    crowded: Callable[[DataFrame], May] | None = None,
) -> DataFrame:
    """node, label: the component of every item that has a similar other item.

    met: from meetings(). sets: node, set (an array of different hashes, or what `close` compares instead: it keeps the rows
    of a table whose two columns are similar) of its nodes, and perhaps sketch, from sketches(), which spares pairs that only meet the comparison of their
    sets; `may` keeps those whose two nodes may be, before sets are joined. In a band all items are first compared with its smallest one, which is one row each; what then lies in one component needs no more comparing.
    In the bands that still hold several components all items are compared with one drawn by hash, `rounds` times,
    and at last all pairs of items of different components with each other, so that no pair is left out. In bands of more
    than CROWD items this is done by what `crowded` gives for their nodes, a sharper test of pairs than `may`, whose marks
    are a table of `work` and dropped here. What passes a test is written before sets are joined, so that the disk does not hold
    what is shuffled for both, and a table is dropped when nothing reads it any more. Labels are kept without the sets, which are
    joined for the comparisons alone and travel with the rows of a band, not with its pairs.
    """
    close = close or _kept_close(similarity)
    sketched, wide_sets = "sketch" in sets.columns, sets
    sets = sets.select("node", "set")
    own = sets.withColumnRenamed("set", "own")
    heads = sets.select(F.col("node").alias("head"), F.col("set").alias("other"))
    pairs = met.where("node <> head").select("node", "head").distinct()
    pairs = work.save(may(pairs, "node", "head")) if may else pairs
    first = work.save(close(pairs.join(own, "node").join(heads, "head"), "own", "other").select(F.col("head").alias("a"), F.col("node").alias("b")))
    if may:
        work.drop(pairs)
    start = met.select("node").distinct().withColumn("label", F.col("node"))
    labels = _relabelled(start, first, work)
    rest = work.save(_undecided(met.select("band", "node").join(labels, "node")))
    for turn in range(rounds + 1):
        written = []
        if not rest.limit(1).count():
            break
        if turn < rounds:
            drawn = rest.groupBy("band").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("by"), "node", F.col("label").alias("other_label"))).alias("h"))
            drawn = drawn.select("band", F.col("h.node").alias("head"), "h.other_label")
            rows = rest.join(drawn, "band").where("label <> other_label").select("node", "label", "head", "other_label").distinct()
            if may:
                rows = work.save(may(rows, "node", "head"))
                written = [rows]
            links = close(rows.join(sets, "node").join(heads, "head"), "set", "other").select(F.least("label", "other_label").alias("a"), F.greatest("label", "other_label").alias("b"))
        elif may:
            several = rest.groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("band")
            many = work.save(rest.join(several, "band")) if crowded else None
            few = rest.join(many.select("band").distinct(), "band", "left_anti") if crowded else rest
            rows = _alike(few, may).distinct()
            if crowded:
                sharp, found = crowded(many.select("node").distinct()), [work.save(rows)]
                found += [work.save(_alike(many.where(F.pmod(F.xxhash64("band"), F.lit(PARTS)) == k), sharp)) for k in range(PARTS)]
                work.drop(many, sharp.marks)
                rows = work.save(reduce(DataFrame.union, found).distinct())
                work.drop(*found)
                written = [rows]
            first, second = (sets.select(F.col("node").alias(f"node_{x}"), F.col("set").alias(f"set_{x}")) for x in "ab")
            links = close(rows.join(first, "node_a").join(second, "node_b"), "set_a", "set_b").select("a", "b")
        else:
            links = _near(rest.join(wide_sets, "node"), similarity) if sketched else close(_apart(rest.join(sets, "node")), "set_a", "set_b").select("a", "b")
        links = work.save(links.distinct())
        work.drop(*written)
        if links.limit(1).count():
            was, labels = labels, _relabelled(labels, links, work)
            work.drop(was)
            if turn < rounds:
                was, rest = rest, work.save(_undecided(rest.drop("label").join(labels, "node")))
                work.drop(was)
    if crowded:
        work.drop(rest)
    changed = labels.where("label <> node")
    return changed.select("node", "label").union(changed.select(F.col("label").alias("node"), "label").distinct())
