"""Interaction of filters: what each order of them removes, read from decision diagrams of failure masks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiltext.llm.common import Work

WORD = r"[^\x20\x09-\x0D]+"
#: Orders grow with the factorial of the filters; 7 make 5,040 orders of a part.
MOST_FILTERS = 7
#: What a diagram counts at each node.
WEIGHTS = ("rows", "good", "toxic")


def short_text(text: Column) -> Column:
    """Under 100 words."""
    return F.regexp_count(text, F.lit(WORD)) < 100


def repetitive(text: Column) -> Column:
    """Fewer than 80 different words per 100."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.transform(F.array(words), lambda w: 100 * F.size(F.array_distinct(w)) < 80 * F.size(w))[0]


def shouting(text: Column) -> Column:
    """More than 10 capitals (A-Z) per 100 code points."""
    return 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text)


def symbols(text: Column) -> Column:
    """Any of # $ % & * | in it."""
    return text.rlike(r"[#$%&*|]")


FILTERS: Mapping[str, Callable[[Column], Column]] = {"A": short_text, "B": repetitive, "C": shouting, "D": symbols}


class Diagram:
    """A decision diagram over failure masks whose nodes carry counts.

    Every path tests all filters, in the diagram's order; equal subgraphs are one node. A node is (low, high): the masks
    that pass its filter and those that fail it; below the last filter stand tuples of counts. The weight of a node is
    the sum below it, so that the path on which all filters pass has, at each step, what an order keeps and what it removes.
    """

    def __init__(self, masks: Mapping[int, tuple[int, ...]], filters: int):
        self.order = list(range(filters))
        self.nodes: dict[tuple, tuple] = {}
        self.weights: dict[int, tuple[int, ...]] = {}
        self.none = self._leaf((0,) * len(WEIGHTS))
        leaves = {m: self._leaf(tuple(w)) for m, w in masks.items()}
        self.root = self._built(leaves, 0, 0)

    def _leaf(self, counts: tuple[int, ...]) -> tuple:
        node = self.nodes.setdefault(("leaf", counts), ("leaf", counts))
        self.weights[id(node)] = counts
        return node

    def _node(self, low: tuple, high: tuple) -> tuple:
        key = (id(low), id(high))
        if key not in self.nodes:
            self.nodes[key] = node = (low, high)
            self.weights[id(node)] = tuple(a + b for a, b in zip(self.weights[id(low)], self.weights[id(high)], strict=True))
        return self.nodes[key]

    def _built(self, leaves: Mapping[int, tuple], mask: int, level: int) -> tuple:
        if level == len(self.order):
            return leaves.get(mask, self.none)
        return self._node(self._built(leaves, mask, level + 1), self._built(leaves, mask | 1 << level, level + 1))

    def weight(self, node: tuple) -> tuple[int, ...]:
        return self.weights[id(node)]

    def swap(self, level: int) -> None:
        """Exchanges the filters at this level and the next one; nodes above are made anew, those below stay."""

        def turned(node: tuple) -> tuple:
            (a, b), (c, d) = node
            return self._node(self._node(a, c), self._node(b, d))

        def rebuilt(node: tuple, at: int, done: dict) -> tuple:
            if id(node) not in done:
                done[id(node)] = turned(node) if at == level else self._node(*(rebuilt(x, at + 1, done) for x in node))
            return done[id(node)]

        self.root = rebuilt(self.root, 0, {})
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Along the path on which all pass: the filter, the weight kept, the weight removed."""
        node = self.root
        for f in self.order:
            low, high = node
            yield f, self.weight(low), self.weight(high)
            node = low

    def failing(self) -> list[int]:
        """Rows that fail each filter, whatever else they fail."""
        out = [0] * len(self.order)
        reached = {id(self.root): (self.root, 1)}
        for f in self.order:
            below: dict[int, tuple[tuple, int]] = {}
            for node, times in reached.values():
                out[f] += times * self.weight(node[1])[0]
                for x in node:
                    below[id(x)] = (x, below.get(id(x), (x, 0))[1] + times)
            reached = below
        return out

    def alone(self) -> list[int]:
        """Rows that fail each filter and no other one: its high edge, all else low."""
        out, spine = [0] * len(self.order), self.root
        for level, f in enumerate(self.order):
            node = spine[1]
            for _ in self.order[level + 1 :]:
                node = node[0]
            out[f], spine = self.weight(node)[0], spine[0]
        return out


def swaps(n: int) -> list[int]:
    """Levels whose exchanges, one after the other, bring n filters into all their orders, each once (plain changes)."""
    if n < 2:
        return []
    inner, out = swaps(n - 1), []
    for turn in range(factorial(n - 1)):
        down = turn % 2 == 0
        out += range(n - 2, -1, -1) if down else range(n - 1)
        if turn < len(inner):
            out.append(inner[turn] + (1 if down else 0))
    return out


def audited(masks: Mapping[int, tuple[int, ...]], letters: list[str]) -> list[tuple]:
    """filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley of all orders and steps."""
    diagram = Diagram(masks, len(letters))
    failing, alone = diagram.failing(), diagram.alone()
    rows, shapley = [], [0] * len(letters)
    for level in [None, *swaps(len(letters))]:
        if level is not None:
            diagram.swap(level)
        order = "".join(letters[f] for f in diagram.order)
        for step, (f, kept, gone) in enumerate(diagram.steps(), 1):
            shapley[f] += gone[0]
            rows.append((order, step, kept[0], gone[0], failing[f] - gone[0], alone[f], gone[1], gone[2], f))
    return [(*r[:-1], shapley[r[-1]]) for r in rows]


def failure_masks(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Callable[[Column], Column]] = FILTERS,
    duplicates: str | None = "E",
    part_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """part, mask (bit i: the i-th filter fails; the last one: duplicates) and how many rows, good rows and toxic rows have it."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    fails = [F.shiftleft(F.coalesce(f(text), F.lit(False)).cast("int"), i) for i, f in enumerate(filters.values())]
    mask = F.lit(0)
    for bit in fails:
        mask = mask + bit
    seen = docs.select(
        docs[id_col].alias("id"),
        F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
        mask.alias("mask"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    # repeated rows are counted before they are dealt by id; a row without id has no label, its salt spreads such rows
    salt = F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)).alias("salt")
    each = seen.groupBy("id", "digest", "part", "mask").agg(F.count("*").alias("n")).select("*", salt)
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    named = each.join(marks.withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left").na.fill(0, ["good", "toxic"])
    groups = named.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"),
    )
    if duplicates is None:
        parted = groups.select("part", "mask", "good", "toxic", "n")
    else:
        firsts = groups.groupBy("digest").agg(F.min("least.id").alias("first"))
        at_first = F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
        kept = groups.join(firsts, "digest").withColumn("unlike", F.coalesce(at_first, F.lit(0)) + F.col("nameless"))
        both = F.array(
            F.struct("mask", F.col("unlike").alias("n")),
            F.struct((F.col("mask") + F.lit(1 << len(filters))).alias("mask"), (F.col("n") - F.col("unlike")).alias("n")),
        )
        parted = kept.select("part", "good", "toxic", F.inline(both)).where("n > 0")
    counts = [F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")]
    return parted.groupBy("part", "mask").agg(*counts)


AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Callable[[Column], Column]] = FILTERS,
    duplicates: str | None = "E",
    part_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per part, order of the filters and step, with what that step keeps, removes and repeats (AUDIT).

    filters: a letter and the condition under which a text fails, each a column function; `duplicates` names one more
    that a row fails if a row of a smaller id has the identical text, in any part, removed or not (None: no such filter).
    Rows become counts per part and failure mask in Spark; a part has at most 2^filters of them, whatever its size, and
    its decision diagram is built in a task of its own. Orders follow each other by one exchange of adjacent levels.

    Null text: an empty one. Null part: the empty string. A null id: no label, never a duplicate and none's original; rows
    of equal id and text are no duplicates of each other. Of an id's several labels any 1 counts; null labels are 0.
    No rows: none. Columns of any other name do not matter.
    """
    letters = [*filters, *([duplicates] if duplicates else [])]
    if not 0 < len(letters) <= MOST_FILTERS or len(set("".join(letters))) != len("".join(letters)) or any(len(x) != 1 for x in letters):
        raise ValueError(f"filters: 1 to {MOST_FILTERS} different letters")
    work = Work(docs.sparkSession)
    masks = work.save(failure_masks(docs, labels, filters, duplicates, part_col, id_col, text_col))

    def one_part(frame: pd.DataFrame) -> pd.DataFrame:
        counts = zip(frame["rows"], frame["good"], frame["toxic"], strict=True)
        known = {int(m): tuple(int(x) for x in c) for m, c in zip(frame["mask"], counts, strict=True)}
        names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
        out = pd.DataFrame(audited(known, letters), columns=names)
        out.insert(0, "part", np.repeat(frame["part"].iloc[0], len(out)))
        return out

    return masks.groupBy("part").applyInPandas(one_part, AUDIT)
