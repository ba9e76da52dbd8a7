"""Hard negatives (11): cover trees and searches against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHING
from veiltext.llm import op11_negatives as N
from veiltext.llm.op11_negatives import Found, Searches, _indexed, augmented, cover_tree, hard_negatives, search

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, percent=(30, 90), positives=5, negatives=10):
    seen = set()
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        seen.add((i, tuple(math.floor(256 * float(np.float32(x))) for x in v), y))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a in sorted(x for x in seen if x[0] % every == 0):
        score = sorted((-dot(a[1], b[1]), b[0], b[2]) for b in seen if b[0] != a[0])
        for ps, pid, _ in [s for s in score if s[2] == a[2]][:positives]:
            window = [s for s in score if s[2] != a[2] and percent[0] * -ps <= 100 * -s[0] <= percent[1] * -ps]
            out += [(a[0], pid, k, s[1], -ps, -s[0]) for k, s in enumerate(window[:negatives], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def vectors(seed, n, d=8, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, d))
    which = rng.integers(centres, size=n)
    x = (middle[which] + 0.2 * rng.normal(size=(n, d))).astype(np.float32)
    return [(i, [float(c) for c in v], int(rng.integers(4)) if rng.random() < 0.5 else int(w) % 4) for i, (v, w) in enumerate(zip(x, which, strict=True))]


def test_many_blocks_and_passes_against_all_products(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 60)
    monkeypatch.setattr(N, "ANCHORS", 5)
    rows = vectors(1, 700)
    want = brute(rows, every=40)
    assert got(hard_negatives(frame(spark, rows), F.col("vec_id") % 40 == 0)) == want and len(want) > 300


def test_ties_copies_and_one_common_vector(spark, monkeypatch):
    """A third of the rows have one vector, many scores are equal, ids and rows are repeated."""
    monkeypatch.setattr(N, "BLOCK", 40)
    rng = random.Random(3)
    rows = [(i, [0.5, 0.25, 0.0] if i % 3 == 0 else [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(3)], rng.randrange(3)) for i in range(300)]
    rows += rng.choices(rows, k=30) + [(10, [0.5, 0.5, 0.5], 1), (10, [0.5, 0.5, 0.5], 2), (20, [1.0, 1.0, 1.0], 0)]
    want = brute(rows, every=10)
    assert got(hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0)) == want and want


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 0.5], 1), (1, [0.9, 0.4], 1), (2, [0.5, 0.1], 2), (3, None, 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 2),
        (7, [0.6, 0.0], None), (None, [1.0, 1.0], 1), (8, [0.5], 2), (9, [], 2), (100, [], 1), (200, [-1.0, -1.0], 1), (300, [1.0, 0.5], 7), (11, [1e-9, -1e-9], 2),
    ]
    df = frame(spark, rows).select("*", *(F.lit("x").alias(c) for c in [*CLASHING, "id", "q", "anchor", "w", "pivot"] if c != "label"))
    want = brute(rows)
    assert got(hard_negatives(df, F.col("vec_id") % 100 == 0)) == want and {r[0] for r in want} >= {0}


def test_no_rows_no_anchors_and_too_long(spark):
    anchors = F.col("vec_id") % 100 == 0
    assert got(hard_negatives(frame(spark, []), anchors)) == []
    assert got(hard_negatives(frame(spark, [(1, [1.0], 1)]), anchors)) == []
    assert got(hard_negatives(frame(spark, [(0, [1.0], 1)]), anchors)) == []
    large = [(0, [30000.0] * 4, 1), (1, [20000.0] * 4, 1), (2, [15000.0] * 4, 2), (3, [500000.0, 1.0, 0.0, 0.0], 2), (4, [250000.0, 3.0, 0.0, 0.0], 1)]
    assert got(hard_negatives(frame(spark, large), anchors)) == brute(large)
    with pytest.raises(ValueError):
        hard_negatives(frame(spark, [(0, [3e30], 1)]), anchors)


def test_cover_tree():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=4) * 40 + rng.normal(size=(k, 4)) for k in (300, 40, 5, 1)] + [np.ones((80, 4))])
    order, (centre, radius, begin, end, parent) = cover_tree(x)
    y = x[order]
    assert sorted(order) == list(range(len(x))) and (begin[0], end[0], parent[0]) == (0, len(x), -1)
    for k in range(len(centre)):
        assert np.linalg.norm(y[begin[k] : end[k]] - y[centre[k]], axis=1).max() <= radius[k] + 1e-6
        below = np.flatnonzero(parent == k)
        if len(below):
            assert [*begin[below], end[k]] == [begin[k], *end[below]] and radius[below].max() <= radius[k] / N.SHRINK + 1e-6
    assert len(centre) > 10 and (parent[1:] < np.arange(1, len(centre))).all()


def test_leaves_outside_the_windows_are_skipped(monkeypatch):
    """Of many far clusters only those are multiplied whose bounds meet a window."""
    import pyarrow as pa

    rng = np.random.default_rng(9)
    x = np.concatenate([np.round(rng.normal(size=6) * 300 + rng.normal(size=(60, 6)) * 3) for _ in range(40)]).astype(np.int64)
    labels = rng.integers(2, size=len(x))
    square = float((x.astype(float) ** 2).sum(axis=1).max())
    table = pa.table({"id": np.arange(len(x)), "label": labels, "q": pa.array(x.tolist(), pa.list_(pa.int64()))})
    row = _indexed(table, square).to_pylist()[0]
    at = np.array([0, 700, 1500])
    scores = x[at] @ x.T
    high = np.array([np.quantile(s, 0.9) for s in scores]).astype(np.int64)
    low = high - 2000
    s = Searches(x[at].astype(np.float64), at, labels[at], np.arange(3), low, high, False, 10)
    found = Found(s)
    monkeypatch.setattr(N, "CELLS", 64 * 3)
    search(row, s, square, found)
    for w in range(3):
        fit = [(-scores[w, i], i) for i in range(len(x)) if labels[i] != labels[at[w]] and low[w] <= scores[w, i] <= high[w]]
        assert [(-a, b) for a, b in sorted(fit)[:10]] == list(zip(found.score[found.window == w], found.id[found.window == w], strict=True))
    nodes, _, sizes = N._leaves(row, np.frombuffer(row["vectors"], "<i4").reshape(len(x), -1), s, np.linalg.norm(x[at].astype(float), axis=1), square, Found(s))
    assert 0 < sizes.sum() < len(x) // 2
    assert augmented(x, square).shape == (len(x), 7)
