"""Filter interaction audit (13): every order and step against a plain count over rows."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHING, awkward
from veiltext.llm.op13_audit import Diagram, audited, filter_audit, swaps

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails_of(text):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]
    capitals = sum("A" <= c <= "Z" for c in text)
    tests = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * capitals > 10 * len(text), "D": any(c in "#$%&*|" for c in text)}
    return {x for x, bad in tests.items() if bad}


def brute(rows, labels, letters="ABCDE"):
    """rows: (doc_id, text, lang)."""
    first, good, toxic = {}, {}, {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    for d, q, x in labels:
        good[d], toxic[d] = good.get(d) or q == 1, toxic.get(d) or x == 1
    parts = {}
    for d, t, part in rows:
        bad = {x for x in fails_of(t or "") if x in letters}
        if "E" in letters and d is not None and d > first[t or ""]:
            bad.add("E")
        parts.setdefault(part or "", []).append((bad, bool(d is not None and good.get(d)), bool(d is not None and toxic.get(d))))
    out = set()
    for part, docs in parts.items():
        steps, shapley = [], dict.fromkeys(letters, 0)
        for order in permutations(letters):
            left = docs
            for k, f in enumerate(order, 1):
                gone, left = [x for x in left if f in x[0]], [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                redundant = sum(f in x[0] for x in docs) - len(gone)
                alone = sum(x[0] == {f} for x in docs)
                steps.append(("".join(order), k, len(left), len(gone), redundant, alone, sum(x[1] for x in gone), sum(x[2] for x in gone), f))
        out |= {(part, *s[:-1], shapley[s[-1]]) for s in steps}
    return out


def got(df):
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size = rng.choice([0, 3, 99, 100, 130])
        words = [f"w{rng.randrange(rng.choice([40, 5000]))}" for _ in range(size)]
        text = " ".join(words)
        if rng.random() < 0.3:
            text = text.upper()
        if rng.random() < 0.3:
            text += rng.choice("#$%&*|")
        if rows and rng.random() < 0.3:
            text = rng.choice(rows)[1]
        rows.append((i, rng.choice([text, None]) if not text else text, rng.choice(["en", "de", "", None])))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def marks(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_all_orders_against_counts(spark):
    rng = random.Random(2)
    rows = texts(1)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 200, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    want = brute(rows, labels)
    assert got(filter_audit(frame(spark, rows), marks(spark, labels))) == want
    assert len(want) == 3 * 600 and any(r[5] for r in want) and any(r[8] for r in want)


def test_repeated_rows_and_ids(spark):
    """Rows of one id and text are no copies of each other; a null id is never a copy and none's original."""
    rows = [(1, "a", "en"), (1, "a", "en"), (2, "a", "de"), (None, "a", "en"), (None, "b", "en"), (3, "b", "en"), (None, None, None)]
    want = brute(rows, [(1, 1, 0), (2, 0, 1)])
    assert got(filter_audit(frame(spark, rows), marks(spark, [(1, 1, 0), (2, 0, 1)]))) == want


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark).withColumn("lang", F.lit("x"))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert set(CLASHING) <= set(docs.columns)
    assert got(filter_audit(docs, marks(spark, []))) == brute(rows, [])
    assert filter_audit(frame(spark, []), marks(spark, [])).collect() == []


def test_own_filters(spark):
    rows = texts(5, 60)
    odd = {"A": lambda t: F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")) < 100, "X": lambda t: F.lit(None).cast("boolean")}
    out = filter_audit(frame(spark, rows), marks(spark, []), odd, duplicates=None)
    assert {r.filter_order for r in out.collect()} == {"AX", "XA"}
    a = {(r.part, r.filter_order): r.removed for r in out.where("substr(filter_order, step, 1) = 'A'").collect()}
    assert all(a[p, "AX"] == a[p, "XA"] == sum("A" in fails_of(t or "") for _, t, l in rows if (l or "") == p) for p, _ in a)
    assert out.where("substr(filter_order, step, 1) = 'X' and removed + redundant + shapley > 0").count() == 0
    for wrong in ({}, {"AB": odd["A"]}, dict.fromkeys("ABCDEFGH", odd["A"])):
        with pytest.raises(ValueError):
            filter_audit(frame(spark, rows), marks(spark, []), wrong, duplicates=None)


def test_swaps_reach_every_order_once():
    for n in range(1, 6):
        order, seen = list(range(n)), set()
        for level in [None, *swaps(n)]:
            if level is not None:
                order[level], order[level + 1] = order[level + 1], order[level]
            seen.add(tuple(order))
        assert len(seen) == len(swaps(n)) + 1 == len(list(permutations(range(n))))


def test_diagram_shares_equal_subgraphs_and_keeps_counts_under_swaps():
    masks = {m: (5, 1, 0) for m in range(8)}
    diagram = Diagram(masks, 3)
    assert len(diagram.nodes) == 5  # the empty leaf, one leaf, and one node for each filter
    diagram.swap(0)
    diagram.swap(1)
    assert diagram.order == [1, 2, 0] and diagram.weight(diagram.root) == (40, 8, 0)
    assert [r[3] for r in audited(masks, list("ABC"))[:3]] == [20, 10, 5]
