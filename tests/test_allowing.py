"""Allowlists that are tables: the same spans stay as under a policy that holds the lists, whatever the plan above."""

import random
import re

import pytest
from pyspark.sql import functions as F

from veiltext.functions.literals import folded, folded_text, required_literal
from veiltext.operators import allowing as W
from veiltext.plans import channels as C
from veiltext.sources.policies import policy_from
from veiltext.sources.texts import texts_from

PLAIN = policy_from({})


def texts_of(spark, n=3000, parts=16):
    df = spark.range(n, numPartitions=parts).select(
        F.col("id"),
        F.concat(F.lit("mail a"), F.col("id") % 400, F.lit("@x.org or b"), F.col("id"), F.lit("@y.org, ZIP 1"), F.lpad((F.col("id") % 50).cast("string"), 4, "0")).alias("body"),
        F.repeat(F.lit("wide "), 300).alias("wide"),
    )
    empty = spark.range(5).select((F.col("id") + n).alias("id"), F.lit("nothing here").alias("body"), F.lit(None).cast("string").alias("wide"))
    return texts_from(df.union(empty), text="body", record_id=F.col("id").cast("string"), channel="outbound", session_id="wide", seq="id")


def lists(spark):
    values = spark.createDataFrame([(f" A{i}@X.org ",) for i in range(0, 400, 2)] + [(None,), (" ",), ("a7@x.org",)], "value string")
    by_label = spark.createDataFrame([("zip", "10003"), ("PHONE", "10004"), (None, "10005"), ("zip", None)], "label string, value string")
    patterns = spark.createDataFrame([(r"B\d*[05]@y\.org",), ("",), (None,), ("(a+)+",), ("[",), ("b1",), (r"\w+9@y.org",)], "pattern string")
    return W.AllowTables(values, by_label, patterns)


def expected(n=3000):
    out = {}
    for i in range(n):
        kept = []
        if not (i % 400 % 2 == 0 or i % 400 == 7):
            kept.append(f"a{i % 400}@x.org")
        if not (i % 5 == 0 or i % 10 == 9):
            kept.append(f"b{i}@y.org")
        if i % 50 != 3:
            kept.append(f"1{i % 50:04}")
        if kept:
            out[str(i)] = kept
    return out


def spans(df):
    return {r.record_id: [e.text for e in r.entities] for r in df.collect()}


@pytest.mark.parametrize("in_place", [0, 2000])
def test_same_spans_in_place_and_by_tables(spark, monkeypatch, in_place):
    monkeypatch.setattr(W, "IN_PLACE", max(in_place, 1))
    texts = texts_of(spark)
    got = spans(C.outbound_redact(texts, PLAIN, allow=lists(spark)))
    assert got == expected()
    every = C.outbound_redact(texts, PLAIN, changed_only=False, allow=lists(spark))
    assert every.count() == 3005 and set(every.columns) == set(C.outbound_redact(texts, PLAIN).columns)


@pytest.mark.parametrize("above", ["distinct", "repartition", "join"])
def test_no_value_slips_through_when_branches_are_dealt_differently(spark, monkeypatch, above):
    """Shuffles above, small advisory sizes, and a wide column that only one branch carries."""
    monkeypatch.setattr(W, "IN_PLACE", 1)
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        texts = texts_of(spark)
        if above == "distinct":
            texts = texts.dropDuplicates(["record_id"])
        elif above == "repartition":
            texts = texts.repartition(32, "record_id")
        else:
            texts = texts.join(spark.range(3005).select(F.col("id").cast("string").alias("record_id")), "record_id")
        assert spans(C.outbound_redact(texts, PLAIN, allow=lists(spark))) == expected()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_tables_of_nothing_and_streams(spark, monkeypatch, tmp_path):
    none = spark.createDataFrame([], "value string")
    texts = texts_of(spark, 40)
    want = spans(C.outbound_redact(texts, PLAIN))
    assert spans(C.outbound_redact(texts, PLAIN, allow=W.AllowTables(none, None, spark.createDataFrame([], "pattern string")))) == want
    assert spans(C.outbound_redact(texts, PLAIN, allow=W.AllowTables())) == want
    texts.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(texts.schema).parquet(str(tmp_path / "in"))
    allow = W.AllowTables(lists(spark).values)
    out = C.outbound_redact(stream, PLAIN, allow=allow)
    query = out.writeStream.format("memory").queryName("allowed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spans(spark.table("allowed")) == spans(C.outbound_redact(texts, PLAIN, allow=allow)) != want
    monkeypatch.setattr(W, "IN_PLACE", 1)
    with pytest.raises(ValueError):
        C.outbound_redact(stream, PLAIN, allow=allow)


def test_plan_of_pattern_tables_has_no_nested_loop(spark, monkeypatch):
    monkeypatch.setattr(W, "IN_PLACE", 1)
    patterns = spark.createDataFrame([(rf"b{i}@y\.org",) for i in range(3000)], "pattern string")
    out = C.outbound_redact(texts_of(spark), PLAIN, allow=W.AllowTables(patterns=patterns))
    plan = out._jdf.queryExecution().optimizedPlan().toString() + out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("NestedLoop|Cartesian|monotonically", plan)
    assert sum(t.startswith("b") for found in spans(out).values() for t in found) == 0


def test_drop_allowed_rows(spark):
    rows = spark.createDataFrame([("B15@y.org", "EMAIL"), ("a2@X.org", "EMAIL"), ("10003", "ZIP_CODE"), ("10003", "SSN"), (None, "SSN"), ("b1", "X"), ("xb1", "X")], "text string, label string")
    allow = lists(spark)
    kept = W.drop_allowed(rows, allow.values, allow.label_values, allow.patterns).collect()
    assert sorted(map(str, (r.text for r in kept))) == ["10003", "None", "xb1"]


PATTERNS = [
    (r"user\.17@corp\.example", "user.17@corp.example"), (r"a+bc", "bc"), (r"ab+c", "ab"), (r"abc?de", "ab"), (r"ab{2}cd", "ab"), (r"ab{0,3}cde", "cde"), ("abc|d", ""),
    (r"(?:abc|d)efg[xyz]+hi", "efg"), (r"\Qabc\E", ""), (r"(?x) a b", ""), (r"\d\d\dabc\x41Aq", "abc"), (r"[a-z&&[^b]]key_\p{L}", "key_"), (r"é\.abc", ".abc"), (r"\(ab\)", "(ab)"),
    (r"^abc$", "abc"), (r"(abc)\1de", "de"), ("", ""), (r"ab*+c+?d", "a"),
]


@pytest.mark.parametrize("pattern,literal", PATTERNS)
def test_required_literal(pattern, literal):
    assert required_literal(pattern) == literal


def test_every_match_holds_the_required_literal():
    rng = random.Random(1)
    units = ["a", "b", "c", r"\.", r"\d", "[ab]", "(?:ab|c)", "(bc)", "."]
    for _ in range(3000):
        pattern = "".join(rng.choice(units) + rng.choice(["", "", "", "+", "*", "?", "{2}", "{0,2}"]) for _ in range(rng.randrange(1, 7)))
        for _ in range(5):
            text = "".join(rng.choice("abc.1") for _ in range(12))
            found = re.search(pattern, text)
            assert not found or required_literal(pattern) in found.group()


def test_folded_text_keeps_what_a_caseless_search_finds(spark):
    odd = "sSſkKKiIİı"
    df = spark.createDataFrame([(f"x{c}y",) for c in odd], "t string")
    rows = df.select("t", folded_text(F.col("t")).alias("f"), *(F.rlike("t", F.lit(f"(?iu)x{c}y")).alias(c) for c in "ski")).collect()
    assert sum(r[c] for r in rows for c in "ski") >= 9
    assert all(folded(f"X{c}Y") in r.f for r in rows for c in "ski" if r[c])
