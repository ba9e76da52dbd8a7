"""Detectors of the user's: rules as rows, next to the fixed ones."""

import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from veiltext.functions.detect import Detector, detect_custom, detect_structured
from veiltext.plans import channels as C
from veiltext.sources.detectors import load_detectors
from veiltext.sources.policies import PolicyError, policy_from
from veiltext.sources.texts import texts_from

RULES = [("BADGE", r"B-[0-9]{3}"), ("BADGE", r"b+"), ("CODE", r"(?i)KEY[a-c]+"), ("NAME", r"\bAnn|Bo\b"), ("CODE", r"[0-9]{3}"), ("ODD", r"(x)\1+\.")]


def rows(spark, rules, ranked=True):
    data = [(k, *r) for k, r in enumerate(rules)]
    df = spark.createDataFrame(data, "rank int, label string, pattern string")
    return df if ranked else df.drop("rank")


def expected(text, rules):
    found = []
    for k, (label, pattern) in enumerate(rules):
        found += [(m.start(), m.end(), k, label, m.group()) for m in re.finditer(pattern, text) if m.group()]
    return [(s, e, label, t) for s, e, _, label, t in sorted(found)]


def test_spans_of_random_texts(spark):
    rng = random.Random(4)
    pieces = ["B-123", "b", "keyAB", "KEYc", "Ann", "Bo", "777", "xxx.", "x.", " ", "é", "\U0001f600", "￿", "\n", "B-12"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(300)]
    detectors = load_detectors(rows(spark, RULES))
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", detect_custom("text", detectors).alias("es"))
    for r in df.collect():
        assert [(e.start_pos, e.end_pos, e.label, e.text) for e in r.es] == expected(r.text, RULES), r.text


def test_order_among_the_fixed_rules(spark):
    """Of equal spans the structured ones come first, then the user's by rank."""
    text = "mail joe@x.org or 555-010-9999"
    rules = (Detector("OTHER", r"joe@x\.org"), Detector("EMAIL", r"joe"), Detector("EXT", r"555-010-9999"))
    df = spark.createDataFrame([(text, ["x"])], "text string, other array<string>")
    es = df.select(detect_structured("text", rules).alias("es")).head().es
    assert [(e.label, e.text) for e in es] == [("EMAIL", "joe"), ("EMAIL", "joe@x.org"), ("OTHER", "joe@x.org"), ("PHONE", "555-010-9999"), ("EXT", "555-010-9999")]
    assert df.select(detect_structured("text", ()).alias("es")).head().es == [e for e in es if e.label in ("EMAIL", "PHONE") and e.text != "joe"]


def test_jobs_honour_detectors(spark):
    texts = texts_from(spark.createDataFrame([("r", "badge B-123, key 9")], "id string, body string"), text="body", record_id="id", channel="outbound")
    policy = replace(policy_from({"allowlist": {"values": ["b-124"]}, "entityActions": {"BADGE": "block"}}), detectors=load_detectors(rows(spark, RULES[:1])))
    assert C.outbound_redact(texts, policy).head().redacted_text == "badge [BADGE_1], key 9"
    assert C.inbound_gate(texts, policy).head().outcome == "block"
    both = C.preview_policies(texts, {"with": policy, "without": policy_from({})}).collect()
    assert {r.policy_id: r.redacted_text for r in both} == {"with": "badge B-123, key 9", "without": "badge B-123, key 9"}
    assert {r.policy_id: r.summary.total for r in both} == {"with": 1, "without": 0}
    assert C.outbound_redact(texts, replace(policy, detectors=())).count() == 0


def test_rules_are_read_in_order_and_checked(spark):
    assert load_detectors(rows(spark, [(" zip ", "b"), ("per", "a")])) == (Detector("ZIP_CODE", "b"), Detector("PERSON", "a"))
    assert load_detectors(rows(spark, [("b", "y"), ("b", "x"), ("a", "z"), ("a", "z")], ranked=False)) == (Detector("A", "z"), Detector("B", "x"), Detector("B", "y"))
    assert load_detectors(rows(spark, [])) == ()
    for label, pattern in [(None, "a"), (" ", "a"), ("A", None), ("A", ""), ("A", "["), ("A", "(a+)+"), ("A", "(?:a|b)*"), ("A", "b?"), ("A", r"\b"), ("A", "x" * 513)]:
        with pytest.raises(PolicyError):
            load_detectors(rows(spark, [("B", "b"), (label, pattern)]))
    with pytest.raises(PolicyError):
        load_detectors(rows(spark, [("B", f"b{i}") for i in range(201)]))


def test_one_search_for_each_rule_and_only_where_its_literal_is(spark):
    detectors = (Detector("A", r"needle-\w+"), Detector("B", r"(?i)straw\d"))
    df = C.fence(spark.createDataFrame([("a",)], "text string"), "es", detect_custom("text", detectors)).filter(F.size("es") > 0)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    for d in detectors:
        assert plan.count(f"regexp_replace(text#") >= 2 and plan.count(f", {d.pattern}, ") <= 3  # one way with the mark in the text (two calls), one without
    assert "Contains(text" in plan.replace("contains(text", "Contains(text") and not re.search("Python|Exchange", plan)


def test_null_empty_and_long_texts(spark):
    detectors = (Detector("A", r"ab+c"), Detector("B", "[0-9]+"))
    long = "abbc 1 " * 60_000
    df = spark.createDataFrame([(1, None), (2, ""), (3, long)], "i int, text string").select("i", detect_custom("text", detectors).alias("es"))
    got = {r.i: r.es for r in df.collect()}
    assert not got[1] and got[2] == [] and len(got[3]) == 120_000
    assert (got[3][-1].start_pos, got[3][-1].text) == (len(long) - 2, "1")
