"""Policies, their effect on spans, and the channel jobs under them."""

import json

import pytest
from pyspark.sql import functions as F

from veiltext.functions.schema import ENTITIES, TEXTS
from veiltext.operators import audit as G
from veiltext.operators import lint as L
from veiltext.operators import ner as N
from veiltext.operators import policy as P
from veiltext.plans import channels as C
from veiltext.sources.policies import Policy, PolicyError, load_policy, policy_from, policy_tables


@pytest.mark.parametrize(
    "bad",
    [
        {"entityConfidenceThresholds": {"PERSON": 1.2}},
        {"entityConfidenceThresholds": {"PERSON": float("nan")}},
        {"entityConfidenceThresholds": {"PERSON": "0.5"}},
        {"allowlist": {"patterns": ["["]}},
        {"allowlist": {"patterns": ["x" * 513]}},
        {"allowlist": {"patterns": ["(a+)+"]}},
        {"allowlist": {"values": [1]}},
        {"allowlist": {"values": "a"}},
        {"guardrail_mode": "drop"},
        {"redactStrategy": "x"},
        {"entityActions": {"SSN": "drop"}},
        {"enabled": "yes"},
        {"auditEnabled": 1},
        {"maxPendingRequests": 0},
        {"maxPendingRequests": 1.5},
        {"confidence_threshold": -0.1},
        {"enabled": None},
        {"guardrail_mode": None},
        {"redactStrategy": None},
        {"maxPendingRequests": None},
        {"allowlist": {"patterns": ["(?P<y>a)"]}},
        {"allowlist": {"entities": {"ssn": None}}},
    ],
)
def test_bad_policies_are_refused(spark, bad):
    with pytest.raises(PolicyError):
        policy_from(bad)


def test_policy_follows_document_order_and_jvm_patterns(spark):
    for config in (
        '{"entityActions":{"ssn":"block","social_security_number":"warn"},"entityConfidenceThresholds":{"zip":0.1,"ZIP_CODE":0.9}}',
        '{"entityActions":{"social_security_number":"warn","ssn":"block"},"entityConfidenceThresholds":{"ZIP_CODE":0.9,"zip":0.1}}',
        '{"confidence_threshold":null,"allowlist":{"values":null,"patterns":["(?<y>[0-9]{4})","\\\\p{L}+"]}}',
    ):
        p = policy_from(json.loads(config))
        df = spark.createDataFrame([("t", config)], "policy_id string, config string")
        row = L.effective_policies(df).head()
        assert {e.label: e.value for e in row.entity_actions} == p.entity_actions
        assert {e.label: e.value for e in row.entity_thresholds} == p.entity_thresholds
        assert (row.confidence_threshold, tuple(row.allow_patterns)) == (p.confidence_threshold, p.allow_patterns)
        assert L.policy_lint(df).collect() == []


def test_policy_from_file(spark, tmp_path):
    path = tmp_path / "policy.json"
    path.write_text(
        '{"entityActions": {"person": "warn"}, "entityConfidenceThresholds": {"person": 0.6},'
        ' "allowlist": {"values": ["a", " a ", ""], "entities": {"person": ["john doe"]}}}'
    )
    p = load_policy(spark, str(path))
    assert p.entity_actions == {"PERSON": "warn"} and p.entity_thresholds == {"PERSON": 0.6}
    assert p.allow_values == ("a",) and p.allow_entities == {"PERSON": ("john doe",)}
    assert p.ner_floor == 0.5 and not p.blocks
    assert policy_tables(spark, p)["allow_label_value"].collect()[0].value == "john doe"
    path.write_text('{"allowlist": {"patterns": ["a(?P<x>b)"]}}')
    with pytest.raises(PolicyError):
        load_policy(spark, str(path))


def _allowed(spark, policy, *found):
    df = spark.createDataFrame([([(t, lab, 0, len(t), 1.0, "regex") for t, lab in found],)], f"es {ENTITIES}")
    return [x.text for x in df.select(P.drop_allowed_inline(F.col("es"), policy).alias("es")).head().es]


def test_allowlist(spark):
    p = policy_from(
        {"allowlist": {"values": ["John@Example.com"], "patterns": [r"test@example\.com", "example"], "entities": {"PERSON": ["john smith"]}}}
    )
    kept = _allowed(
        spark, p, ("john@example.com", "EMAIL"), (" JOHN@example.com ", "EMAIL"), ("test@example.com", "EMAIL"),
        ("xtest@example.com", "EMAIL"), ("John Smith", "PERSON"), ("John Smith", "ORGANIZATION"),
    )
    assert kept == ["xtest@example.com", "John Smith"]
    long_ = "a" * 520 + "@example.com"
    assert _allowed(spark, policy_from({"allowlist": {"patterns": [".*"]}}), (long_, "EMAIL"), ("a@b.com", "EMAIL")) == [long_]
    assert _allowed(spark, policy_from({"allowlist": {"patterns": [".*"], "values": [long_]}}), (long_, "EMAIL")) == []
    assert _allowed(spark, policy_from({"allowlist": {"patterns": ["a"]}}), ("a\n", "X")) == ["a\n"]


def _texts(spark, *texts):
    rows = [(f"r{i}", "inbound", "s", i, None, "tool", "chan", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, TEXTS)


def _ner(*found):
    return F.array(
        *[
            F.struct(
                F.lit(t).alias("text"), F.lit(lab).alias("label"), F.lit(s).alias("start_pos"),
                F.lit(n).alias("end_pos"), F.lit(c).alias("confidence"), F.lit("gliner").alias("source"),
            )
            for t, lab, s, n, c in found
        ]
    ).cast(ENTITIES)


def test_ner_merge_and_threshold(spark):
    df = _texts(spark, "My name is John Smith.").withColumn("ner", _ner(("John Smith", "PERSON", 11, 21, 0.95)))
    assert C.scan(df, Policy(), ner=True).head().entities[0].confidence == 0.95
    strict = policy_from({"entityConfidenceThresholds": {"person": 0.98}})
    assert C.scan(df, strict, ner=True).head().entities == []


def test_model_failures_leave_structured_spans(spark):
    def load():
        def model(texts, labels, floor):
            if any("boom" in t for t in texts):
                raise RuntimeError("boom")
            return [[{"spanText": "Joe", "text": "x", "label": "per", "score": 0.9, "start": 0, "end": 3}] for _ in texts]

        return model

    good = N.run_ner(_texts(spark, "Joe joe@x.org"), load, ["person"], Policy())
    row = C.scan(good, Policy(), ner=True).head()
    assert [(x.label, x.text) for x in row.entities] == [("PERSON", "Joe"), ("EMAIL", "joe@x.org")]
    bad = N.run_ner(_texts(spark, "boom joe@x.org"), load, ["person"], Policy())
    row = C.scan(bad, Policy(), ner=True).head()
    assert [x.label for x in row.entities] == ["EMAIL"] and "boom" in row.ner_error


def test_gate_and_notice(spark):
    df = _texts(spark, "My SSN is 123-45-6789.", "Hello there.", "")
    rows = {r.record_id: r for r in C.inbound_gate(df, policy_from({"guardrail_mode": "block"})).collect()}
    assert rows["r0"].outcome == "block" and "SSN" in rows["r0"].reason and "6789" not in str(rows["r0"])
    assert rows["r1"].outcome == "pass" and len(rows) == 2
    assert {r.outcome for r in C.inbound_gate(df, Policy()).collect()} == {"pass"}
    advised = C.inbound_advisory(_texts(spark, "Email me at john@example.com today."), Policy()).head()
    assert "[EMAIL_1]" in advised.notice and "john@" not in advised.notice


def test_every_action_is_redacted_on_the_way_out(spark):
    p = policy_from({"entityActions": {"SSN": "block", "EMAIL": "warn"}})
    df = _texts(spark, "SSN 123-45-6789, joe@x.org, secret=abcDEF123456 token: Bearer tok_1234567890", "clean")
    got = C.outbound_redact(df, p).collect()
    assert [r.redacted_text for r in got] == ["SSN [SSN_1], [EMAIL_1], [SECRET_1] [TOKEN_1]"]
    assert C.outbound_redact(df, p, changed_only=False).count() == 2
    off = policy_from({"enabled": False})
    assert C.outbound_redact(df, off).count() == 0
    assert [r.redacted_text for r in C.outbound_redact(df, off, changed_only=False).collect()][1] == "clean"


def test_tool_results_and_payloads(spark):
    m = '{"content":[{"type":"text","text":"clean"},{"type":"text","text":"SSN 123-45-6789"}],"id":7}'
    df = _texts(spark, "x").withColumn("message", F.lit(m)).drop("text")
    row = C.tool_result_redact(df, Policy(), message="message").head()
    assert row.message == '{"content":[{"type":"text","text":"clean"},{"type":"text","text":"SSN [SSN_1]"}],"id":7}'
    text = _texts(spark, "token=5551234567 ok")
    assert C.tool_result_redact(text, Policy()).head().redacted_text == "[TOKEN_1] ok"
    assert C.tool_result_redact(text, Policy(), overlap_mode="splice").head().redacted_text == "[TOKEN_1]ok"
    pay = F.struct(F.lit("Contact joe@x.org").alias("text"), F.lit("u").alias("mediaUrl"))
    row = C.reply_payload_redact(_texts(spark, "x").withColumn("payload", pay).drop("text"), Policy()).head()
    assert row.payload.text == "Contact [EMAIL_1]" and row.payload.mediaUrl == "u"


def test_reports(spark):
    df = _texts(spark, "Email me at jane.doe@example.com today.", "All clear.")
    rep = {r.record_id: r for r in C.redact_report(df, Policy()).drop("mapping", "entities").collect()}
    assert rep["r0"].placeholders == ["[EMAIL_1]"] and "jane" not in str(rep["r0"])
    scan = {r.record_id: r.summary for r in C.scan_report(df, Policy()).collect()}
    assert scan == {"r0": "Found 1 entities: EMAIL", "r1": "No entities detected"}
    warn = policy_from({"entityActions": {"EMAIL": "warn"}})
    pre = C.preview_report(df, warn, "hash").orderBy("record_id").first()
    assert pre.summary.warned == 1 and "jane.doe" in pre.redacted_text and pre.strategy == "hash"
    many = {(r.policy_id, r.record_id): r for r in C.preview_policies(df, {"w": warn, "p": Policy()}).collect()}
    assert "jane.doe" in many["w", "r0"].redacted_text and "[EMAIL_1]" in many["p", "r0"].redacted_text


def test_audit_holds_no_value(spark):
    df = _texts(spark, "SSN 123-45-6789 and joe@x.org", "clean")
    rows = G.audit_outbound(C.outbound_redact(df, Policy(), changed_only=False), Policy()).collect()
    assert len(rows) == 1 and rows[0].labels == ["SSN", "EMAIL"] and rows[0].source == "outbound"
    assert "6789" not in str(rows) and "joe" not in str(rows)
    off = policy_from({"auditEnabled": False})
    assert G.audit_outbound(C.outbound_redact(df, off), off).count() == 0


def test_lint_of_odd_policies(spark):
    bad = [
        ("a", "[1]"), ("b", '{"allowlist":{"values":"x","entities":{"PERSON":"y","ORG":[1,"z"]}}}'),
        ("c", '{"entityActions":[],"confidence_threshold":"0.5","maxPendingRequests":2.5,"redactStrategy":null}'), ("d", "{}"),
        ("e", '{"enabled":null,"guardrail_mode":null,"maxPendingRequests":null,"confidence_threshold":null,"allowlist":{"patterns":["(?P<y>a)","(?<y>a)"],"values":null}}'),
    ]
    df = spark.createDataFrame(bad, "policy_id string, config string")
    got = sorted((r.policy_id, r.path, r.rule) for r in L.policy_lint(df).collect())
    assert got == [
        ("a", "$", "not_json"),
        ("b", "allowlist.entities.ORG", "not_string"),
        ("b", "allowlist.entities.PERSON", "not_array"),
        ("b", "allowlist.values", "not_array"),
        ("c", "confidence_threshold", "not_number"),
        ("c", "entityActions", "not_object"),
        ("c", "maxPendingRequests", "not_positive_integer"),
        ("c", "redactStrategy", "bad_enum"),
        ("e", "allowlist.patterns", "invalid_regex"),
        ("e", "enabled", "not_boolean"),
        ("e", "guardrail_mode", "bad_enum"),
        ("e", "maxPendingRequests", "not_positive_integer"),
    ]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_channel_plans_search_once_and_never_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    _texts(spark, "x").write.parquet(path)
    src = spark.read.parquet(path)
    p = policy_from({"entityActions": {"SSN": "block"}, "allowlist": {"values": ["a"]}})
    jobs = {
        "outbound": C.outbound_redact(src, p),
        "gate": C.inbound_gate(src, p),
        "advisory": C.inbound_advisory(src, p),
        "preview": C.preview_policies(src, {"a": p, "b": Policy()}),
        "report": C.redact_report(src, p),
    }
    for name, df in jobs.items():
        plan = _plan(df)
        assert "Exchange" not in plan, name
        assert "Python" not in plan, name
        assert plan.count("regexp_replace(text") == 8, name
        assert "PushedFilters: [IsNotNull(text)" in plan or name in ("preview", "report"), name


def test_registered_detector_plans(spark):
    """The registered queries search each text once per rule, narrowly and on the JVM."""
    import __spark_entry__ as entry

    registered = entry.queries()
    for name in ("detect_email", "detect_phone", "detect_zip_code", "detect_structured", "allow_exact", "allow_pattern", "allow_label_value", "apply_allowlist"):
        plan = _plan(registered[name](spark, "/root/testdata/sf0.001"))
        assert "Exchange" not in plan and "Python" not in plan, name
        searches = plan.count("regexp_replace(text") / max(plan.count("FileScan"), 1)
        assert searches <= (8 if name.startswith("allow") or name in ("detect_structured", "apply_allowlist") else 1), (name, searches)


def test_a_model_is_asked_per_row(spark):
    """Rows that ask alike share a call; no list means the default labels and the policy's own, an empty one nothing."""
    import json

    def load():
        return lambda texts, labels, floor: [[{"text": json.dumps([len(texts), labels]), "label": "x", "score": 1.0, "start": 0, "end": 1}] for _ in texts]

    rows = [(1, "a", ["p"]), (2, "b", ["q", "r"]), (3, "c", ["p"]), (4, "d", None), (5, "e", []), (6, None, ["p"])]
    df = spark.createDataFrame(rows, "id int, text string, ask array<string>").coalesce(1)
    policy = policy_from({"custom_entities": ["badge", "person"]})
    assert policy.custom_entities == ("badge", "person")
    out = N.run_ner(df, load, F.col("ask"), policy)
    assert out.columns == ["id", "text", "ask", "ner_error", "ner"]
    got = {r.id: [json.loads(e.text) for e in r.ner] for r in out.collect()}
    assert got[1] == got[3] == [[2, ["p"]]] and got[2] == [[1, ["q", "r"]]] and got[5] == got[6] == []
    assert got[4][0][1][-1] == "badge" and got[4][0][1][0] == "person" and len(got[4][0][1]) == 9
    plain = {r.id: [json.loads(e.text) for e in r.ner] for r in N.run_ner(df, load, None, policy).collect()}
    assert plain[1] == plain[5] and plain[1][0][0] == 5 and plain[1][0][1] == got[4][0][1]
