"""The registered queries: one or more per operator, each over whole tables, with its SQL twin."""

from __future__ import annotations

from dataclasses import replace as changed

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiltext.functions.detect import detect, detect_custom, detect_structured
from veiltext.functions.labels import canonical_label, ner_labels
from veiltext.functions.messages import extract_text, replace_text
from veiltext.functions.overlap import resolve_overlaps
from veiltext.functions.patterns import LABELS
from veiltext.functions.redact import redact
from veiltext.operators import allowing as W
from veiltext.operators import audit as G
from veiltext.operators import mapping as M
from veiltext.operators import ner as N
from veiltext.operators import policy as P
from veiltext.operators import requests as R
from veiltext.plans import channels as C
from veiltext.sources.detectors import load_detectors
from veiltext.sources.policies import MAX_SUBJECT_CHARS
from veiltext.sources.texts import union_texts

from . import corpus as X
from .corpus import PLAIN, POLICY, corpus
from .oracle_parts import (
    ACTION,
    ALLOWED,
    CONFIDENT,
    CORPUS,
    CUSTOM,
    NER_TABLE,
    custom_spans,
    found,
    full,
    label_spans,
    labels_of,
    q,
    replaced,
    resolved,
    structured,
)

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def long(c):
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def names(c):
    return F.array_join(c, ", ")


def spans_of(df: DataFrame, entities="entities") -> DataFrame:
    """One row per span, with plain columns."""
    return df.select("record_id", F.inline(entities)).select(
        "record_id",
        "label",
        long("start_pos").alias("start_pos"),
        long("end_pos").alias("end_pos"),
        F.col("text").alias("span_text"),
        "confidence",
    )


SPAN_COLUMNS = "record_id, label, start_pos, end_pos, txt AS span_text, conf AS confidence"


# --- A: sources and messages -------------------------------------------------


@query(
    "texts_from",
    f"WITH {CORPUS} SELECT record_id, channel, session_id, seq, floor(epoch(ts))::BIGINT AS at, tool_name, channel_id, text FROM corpus",
)
def texts_from(spark, sf_dir):
    return corpus(spark, sf_dir).select(
        "record_id", "channel", "session_id", "seq", F.unix_timestamp("ts").alias("at"), "tool_name", "channel_id", "text"
    )


def _messages(spark, sf_dir) -> DataFrame:
    """All texts but the notes as messages of five shapes, with numbers, keys and blanks that a writer of JSON would change."""
    t, at = F.to_json(F.array("text")), F.col("seq").cast("string")
    text = t.substr(F.lit(2), F.length(t) - 2)
    cat = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    blocks = cat(
        '{"z":1.50,"role":"tool","content":[{"type":"text","text":', text, '}, {"type":"image","data":"AA==","text":"no@x.org"},',
        '{"text":"mail me at u', at, '\\u0040x.org","n":1e2,"type":"text"}],"a":1,"a":2}',
    )
    shape = F.col("seq") % 5
    return union_texts(*(f(spark, sf_dir) for f in (X.conversations, X.documents, X.pages))).withColumn(
        "message",
        F.when(shape == 0, blocks)
        .when(shape == 1, cat('{"id":1234567890, "content":', text, ',"b":10.0,"b":{"content":"deep@x.org"}}'))
        .when(shape == 2, cat(" ", text, "\n"))
        .when(shape == 3, cat('{"content":"","content" : ', text, ',"phone":"555-010-9999"}'))
        .otherwise(cat('{"content":[{"type":"text","text":', text, ',"o":{"type":"text","text":"joe@x.org"}}],"big":123456789012345678901}')),
    )


_AS_MESSAGE = """CASE seq % 5
  WHEN 0 THEN '{"z":1.50,"role":"tool","content":[{"type":"text","text":' || to_json(one) || '}, {"type":"image","data":"AA==","text":"no@x.org"},'
    || '{"text":' || two || ',"n":1e2,"type":"text"}],"a":1,"a":2}'
  WHEN 1 THEN '{"id":1234567890, "content":' || to_json(one) || ',"b":10.0,"b":{"content":"deep@x.org"}}'
  WHEN 2 THEN ' ' || to_json(one) || chr(10)
  WHEN 3 THEN '{"content":"","content" : ' || to_json(one) || ',"phone":"555-010-9999"}'
  ELSE '{"content":[{"type":"text","text":' || to_json(one) || ',"o":{"type":"text","text":"joe@x.org"}}],"big":123456789012345678901}' END"""
_NO_NOTES = "NOT starts_with(record_id, 'note-')"
_MESSAGE_TEXT = "text || CASE WHEN seq % 5 = 0 THEN '<NUL>mail me at u' || seq || '@x.org' ELSE '' END"


@query("extract_text", f"WITH {CORPUS} SELECT record_id, {_MESSAGE_TEXT} AS extracted FROM corpus WHERE {_NO_NOTES}")
def extract(spark, sf_dir):
    return _messages(spark, sf_dir).select(
        "record_id", F.replace(extract_text("message"), F.lit("\0"), F.lit("<NUL>")).alias("extracted")
    )


@query(
    "replace_text",
    f"WITH {CORPUS}, x AS (SELECT record_id, seq, translate(text, 'aeiou', 'AEIOU') AS one, "
    "to_json(translate('mail me at u' || seq || '@x.org', 'aeiou', 'AEIOU')) AS two "
    f"FROM corpus WHERE {_NO_NOTES}) SELECT record_id, {_AS_MESSAGE} AS message FROM x",
)
def replace(spark, sf_dir):
    """Whole messages: only the text strings differ from what came in."""
    new = replace_text("message", F.translate(extract_text("message"), "aeiou", "AEIOU"))
    return _messages(spark, sf_dir).select("record_id", new.alias("message"))


# --- B: detectors ------------------------------------------------------------


def _detector(label: str):
    def run(spark, sf_dir):
        return spans_of(C.fence(corpus(spark, sf_dir), "entities", detect("text", label)))

    sql = f"WITH {CORPUS} SELECT record_id, label, start_pos, end_pos, txt AS span_text, 1.0::DOUBLE AS confidence FROM ({label_spans(label, 'corpus')})"
    query(f"detect_{label.lower()}", sql)(run)


for _label in LABELS:
    _detector(_label)


@query(
    "detect_structured",
    f"WITH {CORPUS}, {found()} SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY start_pos, end_pos, rank) - 1 AS idx, "
    "label, start_pos, end_pos, txt AS span_text FROM found",
)
def structured_spans(spark, sf_dir):
    return (
        corpus(spark, sf_dir)
        .select("record_id", F.posexplode(detect_structured("text")).alias("idx", "e"))
        .select(
            "record_id", long("idx").alias("idx"), F.col("e.label").alias("label"),
            long("e.start_pos").alias("start_pos"), long("e.end_pos").alias("end_pos"),
            F.col("e.text").alias("span_text"),
        )
    )


def _own_rules(spark, sf_dir):
    """Rules as a user would keep them: a table; the order priorities are those that orders have."""
    fixed = [(k, label, pattern) for k, (label, pattern) in enumerate(CUSTOM) if label != "PRIORITY"]
    rows = spark.createDataFrame(fixed, "rank int, label string, pattern string")
    priorities = X.table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    place = next(k for k, (label, _) in enumerate(CUSTOM) if label == "PRIORITY")
    return load_detectors(rows.union(priorities.select(F.lit(place), F.lit(" priority"), "o_orderpriority")))


@query(
    "detect_custom",
    f"WITH {CORPUS}, found AS ({custom_spans('corpus')}) SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY start_pos, end_pos, rank) - 1 AS idx, "
    "label, start_pos, end_pos, txt AS span_text FROM found",
)
def custom(spark, sf_dir):
    spans = corpus(spark, sf_dir).select("record_id", F.posexplode(detect_custom("text", _own_rules(spark, sf_dir))).alias("idx", "e"))
    return spans.select(
        "record_id", long("idx").alias("idx"), F.col("e.label").alias("label"),
        long("e.start_pos").alias("start_pos"), long("e.end_pos").alias("end_pos"), F.col("e.text").alias("span_text"),
    )


@query(
    "outbound_redact_custom",
    f"WITH {CORPUS}, texts AS (SELECT * FROM corpus WHERE channel = 'outbound'), {found('texts', custom=True)}, "
    f"kept AS (SELECT *, 1.0::DOUBLE AS conf, 0 AS src FROM found WHERE NOT {ALLOWED}), {resolved('kept')}, {labels_of()}, {replaced()} "
    "SELECT record_id, n AS entity_count, labels, redacted_text FROM red JOIN labs USING (record_id)",
)
def outbound_custom(spark, sf_dir):
    """The user's rules next to the structured ones, under one policy."""
    policy = changed(POLICY, detectors=_own_rules(spark, sf_dir))
    return _enforced(C.outbound_redact(corpus(spark, sf_dir, "outbound"), policy))


def _with_ner(spark, sf_dir, channel: str | None = None) -> DataFrame:
    return N.attach_ner(corpus(spark, sf_dir, channel), X.ner_table(spark, sf_dir), POLICY)


@query(
    "attach_ner",
    f"WITH {CORPUS}, {NER_TABLE} SELECT record_id, label, start_pos, end_pos, txt AS span_text, score AS confidence FROM nspans WHERE score >= 0.2",
)
def attach_ner(spark, sf_dir):
    return spans_of(_with_ner(spark, sf_dir), "ner")


def _load_capitals(broken: bool = False):
    """A stand-in for a model: the first capitalised word of a text is a person; ``broken``: it fails on texts with a colon."""
    import re

    first = re.compile(r"\b[A-Z][a-z]{2,}\b", re.ASCII)

    def model(texts, labels, floor):
        if broken and any(":" in t for t in texts):
            raise ValueError("a text with a colon")
        hits = [first.search(t) for t in texts]
        return [
            [{"text": m.group(), "label": labels[0], "score": 0.9, "start": m.start(), "end": m.end()}]
            if m
            else []
            for m in hits
        ]

    return model


def _capitals_sql(where: str = "TRUE") -> str:
    return (
        f"WITH {CORPUS}, m AS (SELECT record_id, text, regexp_extract(text, '(?s)^(.*?)\\b([A-Z][a-z]{{2,}})\\b', ['pre', 'w']) AS g FROM corpus WHERE {where}) "
        "SELECT record_id, 'PERSON' AS label, g.w AS span_text, length(g.pre)::BIGINT AS start_pos, (length(g.pre) + length(g.w))::BIGINT AS end_pos, 0.9::DOUBLE AS confidence FROM m WHERE g.w <> ''"
    )


def _model_spans(df: DataFrame) -> DataFrame:
    return df.select("record_id", F.inline("ner")).select(
        "record_id", "label", F.col("text").alias("span_text"), long("start_pos").alias("start_pos"), long("end_pos").alias("end_pos"), "confidence"
    )


@query("run_ner_model", _capitals_sql())
def run_ner(spark, sf_dir):
    texts = corpus(spark, sf_dir).select("record_id", "text")
    return _model_spans(N.run_ner(texts, _load_capitals, ["person"], POLICY))


@query("run_ner_model_failing", _capitals_sql("NOT contains(text, ':')"))
def run_ner_failing(spark, sf_dir):
    """A model that fails on some texts: only those go without its spans."""
    texts = corpus(spark, sf_dir).select("record_id", "text")
    return _model_spans(N.run_ner(texts, lambda: _load_capitals(True), ["person"], POLICY))


def _load_last_label():
    """A stand-in that gives its finds the last label it is asked for."""
    model = _load_capitals()
    return lambda texts, labels, floor: model(texts, labels[::-1], floor)


@query(
    "run_ner_tenant_labels",
    _capitals_sql().replace("SELECT record_id, text,", "SELECT record_id, channel, text,").replace(
        "'PERSON' AS label", "CASE channel WHEN 'outbound' THEN 'PRODUCT' WHEN 'tool_result' THEN 'LOCATION' ELSE 'PROJECT NAME' END AS label"
    ),
)
def run_ner_tenants(spark, sf_dir):
    """Labels per row: the policy's own for all, more for some channels; one pass of the model."""
    policy = changed(POLICY, custom_entities=("project name",))
    channel = F.col("channel")
    extra = F.when(channel == "outbound", F.array(F.lit("product"))).when(channel == "tool_result", F.array(F.lit("person"), F.lit("gpe")))
    texts = corpus(spark, sf_dir).select("record_id", "channel", "text")
    return _model_spans(N.run_ner(texts, _load_last_label, N.asked_labels(policy, extra), policy))


@query(
    "ner_labels",
    "SELECT p_partkey, 'person, organization, location, address, date of birth, medical record number, account number, passport number'"
    " || ', ' || p_brand || CASE WHEN p_type <> p_brand THEN ', ' || p_type ELSE '' END AS labels FROM part",
)
def labels_for_model(spark, sf_dir):
    asked = ner_labels(F.array("p_brand", F.lit("person")), F.array("p_type", "p_brand"))
    return X.table(spark, sf_dir, "part").select("p_partkey", names(asked).alias("labels"))


@query(
    "degrade_to_structured",
    structured(True) + f" SELECT {SPAN_COLUMNS} FROM ents",
)
def degrade(spark, sf_dir):
    def broken():
        raise RuntimeError("no model here")

    texts = N.run_ner(corpus(spark, sf_dir), broken, ["person"], POLICY)
    return spans_of(C.scan(texts, POLICY, ner=True))


# --- C: policy ---------------------------------------------------------------

_RAW_LABELS = ["dob", " zip ", "Per", "org", "GPE", "loc", "fac", "phone_number", "social_security_number",
               "credit_card_number", "date_of_birth", "date of birth", "email", "\tssn\n"]
_CANON = ["DATE", "ZIP_CODE", "PERSON", "ORGANIZATION", "LOCATION", "LOCATION", "ADDRESS", "PHONE", "SSN",
          "CREDIT_CARD", "DATE", "DATE OF BIRTH", "EMAIL", "SSN"]


@query(
    "canonical_label",
    f"SELECT l_orderkey, l_linenumber, ([{', '.join(map(q, _CANON))}])[CAST(l_partkey % {len(_CANON)} AS INT) + 1] AS label FROM lineitem",
)
def canonical(spark, sf_dir):
    raw = F.get(F.array(*[F.lit(x) for x in _RAW_LABELS]), (F.col("l_partkey") % len(_RAW_LABELS)).cast("int"))
    return X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", canonical_label(raw).alias("label")
    )


@query(
    "filter_by_confidence",
    f"WITH {CORPUS}, {NER_TABLE} SELECT record_id, label, start_pos, end_pos, txt AS span_text, score AS confidence FROM nspans WHERE {CONFIDENT}",
)
def confident(spark, sf_dir):
    df = _with_ner(spark, sf_dir)
    return spans_of(df.withColumn("ner", P.keep_confident(F.col("ner"), POLICY)), "ner")


@query(
    "ner_floor",
    f"WITH {CORPUS}, {NER_TABLE} SELECT label, count(*) AS spans FROM nspans WHERE score >= least(0.4, 0.6, 0.2) GROUP BY label",
)
def floor(spark, sf_dir):
    return (
        N.ner_spans(X.ner_table(spark, sf_dir), POLICY)
        .groupBy(F.col("entity.label").alias("label"))
        .agg(F.count("*").alias("spans"))
    )


def _allow(name: str, rule, condition: str):
    """Spans of the corpus that one part of the allowlist suppresses."""

    def run(spark, sf_dir):
        df = C.fence(corpus(spark, sf_dir), "found", detect_structured("text"))
        return spans_of(C.fence(df, "entities", F.filter("found", lambda e: rule(e, POLICY))))

    query(
        name,
        f"WITH {CORPUS}, {found()} SELECT record_id, label, start_pos, end_pos, txt AS span_text, 1.0::DOUBLE AS confidence FROM found WHERE {condition}",
    )(run)


_allow("allow_exact", P.allowed_exact, "lower(trim(txt)) = 'noreply@example.com'")
_allow(
    "allow_pattern",
    P.allowed_pattern,
    r"length(txt) <= 512 AND (regexp_full_match(txt, 'cust\.1[0-9]*@.*', 'i') OR regexp_full_match(txt, '5550', 'i'))",
)
_allow("allow_label_value", P.allowed_for_label, "label = 'ZIP_CODE' AND lower(trim(txt)) IN ('00008', '00015-0015')")
_allow("apply_allowlist", P.allowed, ALLOWED)


@query(
    "allow_length_guard",
    f"WITH {CORPUS} SELECT record_id, length(text) AS n_chars, CAST(CASE WHEN length(text) <= 512 THEN 1 ELSE 0 END AS BIGINT) AS suppressed FROM corpus",
)
def length_guard(spark, sf_dir):
    """Under a pattern that matches everything, a whole text is suppressed up to the limit and kept beyond it."""
    from veiltext.sources.policies import policy_from

    any_ = policy_from({"allowlist": {"patterns": [r"(?s).*"]}})
    entity = F.struct(F.col("text").alias("text"), F.lit("X").alias("label"))
    assert MAX_SUBJECT_CHARS == 512
    return corpus(spark, sf_dir).select(
        "record_id", long(F.length("text")).alias("n_chars"), P.allowed_pattern(entity, any_).cast("int").cast("bigint").alias("suppressed")
    )


@query(
    "allowlist_join",
    f"WITH {CORPUS}, {found()}, lst AS (SELECT 'user.' || c_custkey || '@corp.example.org' AS v FROM customer WHERE c_custkey % 2 = 0) "
    "SELECT record_id, label, start_pos, end_pos, txt AS span_text FROM found WHERE lower(trim(txt)) NOT IN (SELECT v FROM lst) "
    "AND NOT (label = 'ZIP_CODE' AND txt IN (SELECT lpad(CAST(p_partkey AS VARCHAR), 5, '0') FROM part))",
)
def allowlist_join(spark, sf_dir):
    values = X.table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(
        F.concat(F.lit("User."), F.col("c_custkey").cast("string"), F.lit("@CORP.example.org")).alias("value")
    )
    by_label = X.table(spark, sf_dir, "part").select(
        F.lit("zip").alias("label"), F.lpad(F.col("p_partkey").cast("string"), 5, "0").alias("value")
    )
    spans = corpus(spark, sf_dir).select("record_id", F.inline(detect_structured("text")))
    return W.drop_allowed(spans, values, by_label).select(
        "record_id", "label", long("start_pos").alias("start_pos"), long("end_pos").alias("end_pos"), F.col("text").alias("span_text")
    )


@query("resolve_overlaps", full() + f" SELECT {SPAN_COLUMNS} FROM ents")
def overlaps(spark, sf_dir):
    return spans_of(C.scan(_with_ner(spark, sf_dir), POLICY, ner=True))


@query(
    "resolve_overlaps_ner_only",
    f"WITH {CORPUS}, {NER_TABLE}, kept AS (SELECT record_id, label, rank, start_pos, end_pos, txt, score AS conf, 1 AS src "
    f"FROM nspans WHERE score >= 0.2), {resolved('kept')} SELECT {SPAN_COLUMNS} FROM ents",
)
def overlaps_ner(spark, sf_dir):
    return spans_of(_with_ner(spark, sf_dir).withColumn("entities", resolve_overlaps("ner")))


@query(
    "resolve_action",
    structured(True) + f" SELECT label, {ACTION} AS action, count(*) AS spans FROM ents GROUP BY 1, 2",
)
def action(spark, sf_dir):
    df = C.scan(corpus(spark, sf_dir), POLICY).select(F.inline("entities"))
    return df.groupBy("label", P.action_of(F.col("label"), POLICY).alias("action")).agg(
        F.count("*").alias("spans")
    )


def _planned(spark, sf_dir) -> DataFrame:
    df = C.scan(_with_ner(spark, sf_dir, "inbound"), POLICY, ner=True).filter(F.size("entities") > 0)
    return df.withColumn("plan", P.plan_of("entities", POLICY))


@query(
    "guardrail_plan",
    full("inbound") + f" SELECT record_id, {ACTION} AS action, label, start_pos FROM ents",
)
def plan(spark, sf_dir):
    def part(name, action_):
        return F.transform(
            f"plan.{name}",
            lambda e: F.struct(F.lit(action_).alias("action"), e["label"].alias("label"), long(e["start_pos"]).alias("start_pos")),
        )

    parts = [part("blocked", "block"), part("warned", "warn"), part("redacted", "redact")]
    return _planned(spark, sf_dir).select("record_id", F.inline(F.concat(*parts)))


_SUMMARY_CTES = ", " + ", ".join(
    labels_of(f"({ACTION}) = {q(a)}", name=n) for n, a in (("lb", "block"), ("lw", "warn"), ("lr", "redact"))
)
_SUMMARY_JOIN = "(SELECT record_id, count(*) AS total FROM ents GROUP BY record_id) LEFT JOIN lb USING (record_id) LEFT JOIN lw USING (record_id) LEFT JOIN lr USING (record_id)"
_SUMMARY_COLUMNS = (
    "total, coalesce(lb.n, 0) AS blocked, coalesce(lw.n, 0) AS warned, coalesce(lr.n, 0) AS redacted, "
    "coalesce(lb.labels, '') AS blocked_labels, coalesce(lw.labels, '') AS warned_labels, coalesce(lr.labels, '') AS redacted_labels"
)


def _summary_columns(s="summary"):
    c = F.col(s)
    return [long(c[x]).alias(x) for x in ("total", "blocked", "warned", "redacted")] + [
        names(c[f"{x}_labels"]).alias(f"{x}_labels") for x in ("blocked", "warned", "redacted")
    ]


@query("plan_summary", full("inbound") + _SUMMARY_CTES + f" SELECT record_id, {_SUMMARY_COLUMNS} FROM {_SUMMARY_JOIN}")
def summary(spark, sf_dir):
    df = _planned(spark, sf_dir).withColumn("summary", P.summary_of("plan"))
    return df.select("record_id", *_summary_columns())


_GATE_SQL = (
    structured(True, "inbound")
    + ", "
    + labels_of(f"({ACTION}) = 'block'", name="lb")
    + " SELECT t.record_id, CASE WHEN n > 0 THEN 'block' ELSE 'pass' END AS outcome, " + q(C.BLOCK_REASON) + " || labels AS reason, "
    + q(C.BLOCK_MESSAGE[0]) + " || labels || " + q(C.BLOCK_MESSAGE[1]) + " AS message, "
    "CASE WHEN n > 0 THEN 'pii' END AS category FROM texts t LEFT JOIN lb USING (record_id)"
)


@query("block_gate", _GATE_SQL)
def gate(spark, sf_dir):
    df = C.block_gate(C.scan(corpus(spark, sf_dir, "inbound"), POLICY), POLICY)
    return df.select("record_id", "outcome", "reason", "message", "category")


_REDACTED_PART = "rpart AS (SELECT * FROM ents WHERE " + f"({ACTION}) = 'redact')"
def _tagged(words: tuple[str, str], labels: str) -> str:
    return f"{q('[' + C.NOTICE_TAG + words[0])} || {labels} || {q(words[1])}"


_NOTICE = "concat_ws(chr(10) || chr(10), " + ", ".join(
    [
        _tagged(C.NOTICE_BLOCKED, "lb.labels"),
        _tagged(C.NOTICE_WARNED, "lw.labels"),
        _tagged(C.NOTICE_REDACTED, "lr.labels"),
        q("[" + C.NOTICE_TAG + C.NOTICE_REFERENCE) + " || red.redacted_text)",
    ]
)


@query(
    "guardrail_notice",
    full("inbound") + _SUMMARY_CTES + ", " + _REDACTED_PART + ", " + replaced("rpart")
    + f" SELECT record_id, {_NOTICE} AS notice FROM {_SUMMARY_JOIN} LEFT JOIN red USING (record_id)",
)
def notice(spark, sf_dir):
    return C.inbound_advisory(_with_ner(spark, sf_dir, "inbound"), POLICY, ner=True).select("record_id", "notice")


# --- D: redaction ------------------------------------------------------------


def _redaction(strategy: str):
    def run(spark, sf_dir):
        df = C.scan(corpus(spark, sf_dir), PLAIN).filter(F.size("entities") > 0)
        return df.select("record_id", redact("text", "entities", strategy)["redacted_text"].alias("redacted_text"))

    query(
        f"redact_{strategy}",
        structured(False) + ", " + replaced(strategy=strategy) + " SELECT record_id, redacted_text FROM red",
    )(run)


for _strategy in ("token", "mask", "hash"):
    _redaction(_strategy)


@query(
    "apply_spans",
    structured(False) + ", " + replaced() + " SELECT t.record_id, coalesce(red.redacted_text, t.text) AS redacted_text FROM texts t LEFT JOIN red USING (record_id)",
)
def apply_spans(spark, sf_dir):
    return C.outbound_redact(corpus(spark, sf_dir), PLAIN, changed_only=False).select("record_id", "redacted_text")


def _mapping_sql(strategy: str) -> str:
    return (
        structured(False) + ", " + replaced(strategy=strategy)
        + ", m AS (SELECT record_id, placeholder, arg_min(txt, start_pos) AS original, max(start_pos) AS first FROM red_r GROUP BY record_id, placeholder) "
        "SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY first DESC) - 1 AS ord, placeholder, original FROM m"
    )


def _mapping(strategy: str):
    def run(spark, sf_dir):
        df = C.redacted_records(corpus(spark, sf_dir), PLAIN, strategy)
        return M.mapping_rows(df).select("record_id", long("ord").alias("ord"), "placeholder", "original")

    query(f"mapping_rows_{strategy}", _mapping_sql(strategy))(run)


for _strategy in ("token", "mask", "hash"):
    _mapping(_strategy)


@query(
    "placeholder_list",
    "SELECT record_id, string_agg(placeholder, ', ' ORDER BY ord) AS placeholders FROM (" + _mapping_sql("mask") + ") GROUP BY record_id",
)
def placeholder_list(spark, sf_dir):
    df = C.redact_report(corpus(spark, sf_dir), PLAIN, "mask").filter("entities_found > 0")
    return df.select("record_id", names("placeholders").alias("placeholders"))


def _strategy_of():
    return F.get(F.array(F.lit("token"), F.lit("mask"), F.lit("hash")), (F.col("seq") % 3).cast("int"))


@query(
    "redact_by_row_strategy",
    structured(False) + ", " + ", ".join(replaced(strategy=s, name=s[0]) for s in ("token", "mask", "hash"))
    + " SELECT t.record_id, CASE t.seq % 3 WHEN 0 THEN t.redacted_text WHEN 1 THEN m.redacted_text ELSE h.redacted_text END AS redacted_text "
    "FROM (SELECT * FROM texts JOIN t USING (record_id)) t JOIN m USING (record_id) JOIN h USING (record_id)",
)
def redact_by_row(spark, sf_dir):
    df = C.redact_report(corpus(spark, sf_dir), PLAIN, _strategy_of()).filter("entities_found > 0")
    return df.select("record_id", "redacted_text")


# --- E: channel jobs ---------------------------------------------------------


@query("inbound_gate", _GATE_SQL)
def inbound_gate(spark, sf_dir):
    df = C.inbound_gate(corpus(spark, sf_dir, "inbound"), POLICY)
    return df.select("record_id", "outcome", "reason", "message", "category")


@query(
    "inbound_advisory",
    full("inbound") + _SUMMARY_CTES + ", " + _REDACTED_PART + ", " + replaced("rpart")
    + f" SELECT record_id, {_SUMMARY_COLUMNS}, {_NOTICE} AS notice FROM {_SUMMARY_JOIN} LEFT JOIN red USING (record_id)",
)
def inbound_advisory(spark, sf_dir):
    df = C.inbound_advisory(_with_ner(spark, sf_dir, "inbound"), POLICY, ner=True)
    return df.select("record_id", *_summary_columns(), "notice")


def _enforced_sql(channel: str) -> str:
    return (
        structured(True, channel) + ", " + labels_of() + ", " + replaced()
        + " SELECT record_id, n AS entity_count, labels, redacted_text FROM red JOIN labs USING (record_id)"
    )


def _enforced(df: DataFrame) -> DataFrame:
    return df.select("record_id", long("entity_count").alias("entity_count"), names("labels").alias("labels"), "redacted_text")


@query("tool_result_redact", _enforced_sql("tool_result"))
def tool_result(spark, sf_dir):
    return _enforced(C.tool_result_redact(corpus(spark, sf_dir, "tool_result"), POLICY))


_MESSAGE_SQL = (
    f"WITH {CORPUS}, texts AS (SELECT record_id, seq, text || CASE WHEN seq % 5 = 0 THEN chr(1) || 'mail me at u' || seq || '@x.org' ELSE '' END AS text "
    f"FROM corpus WHERE {_NO_NOTES}), {found('texts')}, "
    f"kept AS (SELECT *, 1.0::DOUBLE AS conf, 0 AS src FROM found WHERE NOT {ALLOWED}), {resolved('kept')}, {labels_of()}, {replaced()}, "
    "x AS (SELECT record_id, n, labels, seq, CASE WHEN seq % 5 = 0 THEN split_part(redacted_text, chr(1), 1) ELSE redacted_text END AS one, "
    "to_json(split_part(redacted_text, chr(1), 2)) AS two FROM red JOIN labs USING (record_id) JOIN texts USING (record_id)) "
    f"SELECT record_id, n AS entity_count, labels, {_AS_MESSAGE} AS message FROM x"
)


@query("tool_result_redact_messages", _MESSAGE_SQL)
def tool_result_messages(spark, sf_dir):
    df = C.tool_result_redact(_messages(spark, sf_dir), POLICY, message="message")
    return df.select("record_id", long("entity_count").alias("entity_count"), names("labels").alias("labels"), "message")


_SPLICE_SQL = (
    f"WITH {CORPUS}, {found()}, kept AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY start_pos, end_pos, rank) AS ord FROM found WHERE NOT {ALLOWED}), "
    "named AS (SELECT *, '[' || label || '_' || row_number() OVER (PARTITION BY record_id, label ORDER BY start_pos DESC, ord) || ']' AS ph FROM kept), "
    "steps AS (SELECT record_id, text AS txt, 0::BIGINT AS s, 0::BIGINT AS e, '' AS ph, 0 AS k, 0::BIGINT AS ord FROM corpus WHERE record_id IN (SELECT record_id FROM kept) "
    "UNION ALL SELECT record_id, '', start_pos, end_pos, ph, 1, ord FROM named), "
    "folded AS (SELECT record_id, list_reduce(list({'txt': txt, 's': s, 'e': e, 'ph': ph} ORDER BY k, s DESC, ord), "
    "lambda a, x: {'txt': left(a.txt, x.s) || x.ph || substr(a.txt, x.e + 1), 's': x.s, 'e': x.e, 'ph': x.ph}) AS r FROM steps GROUP BY record_id), "
    "labs AS (SELECT record_id, sum(n)::BIGINT AS n, string_agg(label, ', ' ORDER BY first) AS labels FROM "
    "(SELECT record_id, label, count(*) AS n, min(ord) AS first FROM kept GROUP BY record_id, label) GROUP BY record_id) "
    "SELECT record_id, n AS entity_count, labels, r.txt AS redacted_text FROM folded JOIN labs USING (record_id)"
)


@query("tool_result_redact_splice", _SPLICE_SQL)
def tool_result_splice(spark, sf_dir):
    return _enforced(C.tool_result_redact(corpus(spark, sf_dir), POLICY, overlap_mode="splice"))


@query("outbound_redact", _enforced_sql("outbound"))
def outbound(spark, sf_dir):
    return _enforced(C.outbound_redact(corpus(spark, sf_dir, "outbound"), POLICY))


_LISTED = (
    "(lower(trim(txt)) IN (SELECT 'user.' || c_custkey || '@corp.example.org' FROM customer WHERE c_custkey % 2 = 0) "
    "OR (label = 'ZIP_CODE' AND txt IN (SELECT lpad(CAST(p_partkey * 7 + i AS VARCHAR), 5, '0') FROM part, range(7) r(i))))"
)


_LONG_LIST = (
    f"WITH {CORPUS}, texts AS (SELECT * FROM corpus WHERE channel = 'outbound'), {found('texts')}, "
    f"kept AS (SELECT *, 1.0::DOUBLE AS conf, 0 AS src FROM found WHERE NOT {ALLOWED} AND NOT {_LISTED})"
    f", {resolved('kept')}, {labels_of()}, {replaced()} SELECT record_id, n AS entity_count, labels, redacted_text FROM red JOIN labs USING (record_id)"
)


def _long_lists(spark, sf_dir) -> W.AllowTables:
    """Allowlists that are tables: half of all customers' addresses, and seven codes per part."""
    values = X.table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(
        F.concat(F.lit(" User."), F.col("c_custkey").cast("string"), F.lit("@CORP.example.org")).alias("value")
    )
    codes = X.table(spark, sf_dir, "part").select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.col("p_partkey") * 7 + i)).alias("n"))
    by_label = codes.select(F.lit("zip").alias("label"), F.lpad(F.col("n").cast("string"), 5, "0").alias("value"))
    return W.AllowTables(values, by_label)


@query("outbound_redact_long_allowlist", _LONG_LIST)
def outbound_long_list(spark, sf_dir):
    return _enforced(C.outbound_redact(corpus(spark, sf_dir, "outbound"), POLICY, allow=_long_lists(spark, sf_dir)))


@query(
    "inbound_advisory_allow_tables",
    full("inbound").replace(f"NOT {ALLOWED}", f"NOT {ALLOWED} AND NOT {_LISTED}") + _SUMMARY_CTES + ", " + _REDACTED_PART + ", " + replaced("rpart")
    + f" SELECT record_id, {_SUMMARY_COLUMNS}, {_NOTICE} AS notice FROM {_SUMMARY_JOIN} LEFT JOIN red USING (record_id)",
)
def inbound_advisory_listed(spark, sf_dir):
    """Spans of a model joined before, then the lists: the plan above holds a shuffle."""
    df = C.inbound_advisory(_with_ner(spark, sf_dir, "inbound"), POLICY, ner=True, allow=_long_lists(spark, sf_dir))
    return df.select("record_id", *_summary_columns(), "notice")


_BY_PATTERN = (
    "(lower(txt) IN (SELECT 'user.' || c_custkey || '@corp.example.org' FROM customer WHERE c_custkey % 2 = 0) "
    "OR lower(txt) IN (SELECT 'cust.' || c_custkey || '@mail.example.com' FROM customer WHERE c_custkey % 3 = 0) "
    "OR txt IN (SELECT 'api_key: Bearer key_' || o_orderkey || 'abcdef' FROM orders WHERE o_custkey % 5 = 0) "
    "OR regexp_full_match(txt, '[0-9]{3}-1[0-9]-[0-9]+[02468]'))"
)


@query(
    "outbound_redact_pattern_table",
    f"WITH {CORPUS}, texts AS (SELECT * FROM corpus WHERE channel = 'outbound'), {found('texts')}, "
    f"kept AS (SELECT *, 1.0::DOUBLE AS conf, 0 AS src FROM found WHERE NOT {ALLOWED} AND NOT {_BY_PATTERN}), {resolved('kept')}, {labels_of()}, {replaced()} "
    "SELECT record_id, n AS entity_count, labels, redacted_text FROM red JOIN labs USING (record_id)",
)
def outbound_pattern_table(spark, sf_dir):
    """A pattern for every second customer, every third one, the orders of every fifth, and one without a literal."""
    customer = X.table(spark, sf_dir, "customer")
    k, o = F.col("c_custkey").cast("string"), F.col("o_orderkey").cast("string")
    patterns = (
        customer.filter("c_custkey % 2 = 0").select(F.concat(F.lit(r"USER\."), k, F.lit(r"@corp\.example\.(?:org|com)")).alias("pattern"))
        .union(customer.filter("c_custkey % 3 = 0").select(F.concat(F.lit(r"cust[.]"), k, F.lit(r"@mail\.example\.[a-z]{3}"))))
        .union(X.table(spark, sf_dir, "orders").filter("o_custkey % 5 = 0").select(F.concat(F.lit(r"api_key:\s*Bearer key_"), o, F.lit("[a-f]+"))))
        .union(customer.limit(1).select(F.lit("[0-9]{3}-1[0-9]-[0-9]+[02468]")))
    )
    return _enforced(C.outbound_redact(corpus(spark, sf_dir, "outbound"), POLICY, allow=W.AllowTables(patterns=patterns)))


@query("reply_payload_redact", _enforced_sql("reply_payload").replace("labels, redacted_text FROM", "labels, redacted_text, 'm-' || record_id AS media FROM"))
def reply_payload(spark, sf_dir):
    df = corpus(spark, sf_dir, "reply_payload")
    media = F.concat(F.lit("m-"), F.col("record_id"))
    df = df.withColumn("payload", F.struct(F.col("text").alias("text"), media.alias("mediaUrl"))).drop("text")
    out = C.reply_payload_redact(df, POLICY)
    return out.select(
        "record_id", long("entity_count").alias("entity_count"), names("labels").alias("labels"),
        F.col("payload.text").alias("redacted_text"), F.col("payload.mediaUrl").alias("media"),
    )


@query(
    "scan_report",
    full() + ", " + labels_of()
    + " SELECT t.record_id, coalesce(n, 0) AS entity_count, CASE WHEN n > 0 THEN 'Found ' || n || ' entities: ' || labels ELSE 'No entities detected' END AS summary "
    "FROM texts t LEFT JOIN labs USING (record_id)",
)
def scan_report(spark, sf_dir):
    df = C.scan_report(_with_ner(spark, sf_dir), POLICY, ner=True)
    return df.select("record_id", long("entity_count").alias("entity_count"), "summary")


def _preview_sql(strategy: str) -> str:
    return (
        full() + _SUMMARY_CTES + ", " + _REDACTED_PART + ", " + replaced("rpart", strategy)
        + ", s AS (SELECT record_id, " + _SUMMARY_COLUMNS + " FROM " + _SUMMARY_JOIN + ")"
        + f" SELECT t.record_id, {q(strategy)} AS strategy, coalesce(total, 0) AS total, coalesce(blocked, 0) AS blocked, coalesce(warned, 0) AS warned, "
        "coalesce(redacted, 0) AS redacted, coalesce(blocked_labels, '') AS blocked_labels, coalesce(warned_labels, '') AS warned_labels, "
        "coalesce(redacted_labels, '') AS redacted_labels, coalesce(redacted_text, t.text) AS redacted_text "
        "FROM texts t LEFT JOIN s USING (record_id) LEFT JOIN red USING (record_id)"
    )


@query("preview_report", _preview_sql("hash"))
def preview(spark, sf_dir):
    df = C.preview_report(_with_ner(spark, sf_dir), POLICY, "hash", ner=True)
    return df.select("record_id", "strategy", *_summary_columns(), "redacted_text")


_WHAT_IF = {"current": POLICY, "plain": PLAIN}


def _what_if_sql(name: str, policy: bool) -> str:
    part = _REDACTED_PART if policy else "rpart AS (SELECT * FROM ents)"
    counts = f"count(*) FILTER (({ACTION}) = 'block') AS blocked, count(*) FILTER (({ACTION}) = 'warn') AS warned" if policy else "0 AS blocked, 0 AS warned"
    return (
        f"SELECT {q(name)} AS policy_id, * FROM (" + structured(policy) + f", a AS (SELECT record_id, count(*) AS total, {counts} FROM ents GROUP BY record_id), "
        + part + ", " + replaced("rpart") + " SELECT record_id, coalesce(total, 0) AS total, coalesce(blocked, 0) AS blocked, coalesce(warned, 0) AS warned, "
        "coalesce(redacted_text, text) AS redacted_text FROM texts LEFT JOIN a USING (record_id) LEFT JOIN red USING (record_id))"
    )


@query("preview_policies", _what_if_sql("current", True) + " UNION ALL " + _what_if_sql("plain", False))
def preview_many(spark, sf_dir):
    df = C.preview_policies(corpus(spark, sf_dir), _WHAT_IF)
    s = F.col("summary")
    return df.select(
        "policy_id", "record_id", *[long(s[x]).alias(x) for x in ("total", "blocked", "warned")], "redacted_text"
    )


@query(
    "redact_report",
    full() + ", " + labels_of() + ", " + replaced()
    + ", ph AS (SELECT record_id, string_agg(placeholder, ', ' ORDER BY start_pos DESC) AS placeholders FROM red_r GROUP BY record_id) "
    "SELECT t.record_id, coalesce(n, 0) AS entities_found, coalesce(placeholders, '') AS placeholders, coalesce(redacted_text, t.text) AS redacted_text "
    "FROM texts t LEFT JOIN labs USING (record_id) LEFT JOIN red USING (record_id) LEFT JOIN ph USING (record_id)",
)
def redact_report(spark, sf_dir):
    df = C.redact_report(_with_ner(spark, sf_dir), POLICY, ner=True)
    return df.select("record_id", long("entities_found").alias("entities_found"), names("placeholders").alias("placeholders"), "redacted_text")
