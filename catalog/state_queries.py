"""Registered queries over state: maps, access requests, audit, tenant policies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiltext.operators import audit as G
from veiltext.operators import lint as L
from veiltext.operators import mapping as M
from veiltext.operators import replies as S
from veiltext.operators import requests as R
from veiltext.operators.shared import written
from veiltext.plans import channels as C

from . import corpus as X
from .corpus import PLAIN, POLICY, corpus
from .oracle_parts import ACTION, labels_of, q, replaced, structured
from .queries import (
    _NOTICE,
    _REDACTED_PART,
    _SUMMARY_COLUMNS,
    _SUMMARY_CTES,
    _SUMMARY_JOIN,
    _summary_columns,
    _with_ner,
    long,
    names,
    query,
)
from .oracle_parts import full

# --- A: tenant policies ------------------------------------------------------


def tenant_policies(spark, sf_dir) -> DataFrame:
    """A policy per customer, as JSON written from its key; most break a rule or two."""
    c = F.col("c_custkey")
    s = lambda x: x.cast("string")
    pick = lambda *xs: F.get(F.array(*[F.lit(x) for x in xs]), (c % len(xs)).cast("int"))
    tenth = lambda n: F.concat(s(F.floor(n / 10)), F.lit("."), s(n % 10))
    patterns = F.concat_ws(
        ",",
        F.lit('"a+b"'),
        F.when(c % 3 == 0, '"(a+)+"'),
        F.when(c % 11 == 0, F.concat(F.lit('"'), F.repeat(F.lit("x"), 513), F.lit('"'))),
        F.when(c % 6 == 0, '"["'),
        F.when(c % 12 == 5, '"(?P<y>a)"'),
        F.when(c % 12 == 7, r'"(?<y>\\d)\\p{L}"'),
        F.when(c % 10 == 0, "7"),
    )
    ssn = F.concat(F.lit('"ssn":"'), pick("block", "mask"), F.lit('"'))
    long_ssn = F.lit('"social_security_number":"warn"')
    config = F.concat(
        F.when(c % 14 == 0, '{"auditEnabled":null,').otherwise("{"),
        F.lit('"guardrail_mode":"'), pick("redact", "block", "warn", "drop"),
        F.lit('","confidence_threshold":'), tenth(c % 13),
        F.lit(',"maxPendingRequests":'), s(c % 7 - 1),
        F.lit(',"enabled":'), F.when(c % 5 == 0, '"yes"').otherwise("true"),
        F.lit(',"entityActions":{'), F.when(c % 8 < 4, F.concat(ssn, F.lit(','), long_ssn)).otherwise(F.concat(long_ssn, F.lit(','), ssn)),
        F.lit('},"entityConfidenceThresholds":{"zip":0.9,"person":'), tenth(c % 17), F.lit(',"ZIP_CODE":0.25'),
        F.when(c % 3 == 1, ',"per":0.75').otherwise(""),
        F.lit('},"custom_entities":["badge"],"allowlist":{"values":["a"," a ","'), s(c % 3), F.lit('"'), F.when(c % 9 == 0, ",5").otherwise(""),
        F.lit('],"entities":{"org":["x"," y "],"per":["p"],"PERSON":["q","q"]},"patterns":['), patterns, F.lit("]}}"),
    )
    config = F.when(c % 50 == 0, F.lit("{not json")).otherwise(config)
    return X.spread(X.table(spark, sf_dir, "customer").select("c_custkey"), X.LONG_ROWS, "c_custkey").select(c.alias("policy_id"), config.alias("config"))


_RULES = [
    ("c % 4 = 3", "guardrail_mode", "bad_enum"),
    ("c % 13 > 10", "confidence_threshold", "out_of_range"),
    ("c % 7 < 2", "maxPendingRequests", "not_positive_integer"),
    ("c % 5 = 0", "enabled", "not_boolean"),
    ("c % 2 = 1", "entityActions.ssn", "bad_enum"),
    ("c % 17 > 10", "entityConfidenceThresholds.person", "out_of_range"),
    ("c % 9 = 0", "allowlist.values", "not_string"),
    ("c % 10 = 0", "allowlist.patterns", "not_string"),
    ("c % 3 = 0", "allowlist.patterns", "nested_quantifier"),
    ("c % 11 = 0", "allowlist.patterns", "pattern_too_long"),
    ("c % 6 = 0", "allowlist.patterns", "invalid_regex"),
    ("c % 12 = 5", "allowlist.patterns", "invalid_regex"),
    ("c % 14 = 0", "auditEnabled", "not_boolean"),
]


@query(
    "policy_lint",
    "WITH t AS (SELECT c_custkey AS c FROM customer) SELECT c AS policy_id, '$' AS path, 'not_json' AS rule FROM t WHERE c % 50 = 0 UNION ALL "
    + " UNION ALL ".join(f"SELECT c, {q(p)}, {q(r)} FROM t WHERE c % 50 <> 0 AND {w}" for w, p, r in _RULES),
)
def policy_lint(spark, sf_dir):
    return L.policy_lint(tenant_policies(spark, sf_dir)).select("policy_id", "path", "rule")


def _broken(value: str, otherwise: str) -> str:
    return f"CASE WHEN c % 50 = 0 THEN {otherwise} ELSE {value} END"


@query(
    "effective_policies",
    "WITH t AS (SELECT c_custkey AS c FROM customer) SELECT c AS policy_id, "
    + _broken("(['redact', 'block', 'warn', 'drop'])[c % 4 + 1]", "'redact'") + " AS guardrail_mode, 'token' AS redact_strategy, "
    + _broken("(c % 13) / 10.0", "0.5") + "::DOUBLE AS confidence_threshold, " + _broken("c % 7 - 1", "50") + "::BIGINT AS max_pending, "
    + _broken("'SSN=' || CASE WHEN c % 8 < 4 THEN 'warn' WHEN c % 2 = 1 THEN 'mask' ELSE 'block' END", "''") + " AS actions, "
    + _broken("CASE WHEN c % 3 = 1 THEN 'ZIP_CODE=25, PERSON=75' ELSE 'PERSON=' || (c % 17 * 10) || ', ZIP_CODE=25' END", "''") + " AS thresholds, "
    + _broken("'a, ' || (c % 3)", "''") + " AS allow_values, " + _broken("'ORGANIZATION=x+y, PERSON=q'", "''") + " AS allow_entities, "
    + _broken("'a+b' || CASE WHEN c % 3 = 0 THEN ' (a+)+' ELSE '' END || CASE WHEN c % 11 = 0 THEN ' ' || repeat('x', 513) ELSE '' END || "
    "CASE WHEN c % 6 = 0 THEN ' [' ELSE '' END || CASE WHEN c % 12 = 5 THEN ' (?P<y>a)' ELSE '' END || "
    "CASE WHEN c % 12 = 7 THEN ' (?<y>\\d)\\p{L}' ELSE '' END", "''") + " AS allow_patterns, "
    + _broken("'badge'", "''") + " AS custom_entities, true AS enabled FROM t",
)
def effective(spark, sf_dir):
    df = L.effective_policies(tenant_policies(spark, sf_dir))

    def pairs(column, value):
        return names(F.transform(column, lambda e: F.concat(e["label"], F.lit("="), value(e["value"]))))

    return df.select(
        "policy_id", "guardrail_mode", "redact_strategy", "confidence_threshold",
        long("max_pending").alias("max_pending"), pairs("entity_actions", lambda v: v).alias("actions"),
        pairs("entity_thresholds", lambda v: F.round(v * 100).cast("int").cast("string")).alias("thresholds"),
        names("allow_values").alias("allow_values"), pairs("allow_entities", lambda v: F.array_join(v, "+")).alias("allow_entities"),
        F.array_join("allow_patterns", " ").alias("allow_patterns"), names("custom_entities").alias("custom_entities"), "enabled",
    )


# --- F: map and requests -----------------------------------------------------

EVENTS = """ev AS (SELECT CAST(user_id AS VARCHAR) AS session_id, event_id AS seq, ts, event_id % 4 AS m, k, event_type, props, value,
  CASE event_id % 4 WHEN 0 THEN '[EMAIL_' || (k % 5 + 1) || ']' WHEN 1 THEN '[EMAIL_' || (k % 6 + 1) || ']' END AS placeholder,
  CASE WHEN event_id % 4 = 0 THEN 'user' || event_id || '@example.com' END AS original,
  CASE k % 3 WHEN 0 THEN 'approve' WHEN 1 THEN 'deny' ELSE 'follow_up' END AS action,
  CASE WHEN k % 2 = 1 THEN 'note ' || k END AS message
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""

ASKED = """asked AS (
  SELECT session_id, seq, ts, 0::BIGINT AS pos, k % 12 + 1 AS no, action, message, FALSE AS batch FROM ev WHERE m = 2
  UNION ALL SELECT session_id, seq, ts, 0, k % 9 + 1, action, message, TRUE FROM ev WHERE m = 3
  UNION ALL SELECT session_id, seq, ts, 1, k % 7 + 3, action, message, TRUE FROM ev WHERE m = 3)"""

def _said(parts: tuple[str, ...], *values: str) -> str:
    """A sentence of the library's around SQL values."""
    return " || ".join([q(parts[0]), *(x for v, p in zip(values, parts[1:], strict=True) for x in (v, q(p)))])


REQUESTS = """req AS (SELECT r.session_id, r.seq, r.ts, r.no, 'REQ-' || r.no AS request_id, r.placeholder, r.event_type AS reason,
    CASE WHEN r.k % 2 = 0 THEN r.props END AS context, arg_max(w.original, w.seq) AS original_text
  FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY seq) AS no FROM ev WHERE m = 1) r
  LEFT JOIN (SELECT * FROM ev WHERE m = 0) w ON w.session_id = r.session_id AND w.placeholder = r.placeholder AND w.seq < r.seq
  GROUP BY ALL)"""

REPLIES = f"""known AS (SELECT a.*, r.original_text, coalesce(a.seq > r.seq, FALSE) AS known FROM asked a LEFT JOIN req r ON r.session_id = a.session_id AND r.no = a.no),
term AS (SELECT session_id, no, arg_min(action, seq * 2 + pos) AS term, min(seq * 2 + pos) AS term_at FROM known WHERE known AND action <> 'follow_up' GROUP BY 1, 2),
rep AS (SELECT k.*, CASE WHEN NOT known THEN {_said(S.NOT_FOUND, "'REQ-' || k.no")}
    WHEN seq * 2 + pos > term_at THEN {_said(S.SETTLED, "'REQ-' || k.no", "CASE term WHEN 'approve' THEN 'approved' ELSE 'denied' END")} END AS error
  FROM known k LEFT JOIN term t ON t.session_id = k.session_id AND t.no = k.no)"""

TABLE = """tab AS (SELECT r.*, coalesce(CASE s.act WHEN 'approve' THEN 'approved' WHEN 'deny' THEN 'denied' END, CASE WHEN f.n > 0 THEN 'follow_up' END, 'pending') AS status,
    s.at AS resolved_at, s.msg AS response_message, f.msg.v AS follow_up_message FROM req r
  LEFT JOIN (SELECT session_id, no, any_value(action) AS act, any_value(ts) AS at, any_value(message) AS msg FROM rep WHERE error IS NULL AND action <> 'follow_up' GROUP BY 1, 2) s USING (session_id, no)
  LEFT JOIN (SELECT session_id, no, count(*) AS n, arg_max({'v': message}, seq * 2 + pos) AS msg FROM rep WHERE error IS NULL AND action = 'follow_up' GROUP BY 1, 2) f USING (session_id, no))"""

_TO_REQ = f"WITH {EVENTS}, {REQUESTS} "
_TO_REP = f"WITH {EVENTS}, {ASKED}, {REQUESTS}, {REPLIES} "
_TO_TAB = f"WITH {EVENTS}, {ASKED}, {REQUESTS}, {REPLIES}, {TABLE} "


@query(
    "merge_mapping",
    structured(False) + ", " + replaced()
    + ", w AS (SELECT t.session_id, t.seq, r.placeholder, r.txt FROM red_r r JOIN texts t USING (record_id)) "
    "SELECT session_id, placeholder, arg_max(txt, seq) AS original, min(seq) AS first_seq, max(seq) AS last_seq FROM w GROUP BY 1, 2",
)
def merge_mapping(spark, sf_dir):
    rows = M.mapping_rows(C.redacted_records(corpus(spark, sf_dir), PLAIN))
    return M.merge_mapping(rows).drop("first_ord")


def _writes(spark, sf_dir) -> DataFrame:
    return R.mapping_events(X.backlog_events(spark, sf_dir))


@query(
    "evict_fifo",
    f"""WITH {EVENTS}, folded AS (SELECT session_id, list_reduce(list([{{'p': placeholder, 'v': original, 'f': seq}}] ORDER BY seq),
      lambda a, x: CASE WHEN len(list_filter(a, lambda y: y.p = x[1].p)) > 0
        THEN list_transform(a, lambda y: CASE WHEN y.p = x[1].p THEN {{'p': y.p, 'v': x[1].v, 'f': y.f}} ELSE y END)
        WHEN len(a) >= 4 THEN list_concat(a[2:len(a)], x) ELSE list_concat(a, x) END) AS kept
    FROM ev WHERE m = 0 GROUP BY session_id)
    SELECT session_id, e.p AS placeholder, e.v AS original, e.f AS first_seq FROM (SELECT session_id, unnest(kept) AS e FROM folded)""",
)
def evict_fifo(spark, sf_dir):
    return M.evict_fifo(_writes(spark, sf_dir), 4).select("session_id", "placeholder", "original", "first_seq")


@query(
    "lookup_original",
    f"WITH {EVENTS} SELECT r.session_id, r.seq, r.placeholder, w.original FROM (SELECT * FROM ev WHERE m = 1) r LEFT JOIN "
    "(SELECT session_id, placeholder, arg_max(original, seq) AS original FROM ev WHERE m = 0 GROUP BY 1, 2) w USING (session_id, placeholder)",
)
def lookup_original(spark, sf_dir):
    keys = X.backlog_events(spark, sf_dir).filter("kind = 'request'").select("session_id", "seq", "placeholder")
    return M.lookup_original(keys, M.merge_mapping(_writes(spark, sf_dir)))


@query(
    "clear_sessions",
    f"WITH {EVENTS} SELECT session_id, placeholder, arg_max(original, seq) AS original FROM ev WHERE m = 0 "
    "AND session_id NOT IN (SELECT session_id FROM ev WHERE event_type = 'purchase' AND value > 170) GROUP BY 1, 2",
)
def clear_sessions(spark, sf_dir):
    ended = X.table(spark, sf_dir, "events").filter("event_type = 'purchase' and value > 170").select(F.col("user_id").cast("string").alias("session_id"))
    kept = M.clear_sessions(M.merge_mapping(_writes(spark, sf_dir)), ended)
    return kept.select("session_id", "placeholder", "original")


@query("mapping_size", f"WITH {EVENTS} SELECT session_id, count(DISTINCT placeholder) AS size FROM ev WHERE m = 0 GROUP BY 1")
def mapping_size(spark, sf_dir):
    return M.mapping_size(M.merge_mapping(_writes(spark, sf_dir)))


@query(
    "create_requests",
    _TO_REQ + "SELECT session_id, seq, request_id, placeholder, reason, context, original_text, "
    + _said(S.CREATED, "request_id", "'EMAIL'", "placeholder") + " AS reply FROM req",
)
def create_requests(spark, sf_dir):
    return R.create_requests(X.backlog_events(spark, sf_dir)).select(
        "session_id", "seq", "request_id", "placeholder", "reason", "context", "original_text", "reply"
    )


# Admission under a cap of 3, as a fold over each session's requests and decisions.
ADMITTED = """moves AS (
      SELECT session_id, -1::BIGINT AS seq, 0 AS kind, []::BIGINT[] AS ids FROM ev GROUP BY session_id
      UNION ALL SELECT session_id, seq, 1, []::BIGINT[] FROM ev WHERE m = 1
      UNION ALL SELECT session_id, seq, 2, list(no ORDER BY pos) FROM asked WHERE action <> 'follow_up' GROUP BY session_id, seq),
    folded AS (SELECT session_id, list_reduce(list({'seq': seq, 'kind': kind, 'ids': ids, 'n': 0::BIGINT, 'open': []::BIGINT[],
        'out': []::STRUCT(seq BIGINT, no BIGINT)[]} ORDER BY seq), lambda a, x: {'seq': x.seq, 'kind': x.kind, 'ids': x.ids,
        'n': CASE WHEN x.kind = 1 AND len(a.open) < 3 THEN a.n + 1 ELSE a.n END,
        'open': CASE WHEN x.kind = 2 THEN list_filter(a.open, lambda y: NOT list_contains(x.ids, y)) WHEN len(a.open) < 3 THEN list_append(a.open, a.n + 1) ELSE a.open END,
        'out': CASE WHEN x.kind = 1 THEN list_append(a.out, {'seq': x.seq, 'no': CASE WHEN len(a.open) < 3 THEN a.n + 1 END}) ELSE a.out END}) AS st
      FROM moves GROUP BY session_id),
    admitted AS (SELECT session_id, o.seq AS seq, o.no AS no FROM (SELECT session_id, unnest(st.out) AS o FROM folded))"""

# What a map of 4 placeholders holds at each request, as a fold over writes and requests.
HELD = """held AS (SELECT session_id, o.seq AS seq, o.v AS original_text FROM (SELECT session_id, unnest(st.out) AS o FROM (
    SELECT session_id, list_reduce(list({'seq': seq, 'm': m, 'p': placeholder, 'v': original, 'map': []::STRUCT(p VARCHAR, v VARCHAR)[],
        'out': []::STRUCT(seq BIGINT, v VARCHAR)[]} ORDER BY seq), lambda a, x: {'seq': x.seq, 'm': x.m, 'p': x.p, 'v': x.v,
        'map': CASE WHEN x.m <> 0 THEN a.map
          WHEN len(list_filter(a.map, lambda y: y.p = x.p)) > 0 THEN list_transform(a.map, lambda y: CASE WHEN y.p = x.p THEN {'p': y.p, 'v': x.v} ELSE y END)
          WHEN len(a.map) >= 4 THEN list_append(a.map[2:len(a.map)], {'p': x.p, 'v': x.v}) ELSE list_append(a.map, {'p': x.p, 'v': x.v}) END,
        'out': CASE WHEN x.m = 1 THEN list_append(a.out, {'seq': x.seq, 'v': list_filter(a.map, lambda y: y.p = x.p)[1].v}) ELSE a.out END}) AS st
    FROM (SELECT session_id, seq, m, placeholder, original FROM ev WHERE m IN (0, 1)
      UNION ALL SELECT session_id, -1, -1, NULL, NULL FROM ev GROUP BY session_id) GROUP BY session_id)))"""

CAPPED_REQUESTS = """req AS (SELECT e.session_id, e.seq, e.ts, a.no, 'REQ-' || a.no AS request_id, e.placeholder, e.event_type AS reason,
    CASE WHEN e.k % 2 = 0 THEN e.props END AS context, h.original_text
  FROM ev e JOIN admitted a USING (session_id, seq) JOIN held h USING (session_id, seq) WHERE a.no IS NOT NULL)"""


@query(
    "create_requests_capped",
    f"WITH {EVENTS}, {ASKED}, {ADMITTED} SELECT session_id, seq, 'REQ-' || no AS request_id, CASE WHEN no IS NULL THEN "
    + _said(S.REFUSED, "3") + " END AS error FROM admitted",
)
def create_requests_capped(spark, sf_dir):
    return R.create_requests(X.backlog_events(spark, sf_dir), cap=3).select("session_id", "seq", "request_id", "error")


def _replies(spark, sf_dir):
    ev = X.backlog_events(spark, sf_dir)
    req = written(R.create_requests(ev), "requests")
    return req, R.resolve_replies(ev, req)


@query(
    "resolve_requests",
    _TO_REP + "SELECT session_id, seq, pos, 'REQ-' || no AS request_id, CASE WHEN error IS NULL THEN CASE action WHEN 'approve' THEN 'approved' WHEN 'deny' THEN 'denied' ELSE action END END AS status, error, "
    "CASE WHEN error IS NULL AND NOT batch THEN CASE action WHEN 'approve' THEN "
    f"coalesce({q(S.APPROVED)} || original_text, {q(S.APPROVED_BLANK)}) WHEN 'deny' THEN coalesce(message, {q(S.DENIED)}) "
    "ELSE " + _said(S.ASKED, "coalesce(message, '')") + " END END AS reply FROM rep",
)
def resolve_requests(spark, sf_dir):
    return _replies(spark, sf_dir)[1].select(
        "session_id", "seq", long("pos").alias("pos"), "request_id", "status", "error", "reply"
    )


@query(
    "resolve_batch",
    _TO_REP + "SELECT session_id, seq, count(*) AS ids, count(*) FILTER (error IS NULL) AS resolved, string_agg(coalesce(error, 'ok'), ' | ' ORDER BY pos) AS results FROM rep WHERE batch GROUP BY 1, 2",
)
def resolve_batch(spark, sf_dir):
    rep = _replies(spark, sf_dir)[1].filter("batch")
    results = F.array_sort(F.collect_list(F.struct("pos", F.coalesce("error", F.lit("ok")).alias("r"))))
    return rep.groupBy("session_id", "seq").agg(
        F.count("*").alias("ids"), F.count_if(F.col("error").isNull()).alias("resolved"),
        F.array_join(F.transform(results, lambda x: x["r"]), " | ").alias("results"),
    )


def _table(spark, sf_dir) -> DataFrame:
    return R.request_table(*_replies(spark, sf_dir))


_VIEW = (
    "session_id, request_id, placeholder, reason, context, status, CASE WHEN status = 'approved' THEN original_text END AS original_text, "
    "CASE WHEN status IN ('approved', 'denied') THEN strftime(resolved_at, '%Y-%m-%d %H:%M:%S') END AS resolved_at, "
    "CASE WHEN status = 'denied' THEN response_message END AS response_message, CASE WHEN status = 'follow_up' THEN follow_up_message END AS follow_up_message"
)


@query("list_requests", _TO_TAB + f"SELECT {_VIEW} FROM tab")
def list_requests(spark, sf_dir):
    return R.list_requests(_table(spark, sf_dir)).select(
        "session_id", "request_id", "placeholder", "reason", "context", "status", "original_text",
        F.date_format("resolved_at", "yyyy-MM-dd HH:mm:ss").alias("resolved_at"), "response_message", "follow_up_message",
    )


@query("list_totals", _TO_TAB + "SELECT session_id, count(*) AS total, 'approved' AS filter FROM tab WHERE status = 'approved' GROUP BY 1")
def list_totals(spark, sf_dir):
    return R.list_totals(_table(spark, sf_dir), "approved")


@query(
    "request_counts",
    _TO_TAB + "SELECT session_id, count(*) FILTER (status IN ('pending', 'follow_up')) AS pending_count, count(*) AS total_count FROM tab GROUP BY 1",
)
def request_counts(spark, sf_dir):
    return R.request_counts(_table(spark, sf_dir))


@query("get_requests", _TO_TAB + "SELECT session_id, request_id, status FROM tab WHERE request_id IN ('REQ-1', 'REQ-5')")
def get_requests(spark, sf_dir):
    users = X.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("session_id"), F.explode(F.array(F.lit("REQ-1"), F.lit("REQ-5"))).alias("request_id")
    )
    return R.get_requests(_table(spark, sf_dir), users).select("session_id", "request_id", "status")


@query(
    "backlog_state_capped",
    f"WITH {EVENTS}, {ASKED}, {ADMITTED}, {HELD}, {CAPPED_REQUESTS}, {REPLIES}, {TABLE} SELECT session_id, request_id, no AS request_no, placeholder, "
    "'EMAIL' AS entity_type, original_text, reason, context, status, follow_up_message, response_message FROM tab",
)
def backlog_state(spark, sf_dir):
    ev = X.backlog_events(spark, sf_dir)
    req = written(R.create_requests(ev, cap=3, max_mappings=4), "requests")
    return R.request_table(req, R.resolve_replies(ev, req)).drop("created_at", "resolved_at")


# --- G: audit ----------------------------------------------------------------


@query(
    "audit_guardrail_scan",
    full("inbound") + _SUMMARY_CTES + f" SELECT 'guardrail_scan' AS event, 'prompt' AS source, record_id, {_SUMMARY_COLUMNS} FROM {_SUMMARY_JOIN}",
)
def audit_guardrail_scan(spark, sf_dir):
    df = G.audit_guardrail_scan(C.inbound_advisory(_with_ner(spark, sf_dir, "inbound"), POLICY, ner=True), POLICY)
    return df.select(
        "event", "source", "record_id", long("total_entities").alias("total"),
        *[long(x).alias(x) for x in ("blocked", "warned", "redacted")],
        *[names(f"{x}_labels").alias(f"{x}_labels") for x in ("blocked", "warned", "redacted")],
    )


def _audit_sql(channel: str, event: str, extra: str) -> str:
    return (
        structured(True, channel) + ", " + labels_of()
        + f" SELECT {q(event)} AS event, record_id, session_id, n AS total_entities, labels, {extra} FROM labs JOIN texts USING (record_id)"
    )


def _audit_columns(df: DataFrame, *extra: str) -> DataFrame:
    return df.select("event", "record_id", "session_id", long("total_entities").alias("total_entities"), names("labels").alias("labels"), *extra)


@query("audit_tool_result", _audit_sql("tool_result", "tool_result_scan", "tool_name, 'tool_result' AS source"))
def audit_tool_result(spark, sf_dir):
    df = C.tool_result_redact(corpus(spark, sf_dir, "tool_result"), POLICY)
    return _audit_columns(G.audit_tool_result(df, POLICY), "tool_name", "source")


@query("audit_outbound", _audit_sql("outbound", "outbound_scan", "channel_id, 'outbound' AS source"))
def audit_outbound(spark, sf_dir):
    df = C.outbound_redact(corpus(spark, sf_dir, "outbound"), POLICY)
    return _audit_columns(G.audit_outbound(df, POLICY), "channel_id", "source")


@query("audit_reply_payload", _audit_sql("reply_payload", "reply_payload_redacted", "CAST(NULL AS VARCHAR) AS source"))
def audit_reply_payload(spark, sf_dir):
    df = corpus(spark, sf_dir, "reply_payload").withColumn("payload", F.struct("text"))
    return _audit_columns(G.audit_reply_payload(C.reply_payload_redact(df, POLICY), POLICY), "source")


@query(
    "audit_blocked",
    structured(True, "inbound") + ", " + labels_of(f"({ACTION}) = 'block'", name="lb")
    + " SELECT 'run_blocked' AS event, record_id, n AS blocked, labels AS blocked_labels FROM lb",
)
def audit_blocked(spark, sf_dir):
    df = G.audit_blocked(C.inbound_gate(corpus(spark, sf_dir, "inbound"), POLICY), POLICY)
    return df.select("event", "record_id", long("blocked").alias("blocked"), names("blocked_labels").alias("blocked_labels"))


@query(
    "audit_request_created",
    _TO_REQ + "SELECT 'access_request_created' AS event, session_id, request_id, 'EMAIL' AS entity_type, 'backlog' AS source FROM req",
)
def audit_request_created(spark, sf_dir):
    df = G.audit_request_created(R.create_requests(X.backlog_events(spark, sf_dir)), POLICY)
    return df.select("event", "session_id", "request_id", "entity_type", "source")


@query(
    "audit_request_resolved",
    _TO_REP + "SELECT 'access_request_resolved' AS event, session_id, 'REQ-' || no AS request_id, action, 'EMAIL' AS entity_type, 'backlog' AS source FROM rep WHERE error IS NULL",
)
def audit_request_resolved(spark, sf_dir):
    df = G.audit_request_resolved(_replies(spark, sf_dir)[1], POLICY)
    return df.select("event", "session_id", "request_id", "action", "entity_type", "source")


_FACTS = (
    structured(True) + f", facts AS (SELECT record_id, channel, ts, label, {ACTION} AS action, sha256(txt) AS digest FROM ents JOIN texts USING (record_id))"
)


def _facts(spark, sf_dir) -> DataFrame:
    return G.span_facts(C.scan(corpus(spark, sf_dir), POLICY), POLICY)


@query(
    "audit_rollup",
    _FACTS + " SELECT channel, label, action, count(*) AS entities, count(DISTINCT record_id) AS records, count(DISTINCT digest) AS distinct_values, "
    "grouping(channel, label, action)::BIGINT AS level FROM facts GROUP BY CUBE (channel, label, action)",
)
def audit_rollup(spark, sf_dir):
    df = G.audit_rollup(_facts(spark, sf_dir))
    return df.withColumn("level", long("level"))


@query(
    "audit_hourly",
    _FACTS + " SELECT epoch(date_trunc('hour', ts))::BIGINT AS hour, channel, label, action, count(*) AS entities FROM facts GROUP BY 1, 2, 3, 4",
)
def audit_hourly(spark, sf_dir):
    df = G.audit_hourly(_facts(spark, sf_dir))
    return df.withColumn("hour", F.unix_timestamp("hour"))


# --- A: sinks ----------------------------------------------------------------


def _spans_and_map(event: str) -> str:
    return (
        f" UNION ALL SELECT 'entities', {q(event)}, record_id, row_number() OVER (PARTITION BY record_id ORDER BY start_pos) - 1, txt, label FROM ents"
        f" UNION ALL SELECT 'mapping', {q(event)}, record_id, row_number() OVER (PARTITION BY record_id ORDER BY start_pos DESC) - 1, txt, placeholder FROM red_r"
    )


def _enforced_sinks(channel: str, event: str) -> str:
    return (
        structured(True, channel) + ", " + labels_of() + ", " + replaced()
        + f" SELECT 'redacted' AS sink, {q(event)} AS event, record_id, 0::BIGINT AS idx, redacted_text AS value, NULL::VARCHAR AS label FROM red"
        + _spans_and_map(event)
        + f" UNION ALL SELECT 'audit', {q(event)}, record_id, n, labels, NULL FROM labs"
    )


_ADVISED_SINKS = (
    full("inbound") + _SUMMARY_CTES + ", " + _REDACTED_PART + ", " + replaced("rpart")
    + f", s AS (SELECT record_id, {_SUMMARY_COLUMNS}, {_NOTICE} AS notice FROM {_SUMMARY_JOIN} LEFT JOIN red USING (record_id))"
    " SELECT 'redacted' AS sink, 'guardrail_scan' AS event, record_id, 0::BIGINT AS idx, notice AS value, NULL::VARCHAR AS label FROM s"
    + _spans_and_map("guardrail_scan")
    + " UNION ALL SELECT 'audit', 'guardrail_scan', record_id, total, blocked_labels || ';' || warned_labels || ';' || redacted_labels, 'prompt' FROM s"
)
_GATED_SINKS = (
    structured(True, "inbound") + ", " + labels_of(f"({ACTION}) = 'block'", name="lb")
    + " SELECT 'redacted' AS sink, 'run_blocked' AS event, record_id, 0::BIGINT AS idx, CASE WHEN n > 0 THEN 'block' ELSE 'pass' END AS value, "
    f"{q(C.BLOCK_REASON)} || labels AS label FROM texts LEFT JOIN lb USING (record_id) UNION ALL SELECT 'audit', 'run_blocked', record_id, n, labels, NULL FROM lb"
)
_CHANNEL_SINKS = [
    _enforced_sinks("outbound", "outbound_scan"), _enforced_sinks("reply_payload", "reply_payload_redacted"),
    _enforced_sinks("tool_result", "tool_result_scan"), _ADVISED_SINKS, _GATED_SINKS,
]


@query("sink_rows_all_channels", " UNION ALL ".join(f"SELECT * FROM ({s})" for s in _CHANNEL_SINKS))
def all_sinks(spark, sf_dir):
    """What every channel job hands to the sinks; tool results and payloads as rewritten messages and payloads."""
    from veiltext.functions.messages import extract_text
    from veiltext.sources.sinks import sink_rows

    tools = corpus(spark, sf_dir, "tool_result")
    content = F.to_json(F.struct(F.lit("tool").alias("role"), F.col("text").alias("content")))
    replies = corpus(spark, sf_dir, "reply_payload").withColumn("payload", F.struct("text")).drop("text")
    jobs = {
        "outbound_scan": C.outbound_redact(corpus(spark, sf_dir, "outbound"), POLICY),
        "reply_payload_redacted": C.reply_payload_redact(replies, POLICY),
        "tool_result_scan": C.tool_result_redact(tools.withColumn("raw", content).drop("text"), POLICY, message="raw"),
        "guardrail_scan": C.inbound_advisory(_with_ner(spark, sf_dir, "inbound"), POLICY, ner=True),
        "run_blocked": C.inbound_gate(corpus(spark, sf_dir, "inbound"), POLICY),
    }
    out = None
    for event, df in jobs.items():
        rows = sink_rows(df, event, message="raw")
        parts = F.concat_ws(";", *[F.array_join(f"{x}_labels", ", ") for x in ("blocked", "warned", "redacted")])
        labels = F.when(F.lit(event == "guardrail_scan"), parts).when(F.lit(event == "run_blocked"), names("blocked_labels")).otherwise(names("labels"))
        delivered = F.coalesce(
            F.when(F.lit(event == "run_blocked"), F.col("outcome")), "redacted_text", F.when(F.col("message").isNotNull(), extract_text("message")), F.get_json_object("payload", "$.text"), "notice", "outcome"
        )
        is_ = lambda s: F.col("sink") == s
        got = rows.select(
            "sink", F.lit(event).alias("event"), "record_id",
            F.when(is_("audit"), F.coalesce("total_entities", "blocked")).when(is_("redacted"), 0).otherwise(F.col("idx")).cast("bigint").alias("idx"),
            F.when(is_("redacted"), delivered).when(is_("entities"), F.col("text")).when(is_("mapping"), F.col("original")).otherwise(labels).alias("value"),
            F.when(is_("redacted"), F.col("reason")).when(is_("entities"), F.col("label")).when(is_("mapping"), F.col("placeholder"))
            .when(F.lit(event == "guardrail_scan"), F.col("source")).alias("label"),
        )
        out = got if out is None else out.unionByName(got)
    return out
