"""The corpus and the span tables in plain SQL for the comparison engine (RE2: no look-around)."""

from __future__ import annotations

# --- fixed values: the rules must find the same strings as the detectors. RE2 has no look-around, so
# what stands before a span is group 1 and what follows it is consumed.
WS = r"\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
MONTH = (
    r"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?"
    r"|Sep(?:t(?:ember)?)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
)

# label -> pattern with group 1 = what stands before the span, group 2 = the span
RE2 = {
    "EMAIL": r"(?i)((?:^|[^A-Za-z0-9._%+\-@])(?:[A-Za-z_]{2,20}=)*)"
    r"([A-Za-z0-9!#$%&*+\-/=^_`{|}~][A-Za-z0-9!#$%&'*+\-/=?^_`{|}~.]*@(?:\.?[A-Za-z0-9-]+\.)+[A-Za-z]{2,})",
    "PHONE": r"(^|[^A-Za-z0-9])"
    rf"((?:\+?1[-.{WS}]?)?(?:\([0-9]{{3}}\)|[0-9]{{3}})[-.{WS}]?[0-9]{{3}}[-.{WS}]?[0-9]{{4}}"
    rf"|\+[0-9]{{1,3}}[-.{WS}]?[0-9]{{1,4}}(?:[-.{WS}]?[0-9]{{2,4}}){{2,3}})(?:$|[^-A-Za-z0-9])",
    "SSN": r"(^|[^0-9])([0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{9})(?:$|[^0-9])",
    "CREDIT_CARD": r"()\b(4[0-9]{12}(?:[0-9]{3})?|5[1-5][0-9]{14}|3[47][0-9]{13}"
    rf"|(?:4[0-9]{{3}}|5[1-5][0-9]{{2}}|3[47][0-9]{{2}})[-{WS}]?[0-9]{{4}}[-{WS}]?[0-9]{{4}}[-{WS}]?[0-9]{{4}}"
    rf"|3[47][0-9]{{2}}[-{WS}]?[0-9]{{6}}[-{WS}]?[0-9]{{5}})\b",
    "SECRET": r"(?i)()\b((?:secret|client[_-]?secret|app[_-]?secret|password|passwd|pwd|private[_-]?key)"
    rf"[{WS}]*[:=][{WS}]*[\"']?[A-Za-z0-9._~+/=\-]{{8,}}[\"']?)",
    "TOKEN": r"(?i)()\b((?:token|access[_-]?token|refresh[_-]?token|api[_-]?key|authorization)"
    rf"[{WS}]*[:=][{WS}]*[\"']?(?:Bearer[{WS}]+)?[A-Za-z0-9._~+/=\-]{{8,}}[\"']?)",
    "IP_ADDRESS": rf"()\b({OCTET}\.{OCTET}\.{OCTET}\.{OCTET})\b",
    "DATE": r"(?i)()\b((?:0?[1-9]|1[0-2])[/-](?:0?[1-9]|[12][0-9]|3[01])[/-](?:[0-9]{4}|[0-9]{2})"
    r"|[0-9]{4}-(?:0?[1-9]|1[0-2])-(?:0?[1-9]|[12][0-9]|3[01])"
    rf"|{MONTH}[{WS}]+(?:0?[1-9]|[12][0-9]|3[01]),[{WS}]+(?:19|20)[0-9]{{2}})\b",
    "ZIP_CODE": r"()\b([0-9]{5}(?:-[0-9]{4})?)\b",
}
# ---
LABELS = list(RE2)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


NOTES = """
SELECT 'note-' || o_orderkey AS record_id,
  CASE o_orderkey % 3 WHEN 0 THEN 'inbound' WHEN 1 THEN 'outbound' ELSE 'reply_payload' END AS channel,
  'cust-' || (o_custkey % 50) AS session_id, o_orderkey AS seq, o_orderdate AS ts,
  CAST(NULL AS VARCHAR) AS tool_name, o_orderpriority AS channel_id,
  CASE o_orderkey % 8
    WHEN 0 THEN 'Order ' || o_orderkey || ' of cust.' || o_custkey || '@mail.example.com placed '
      || strftime(o_orderdate, '%m/%d/%Y') || ', ship to ZIP ' || p5 || '.'
    WHEN 1 THEN 'Use token=555' || c3 || p4 || ' ok, then call 555-' || c3 || '-' || p4 || '.'
    WHEN 2 THEN 'SSN ' || c3 || '-' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') || '-' || p4
      || ' card 4111-' || p4 || '-' || p4 || '-' || p4 || '.'
    WHEN 3 THEN 'password: user.' || o_custkey || '@corp.example.org, again user.' || o_custkey || '@corp.example.org'
    WHEN 4 THEN 'No personal data in this note, priority ' || o_orderpriority || '.'
    WHEN 5 THEN 'Call (555) ' || c3 || '-' || p4 || ' or +44 20 7946 ' || p4 || ' from 10.' || (o_orderkey % 256)
      || '.' || (o_custkey % 300) || '.1.'
    WHEN 6 THEN 'Born ' || strftime(o_orderdate, '%b ') || day(o_orderdate) || strftime(o_orderdate, ', %Y') || ' and '
      || strftime(o_orderdate, '%Y-%m-%d') || ', api_key: Bearer key_' || o_orderkey || 'abcdef.'
    ELSE 'email=cust.' || o_custkey || '@shop.example.net;noreply@example.com ZIP ' || p5 || '-' || p4 END AS text
FROM (SELECT *, lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS p4,
    lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS p5, lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') AS c3
  FROM orders)"""

CORPUS = f"""corpus AS (
SELECT 'conv-' || conv_id || '-' || turn AS record_id,
  CASE role WHEN 'user' THEN 'inbound' WHEN 'assistant' THEN 'outbound' ELSE 'tool_result' END AS channel,
  'conv-' || conv_id AS session_id, turn AS seq, TIMESTAMP '2024-01-01' + to_minutes(conv_id * 10 + turn) AS ts,
  CASE WHEN role = 'system' THEN 'setup' END AS tool_name, 'chat' AS channel_id, text
FROM conversations WHERE text <> ''
UNION ALL SELECT 'doc-' || doc_id, 'tool_result', source, doc_id, TIMESTAMP '2024-01-01' + to_minutes(doc_id),
  'file_read', NULL, text FROM documents WHERE text <> ''
UNION ALL SELECT 'page-' || page_id, 'tool_result', 'web', page_id, TIMESTAMP '2024-01-01' + to_minutes(page_id),
  'web_fetch', NULL, html FROM pages WHERE html <> ''
UNION ALL {NOTES})"""


def rule_spans(label: str, rank: int, pattern: str, src: str) -> str:
    """(record_id, label, rank, start_pos, end_pos, txt) of one rule over ``src(record_id, text)``."""
    p = q(pattern)
    return f"""SELECT * FROM (SELECT record_id, {q(label)} AS label, {rank} AS rank,
  start_pos, start_pos + length(txt) AS end_pos, txt FROM (
  SELECT record_id, c[i] AS txt, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) +
    coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) + length(b[i]) AS BIGINT) AS start_pos
  FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM (
    SELECT record_id, string_split_regex(text, {p}) AS g, regexp_extract_all(text, {p}, 0) AS f,
      regexp_extract_all(text, {p}, 1) AS b, regexp_extract_all(text, {p}, 2) AS c
    FROM {src} WHERE regexp_matches(text, {p})))))"""


def label_spans(label: str, src: str) -> str:
    """``rule_spans`` of one structured label."""
    valid = (
        "WHERE left(txt, 3) NOT IN ('000', '666') AND substr(replace(txt, '-', ''), 4, 2) <> '00' AND right(txt, 4) <> '0000'"
        if label == "SSN"
        else ""
    )
    return rule_spans(label, LABELS.index(label), RE2[label], src) + "\n" + valid


# The user's rules of the registered queries: label, what a rule of the user's says, in their order.
CUSTOM = [
    ("CUSTOMER ID", r"(?i)CUST\.[0-9]+"),
    ("KEY", r"key_[0-9]+[a-f]{2,}"),
    ("ORDER_NO", r"Order [0-9]+"),
    ("PRIORITY", r"(?:1-URGENT|2-HIGH|3-MEDIUM|4-NOT SPECIFIED|5-LOW)"),
    ("EMAIL", r"user\.[0-9]+@corp"),
]


def custom_spans(src: str) -> str:
    return "\nUNION ALL ".join(rule_spans(label, len(LABELS) + k, f"()({pattern})", src) for k, (label, pattern) in enumerate(CUSTOM))


def found(src: str = "corpus", custom: bool = False) -> str:
    """CTE ``found``: the spans of all labels (and of the user's rules), overlaps included."""
    parts = [label_spans(x, src) for x in LABELS] + ([custom_spans(src)] if custom else [])
    return "found AS (" + "\nUNION ALL ".join(parts) + ")"


ALLOWED = r"""(lower(trim(txt)) = 'noreply@example.com'
  OR (length(txt) <= 512 AND (regexp_full_match(txt, 'cust\.1[0-9]*@.*', 'i') OR regexp_full_match(txt, '5550', 'i')))
  OR (label = 'ZIP_CODE' AND lower(trim(txt)) IN ('00008', '00015-0015'))
  OR (label = 'PERSON' AND lower(trim(txt)) = 'order 10'))"""

ACTION = """CASE WHEN label IN ('SSN', 'CREDIT_CARD') THEN 'block'
  WHEN label IN ('IP_ADDRESS', 'PERSON') THEN 'warn' ELSE 'redact' END"""


def resolved(src: str, name: str = "ents") -> str:
    """CTE: spans (with ``conf`` and ``ord``) of each record after overlap resolution, by a list fold."""
    return f"""{name} AS (SELECT record_id, e.label AS label, e.s AS start_pos, e.e AS end_pos, e.txt AS txt, e.conf AS conf
FROM (SELECT record_id, unnest(list_reduce(es, lambda a, x: CASE
    WHEN x[1].s >= a[len(a)].e THEN list_concat(a, x)
    WHEN x[1].conf > a[len(a)].conf THEN list_concat(a[1:len(a) - 1], x) ELSE a END)) AS e
  FROM (SELECT record_id, list([{{'s': start_pos, 'e': end_pos, 'label': label, 'txt': txt, 'conf': conf}}]
      ORDER BY start_pos, conf DESC, ord) AS es
    FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY src, start_pos, end_pos, rank) AS ord FROM {src})
    GROUP BY record_id)))"""


def structured(policy: bool, channel: str | None = None) -> str:
    """CTEs up to ``ents``: structured spans, allowlist applied if ``policy``, resolved."""
    where = f" WHERE channel = {q(channel)}" if channel else ""
    keep = f" WHERE NOT {ALLOWED}" if policy else ""
    return (
        f"WITH {CORPUS}, texts AS (SELECT * FROM corpus{where}), {found('texts')}, "
        f"kept AS (SELECT *, 1.0::DOUBLE AS conf, 0 AS src FROM found{keep}), {resolved('kept')}"
    )


NER_TABLE = """nspans AS (SELECT record_id, rank, label, (base + s)::BIGINT AS start_pos, (base + e)::BIGINT AS end_pos,
    substr(text, base + s + 1, e - s) AS txt, ((seq * m + rank * 29) % 101) / 100.0::DOUBLE AS score
  FROM (SELECT *, (seq * 7919 + 13) % greatest(length(text) - 19, 1) AS base FROM corpus WHERE length(text) >= 3),
    (VALUES (0, 0, 8, 'PERSON', 37), (1, 5, 14, 'ORGANIZATION', 53), (2, 11, 20, 'DATE OF BIRTH', 71)) v(rank, s, e, label, m)
  WHERE length(text) >= base + e)"""

CONFIDENT = "score >= CASE label WHEN 'PERSON' THEN 0.6 WHEN 'ORGANIZATION' THEN 0.2 ELSE 0.4 END"


def full(channel: str | None = None) -> str:
    """CTEs up to ``ents``: structured and NER spans under the policy, resolved."""
    where = f" WHERE channel = {q(channel)}" if channel else ""
    return (
        f"WITH {CORPUS}, texts AS (SELECT * FROM corpus{where}), {found('texts')}, {NER_TABLE}, "
        f"kept AS (SELECT record_id, label, rank, start_pos, end_pos, txt, 1.0::DOUBLE AS conf, 0 AS src FROM found "
        f"WHERE NOT {ALLOWED} UNION ALL SELECT record_id, label, rank, start_pos, end_pos, txt, score, 1 AS src "
        f"FROM nspans WHERE {CONFIDENT} AND NOT {ALLOWED} AND record_id IN (SELECT record_id FROM texts)), {resolved('kept')}"
    )


def replaced(src: str = "ents", strategy: str = "token", name: str = "red") -> str:
    """CTEs ``{name}_r`` (placeholder per span) and ``{name}`` (redacted text per record with spans)."""
    forms = {
        "token": "'[' || label || '_' || row_number() OVER (PARTITION BY record_id, label ORDER BY start_pos DESC) || ']'",
        "mask": "repeat('*', greatest(length(txt), 1))",
        "hash": "'[' || label || '_' || left(sha256(txt), 12) || ']'",
    }
    return f"""{name}_r AS (SELECT *, {forms[strategy]} AS placeholder,
    coalesce(lag(end_pos) OVER (PARTITION BY record_id ORDER BY start_pos), 0) AS prev_end FROM {src}),
{name} AS (SELECT r.record_id, string_agg(substr(t.text, r.prev_end + 1, r.start_pos - r.prev_end) || r.placeholder, ''
      ORDER BY r.start_pos) || substr(any_value(t.text), max(r.end_pos) + 1) AS redacted_text
  FROM {name}_r r JOIN texts t USING (record_id) GROUP BY r.record_id)"""


def labels_of(where: str = "TRUE", src: str = "ents", name: str = "labs") -> str:
    """CTE: per record count and labels, in the order of their first span."""
    return f"""{name} AS (SELECT record_id, sum(n)::BIGINT AS n, string_agg(label, ', ' ORDER BY first) AS labels FROM (
    SELECT record_id, label, count(*) AS n, min(start_pos) AS first FROM {src} WHERE {where} GROUP BY record_id, label)
  GROUP BY record_id)"""
