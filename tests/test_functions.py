"""Labels, overlaps, redaction and messages: golden cases, then random spans against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from veiltext.functions.labels import canonical, canonical_label, ner_labels
from veiltext.functions.messages import extract_text, replace_text
from veiltext.functions.overlap import resolve_overlaps
from veiltext.functions.redact import placeholders, redact
from veiltext.functions.schema import ENTITIES


def e(text, label, start, end, conf=1.0, source="regex"):
    return (text, label, start, end, conf, source)


def spans(text, *found):
    """Entities at the first place of each value in the text."""
    out = []
    for value, label in found:
        at = text.index(value)
        out.append(e(value, label, at, at + len(value)))
    return out


def one(spark, text, es, strategy="token"):
    df = spark.createDataFrame([(text, es)], f"text string, es {ENTITIES}")
    r = df.select(redact("text", "es", strategy).alias("r")).head().r
    return r.redacted_text, [(m.placeholder, m.original) for m in r.mapping]


def test_canonical_labels(spark):
    raw = ["dob", " Zip\n", "per", "ORG", "gpe", "loc", "fac", "phone_number", "date of birth", " ssn", "x"]
    df = spark.createDataFrame([(x,) for x in raw], "l string")
    got = [r.c for r in df.select(canonical_label("l").alias("c")).collect()]
    assert got == [canonical(x) for x in raw]
    assert got[8:10] == ["DATE OF BIRTH", "SSN"]


def test_ner_labels(spark):
    df = spark.createDataFrame([(["project", "person"], None), (["a"], ["a", "b"])], "c array<string>, x array<string>")
    got = [r.n for r in df.select(ner_labels(F.col("c"), F.col("x")).alias("n")).collect()]
    assert got[0][-1] == "project" and len(got[0]) == 9
    assert got[1][-2:] == ["a", "b"]


TWO = "Email alice@a.com and bob@b.com please."


@pytest.mark.parametrize(
    "text,found,strategy,want",
    [
        (TWO, [("alice@a.com", "EMAIL"), ("bob@b.com", "EMAIL")], "token", "Email [EMAIL_2] and [EMAIL_1] please."),
        ("Contact john@example.com for info.", [("john@example.com", "EMAIL")], "mask", "Contact **************** for info."),
        ("Contact john@example.com for info.", [("john@example.com", "EMAIL")], "hash", "Contact [EMAIL_855f96e983f1] for info."),
        (
            "A: Alice B: bob@b.com C: 555-0000",
            [("555-0000", "PHONE"), ("Alice", "PERSON"), ("bob@b.com", "EMAIL")],
            "token",
            "A: [PERSON_1] B: [EMAIL_1] C: [PHONE_1]",
        ),
        ("nothing", [], "token", "nothing"),
    ],
)
def test_redaction(spark, text, found, strategy, want):
    assert one(spark, text, spans(text, *found), strategy)[0] == want


def test_mapping_order_and_collisions(spark):
    text = "aa@x.org bb@x.org aa@x.org"
    es = [e(text[i : i + 8], "EMAIL", i, i + 8) for i in (0, 9, 18)]
    assert one(spark, text, es)[1] == [("[EMAIL_1]", "aa@x.org"), ("[EMAIL_2]", "bb@x.org"), ("[EMAIL_3]", "aa@x.org")]
    assert one(spark, text, es, "mask")[1] == [("********", "aa@x.org")]
    assert [v for _, v in one(spark, text, es, "hash")[1]] == ["aa@x.org", "bb@x.org"]
    df = spark.createDataFrame([(text, es)], f"text string, es {ENTITIES}")
    shown = df.select(placeholders(redact("text", "es", "mask")["mapping"]).alias("p")).head().p
    assert shown == ["********"]


def test_empty_span_masks_as_one(spark):
    assert one(spark, "A B", [e("", "X", 1, 1)], "mask")[0] == "A* B"


def test_splice_keeps_stale_offsets(spark):
    text = "token=5551234567 ok"
    es = [e("token=5551234567", "TOKEN", 0, 16), e("5551234567", "PHONE", 6, 16)]
    assert one(spark, text, es)[0] == "[TOKEN_1]ok"


def py_resolve(es):
    kept = []
    for x in sorted(es, key=lambda x: (x[2], -x[4])):
        if kept and x[2] < kept[-1][3]:
            if x[4] > kept[-1][4]:
                kept[-1] = x
        else:
            kept.append(x)
    return kept


def py_redact(text, es, strategy):
    counts, mapping = {}, {}
    for value, label, start, end, *_ in sorted(es, key=lambda x: -x[2]):
        counts[label] = counts.get(label, 0) + 1
        new = {
            "token": f"[{label}_{counts[label]}]",
            "mask": "*" * max(len(value), 1),
            "hash": f"[{label}_{hashlib.sha256(value.encode()).hexdigest()[:12]}]",
        }[strategy]
        mapping[new] = value
        text = text[:start] + new + text[end:]
    return text, list(mapping.items())


def test_random_spans_equal_plain_python(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        text = "".join(rng.choice("ab é\U0001f600c1") for _ in range(rng.choice([20, 60, 9000])))
        es = []
        for _ in range(rng.choice([0, 1, 2, 5, 12, 400])):
            s = rng.randrange(len(text))
            t = min(len(text), s + rng.randint(1, 9))
            es.append(e(text[s:t], rng.choice("XYZ"), s, t, rng.choice([0.2, 0.5, 0.9, 1.0])))
        rows.append((text, es))
    df = spark.createDataFrame(rows, f"text string, es {ENTITIES}").repartition(4)
    df = df.withColumn("rs", F.explode(F.array(resolve_overlaps("es"))))
    kinds = ("token", "mask", "hash")
    df = df.select("*", *[redact("text", "rs", k).alias(k) for k in kinds], redact("text", "es").alias("raw"))
    for r in df.collect():
        want = py_resolve([tuple(x) for x in r.es])
        assert [tuple(x) for x in r.rs] == want
        for k in kinds:
            got = r[k]
            assert (got.redacted_text, [tuple(m) for m in got.mapping]) == py_redact(r.text, want, k)
        got = r.raw
        assert (got.redacted_text, [tuple(m) for m in got.mapping]) == py_redact(r.text, [tuple(x) for x in r.es], "token")


def test_overlap_chains(spark):
    chains = [
        ([e("", "A", 0, 5, 0.5), e("", "B", 3, 8, 0.9), e("", "C", 9, 12, 1.0)], "BC"),
        ([e("", "A", 0, 5, 0.9), e("", "B", 3, 8, 0.5), e("", "C", 6, 9, 0.4)], "AC"),
        ([e("", "A", 0, 5), e("", "B", 0, 9)], "A"),
        ([e("", "P", 0, 6, 0.8, "gliner"), e("", "E", 4, 9, 1.0)], "E"),
    ]
    df = spark.createDataFrame([(es,) for es, _ in chains], f"es {ENTITIES}")
    got = ["".join(x.label for x in r.r) for r in df.select(resolve_overlaps("es").alias("r")).collect()]
    assert got == [w for _, w in chains]


def test_many_spans_stay_fast(spark):
    """A log with a span every few characters: far from quadratic."""
    n = 60_000
    df = spark.range(1).select(
        F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.lpad(i.cast("string"), 5, "0")), " ").alias("text")
    )
    from veiltext.functions.detect import detect_structured

    df = df.withColumn("es", F.explode(F.array(resolve_overlaps(detect_structured("text")))))
    df = df.withColumn("r", F.explode(F.array(redact("text", "es"))))
    row = df.select(F.size("es").alias("n"), F.length("r.redacted_text").alias("k"), F.size("r.mapping").alias("m")).head()
    assert row.n == n and row.m == n and row.k > n * 12


MESSAGES = [
    ('"hello world"', "hello world"),
    ('{"role":"toolResult","content":"file contents here"}', "file contents here"),
    (
        '{"content":[{"type":"text","text":"visible"},{"type":"image","data":1},{"type":"text","text":"also visible"}]}',
        "visible\0also visible",
    ),
    ('{"content":[{"type":"text"},null,{"type":"text","text":5},{"type":"text","text":"x"}]}', "x"),
    ("null", ""), ("42", ""), ("{}", ""), ('{"content":null}', ""), ('{"content":[]}', ""),
    ('{"content":[{"type":"image"}]}', ""), ('{"content":123}', ""), (None, ""), ("[1]", ""),
    ("not json at all", "not json at all"),
]


def test_extract_and_replace(spark):
    import json

    df = spark.createDataFrame([(m,) for m, _ in MESSAGES], "m string")
    got = df.select("m", extract_text("m").alias("t"), replace_text("m", F.lit("one\0two \"q\"")).alias("n")).collect()
    assert [r.t for r in got] == [t for _, t in MESSAGES]
    new = {r.m: r.n for r in got}
    assert json.loads(new[MESSAGES[0][0]]) == 'one\0two "q"'
    assert json.loads(new[MESSAGES[1][0]]) == {"role": "toolResult", "content": 'one\0two "q"'}
    assert json.loads(new[MESSAGES[2][0]])["content"] == [
        {"type": "text", "text": "one"}, {"type": "image", "data": 1}, {"type": "text", "text": 'two "q"'}
    ]
    assert json.loads(new[MESSAGES[3][0]])["content"] == [
        {"type": "text"}, None, {"type": "text", "text": 5}, {"type": "text", "text": "one"}
    ]
    for m in ("null", "42", "{}", '{"content":null}', '{"content":123}', "[1]"):
        assert json.loads(new[m]) == json.loads(m)
    assert new[None] is None


def test_unreadable_json_hides_nothing(spark):
    from veiltext.plans.channels import tool_result_redact
    from veiltext.sources.policies import Policy

    raw = '{"content":"joe\\u0040x.org, 10\\u00245, \\\\u0041 \\u00e9\\ud83d\\ude00\\u0022\\ud800","a":1,"a":2'
    df = spark.createDataFrame([("r", raw)], "record_id string, message string")
    assert df.select(extract_text("message")).head()[0] == '{"content":"joe@x.org, 10$5, \\\\u0041 é\U0001f600\\u0022\\ud800","a":1,"a":2'
    out = tool_result_redact(df, Policy(), message="message").head().message
    assert out.startswith('{"content":"[EMAIL_1], 10$5, \\\\u0041 ') and out.endswith(',"a":1,"a":2')


JSON_PARTS = ['"id":1234567890', '"n": 1.50', '"e":1e2', '"big":123456789012345678901234567890', '"a":1,"a":2', '"u":"\\u00e9\\/x@y.org"', '"o":{"content":"deep@x.org","type":"text","text":"t"}', '"l":[[],{},"s"]']


def _string(rng, value):
    """A JSON string of the value with some characters escaped."""
    import json

    out = "".join(json.dumps(c)[1:-1] if rng.random() < 0.2 else c if c not in '"\\\n' else json.dumps(c)[1:-1] for c in value)
    return f'"{out}"'


def test_messages_stay_as_they_are_but_for_their_text(spark):
    """Random messages: the text is what a JSON reader gives, and only text strings change, byte for byte."""
    import json
    import random

    rng = random.Random(11)
    words = ["joe@x.org", "a\"b", "\\", "é", "\U0001f600", "\n", "x{y}[z]:,", "content", "text", ""]
    cases = []
    for _ in range(400):
        blank = lambda: rng.choice(["", " ", "\n\t"])
        say = lambda: " ".join(rng.choices(words, k=rng.randrange(4)))
        kind = rng.randrange(4)
        if kind == 0:
            value = say()
            cases.append((blank() + _string(rng, value) + blank(), value, [value]))
            continue
        parts = [("x", p) for p in rng.sample(JSON_PARTS, rng.randrange(4))]
        values = []
        if kind == 1:
            values = [say()]
            parts.append(("v", '"content":' + blank() + _string(rng, values[0])))
        elif kind == 2:
            blocks = []
            for _ in range(rng.randrange(5)):
                fields = ['"type":' + rng.choice(['"text"', '"image"', "5", '"t\\u0065xt"']), '"text":' + blank() + rng.choice([_string(rng, say()), "7", "null"])]
                fields += rng.sample(JSON_PARTS, rng.randrange(3))
                rng.shuffle(fields)
                blocks.append(rng.choice(["{" + ",".join(fields) + "}", "null", '"text"', "{" + ",".join(fields) + "}", '[{"type":"text","text":"in"}]']))
            parts.append(("b", '"content":[' + (blank() + ",").join(blocks) + "]"))
        rng.shuffle(parts)
        raw = "{" + blank() + ",".join(p for _, p in parts) + blank() + "}"
        doc = json.loads(raw)
        content = doc.get("content")
        if isinstance(content, list):
            values = [b["text"] for b in content if isinstance(b, dict) and b.get("type") == "text" and isinstance(b.get("text"), str)]
        cases.append((raw, "\0".join(values), values))
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, m string")
    changed = F.replace(extract_text("m"), F.lit("joe@x.org"), F.lit('[E\\"1]'))
    got = {r.i: r for r in df.select("i", extract_text("m").alias("t"), replace_text("m", extract_text("m")).alias("same"), replace_text("m", changed).alias("n")).collect()}
    seen = 0
    for i, (raw, text, values) in enumerate(cases):
        assert got[i].t == text and got[i].same == raw, raw
        want = json.loads(raw)
        new = [v.replace("joe@x.org", '[E\\"1]') for v in values]
        if isinstance(want, str):
            want = new[0]
        elif isinstance(want.get("content"), str):
            want["content"] = new[0]
        elif isinstance(want.get("content"), list):
            rest = iter(new)
            for b in want["content"]:
                if isinstance(b, dict) and b.get("type") == "text" and isinstance(b.get("text"), str):
                    b["text"] = next(rest)
        assert json.loads(got[i].n) == want, raw
        outside = [p for p in JSON_PARTS if p in raw]
        assert all(p in got[i].n for p in outside)
        seen += new != values
    assert seen > 20


def test_repeated_keys_and_one_value_only(spark):
    cases = {
        '{"content":"x@y.org","content":"b"}': ("b", '{"content":"","content":"B"}'),
        '{"content":[{"type":"text","text":"x@y.org"}],"content":"b"}': ("b", '{"content":[{"type":"text","text":""}],"content":"B"}'),
        '{"content":"x@y.org","content":[{"text":"1","type":"text","text":"b"}]}': ("b", '{"content":"","content":[{"text":"","type":"text","text":"B"}]}'),
        '{"content":"x","content":5}': ("", '{"content":"x","content":5}'),
        '"a" "b"': ('"a" "b"', "B"),
        '{"content":"a"} x': ('{"content":"a"} x', "B"),
        '["a"],["b"]': ('["a"],["b"]', "B"),
        '{"content":"\\x"}': ('{"content":"\\x"}', "B"),
        '{"c\\u006Fntent":"b"}': ("b", '{"c\\u006Fntent":"B"}'),
    }
    df = spark.createDataFrame([(m,) for m in cases], "m string")
    assert {r.m: (r.t, r.n) for r in df.select("m", extract_text("m").alias("t"), replace_text("m", F.lit("B")).alias("n")).collect()} == cases


def test_long_messages(spark):
    """A string of a million escapes, and five thousand blocks, in reasonable time."""
    import json
    import time

    one = json.dumps({"content": "é" * 300_000 + 'q"' * 100_000})
    many = json.dumps({"content": [{"type": "text", "text": f"t{i}"} for i in range(5_000)]})
    df = spark.createDataFrame([(1, one), (2, many)], "i int, m string")
    start = time.time()
    out = {r.i: r for r in df.select("i", extract_text("m").alias("t"), replace_text("m", F.upper(extract_text("m"))).alias("n")).collect()}
    assert time.time() - start < 60
    assert out[1].t == json.loads(one)["content"] and json.loads(out[1].n)["content"] == out[1].t.upper()
    assert out[2].t.split("\0")[4_999] == "t4999" and json.loads(out[2].n)["content"][7] == {"type": "text", "text": "T7"}
