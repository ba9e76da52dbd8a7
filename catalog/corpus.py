"""Text records of the given tables, for the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veiltext.sources.policies import policy_from
from veiltext.sources.texts import texts_from, union_texts

POLICY_CONFIG = {
    "guardrail_mode": "redact",
    "entityActions": {
        "ssn": "block",
        "credit_card_number": "block",
        "IP_ADDRESS": "warn",
        "PERSON": "warn",
    },
    "confidence_threshold": 0.4,
    "entityConfidenceThresholds": {"PERSON": 0.6, "org": 0.2},
    "allowlist": {
        "values": ["noreply@example.com", " NoReply@example.com "],
        "patterns": [r"cust\.1[0-9]*@.*", "5550"],
        "entities": {"zip": ["00008", "00015-0015"], "PERSON": ["order 10"]},
    },
}
#: Rows for each task over what ``spread`` deals out: a second or a few of work.
SHORT_ROWS, LONG_ROWS = 20000, 2000
POLICY = policy_from(POLICY_CONFIG)
PLAIN = policy_from({})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, rows_a_task: int, *keys: str) -> DataFrame:
    """The same rows dealt by their keys over as many tasks as their number asks for; few rows stay where they are.

    A scan cannot divide a row group, and a few MB of keys can stand for hours of work on the texts made from them;
    what is dealt out are the columns as they are read, before any text is built.
    """
    tasks = -(-df.count() // rows_a_task)
    return df.repartition(tasks, *keys) if tasks > df.rdd.getNumPartitions() else df


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def order_notes(spark, sf_dir) -> DataFrame:
    """A short note per order, written from its columns: all nine labels, overlaps, near misses."""
    o = spread(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
        SHORT_ROWS, "o_orderkey", "o_custkey", "o_orderdate",
    )
    k, c, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    p4, p5, c3 = _pad(k % 10000, 4), _pad(k % 100000, 5), _pad(c % 1000, 3)
    cat = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    fmt = lambda f: F.date_format(day, f)
    forms = [
        cat("Order ", _s(k), " of cust.", _s(c), "@mail.example.com placed ", fmt("MM/dd/yyyy"),
            ", ship to ZIP ", p5, "."),
        cat("Use token=555", c3, p4, " ok, then call 555-", c3, "-", p4, "."),
        cat("SSN ", c3, "-", _pad(k % 100, 2), "-", p4, " card 4111-", p4, "-", p4, "-", p4, "."),
        cat("password: user.", _s(c), "@corp.example.org, again user.", _s(c), "@corp.example.org"),
        cat("No personal data in this note, priority ", F.col("o_orderpriority"), "."),
        cat("Call (555) ", c3, "-", p4, " or +44 20 7946 ", p4, " from 10.", _s(k % 256), ".",
            _s(c % 300), ".1."),
        cat("Born ", fmt("MMM d, yyyy"), " and ", fmt("yyyy-MM-dd"), ", api_key: Bearer key_", _s(k),
            "abcdef."),
        cat("email=cust.", _s(c), "@shop.example.net;noreply@example.com ZIP ", p5, "-", p4),
    ]
    note = forms[-1]
    for i, f in enumerate(forms[:-1]):
        note = F.when(k % 8 == i, f).otherwise(note)
    channel = (
        F.when(k % 3 == 0, "inbound").when(k % 3 == 1, "outbound").otherwise("reply_payload")
    )
    return texts_from(
        o,
        text=note,
        record_id=F.concat(F.lit("note-"), _s(k)),
        channel=channel,
        session_id=F.concat(F.lit("cust-"), _s(c % 50)),
        seq=k,
        ts=day,
        channel_id=F.col("o_orderpriority"),
    )


def _at(n: Column) -> Column:
    """A time of its own for the n-th row of a table that has none."""
    return F.timestamp_seconds(F.lit(1704067200) + n * 60)


def conversations(spark, sf_dir) -> DataFrame:
    role = F.col("role")
    return texts_from(
        spread(table(spark, sf_dir, "conversations"), SHORT_ROWS, "conv_id", "turn", "text"),
        text="text",
        record_id=F.concat(F.lit("conv-"), _s("conv_id"), F.lit("-"), _s("turn")),
        channel=F.when(role == "user", "inbound")
        .when(role == "assistant", "outbound")
        .otherwise("tool_result"),
        session_id=F.concat(F.lit("conv-"), _s("conv_id")),
        seq="turn",
        ts=_at(F.col("conv_id") * 10 + F.col("turn")),
        tool_name=F.when(role == "system", "setup"),
        channel_id=F.lit("chat"),
    )


def documents(spark, sf_dir) -> DataFrame:
    return texts_from(
        spread(table(spark, sf_dir, "documents"), LONG_ROWS, "doc_id", "text"),
        text="text",
        record_id=F.concat(F.lit("doc-"), _s("doc_id")),
        channel="tool_result",
        session_id="source",
        seq="doc_id",
        ts=_at(F.col("doc_id")),
        tool_name=F.lit("file_read"),
    )


def pages(spark, sf_dir) -> DataFrame:
    return texts_from(
        spread(table(spark, sf_dir, "pages"), LONG_ROWS, "page_id", "url"),
        text="html",
        record_id=F.concat(F.lit("page-"), _s("page_id")),
        channel="tool_result",
        session_id=F.lit("web"),
        seq="page_id",
        ts=_at(F.col("page_id")),
        tool_name=F.lit("web_fetch"),
    )


def corpus(spark, sf_dir, channel: str | None = None) -> DataFrame:
    parts = [f(spark, sf_dir) for f in (conversations, documents, pages, order_notes)]
    df = union_texts(*parts)
    return df if channel is None else df.filter(F.col("channel") == channel)


def ner_table(spark, sf_dir) -> DataFrame:
    """Spans as a model would give them: up to three per text, anywhere in it, chained so that neighbours overlap."""
    key, n = F.col("seq"), F.length("text")
    some = corpus(spark, sf_dir).filter(n >= 3)
    some = some.withColumn("at", ((key * 7919 + 13) % F.greatest(n - 19, F.lit(1))).cast("int"))
    spans = [(0, 8, "person", 37), (5, 14, "org", 53), (11, 20, "date of birth", 71)]
    rows = [
        F.struct(
            F.lit(i).alias("ord"),
            F.col("text").substr(F.col("at") + (s + 1), F.lit(e - s)).alias("text"),
            F.lit(None).cast("string").alias("span_text"),
            F.lit(label).alias("label"),
            ((key * m + i * 29) % 101 / F.lit(100.0)).alias("score"),
            (F.col("at") + s).alias("start_pos"),
            (F.col("at") + e).alias("end_pos"),
            n.alias("n"),
        )
        for i, (s, e, label, m) in enumerate(spans)
    ]
    return some.select("record_id", F.inline(F.array(*rows))).filter("end_pos <= n").drop("n")


def backlog_events(spark, sf_dir) -> DataFrame:
    """Writes, requests and resolutions, one per row of ``events``; a session per user."""
    from veiltext.operators.requests import EVENTS
    from pyspark.sql import types as T

    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    is_ = lambda *ns: (i % 4).isin(*ns)
    req = lambda n: F.concat(F.lit("REQ-"), _s(n))
    cols = {
        "session_id": _s("user_id"),
        "seq": i,
        "ts": F.col("ts"),
        "kind": F.when(is_(0), "mapping").when(is_(1), "request").otherwise("resolve"),
        "placeholder": F.when(is_(0), F.concat(F.lit("[EMAIL_"), _s(k % 5 + 1), F.lit("]"))).when(
            is_(1), F.concat(F.lit("[EMAIL_"), _s(k % 6 + 1), F.lit("]"))
        ),
        "original": F.when(is_(0), F.concat(F.lit("user"), _s(i), F.lit("@example.com"))),
        "entity_type": F.when(is_(1), "EMAIL"),
        "reason": F.when(is_(1), F.col("event_type")),
        "context": F.when(is_(1) & (k % 2 == 0), F.col("props")),
        "request_id": F.when(is_(2), req(k % 12 + 1)),
        "request_ids": F.when(is_(3), F.array(req(k % 9 + 1), req(k % 7 + 3))),
        "action": F.when(
            is_(2, 3), F.when(k % 3 == 0, "approve").when(k % 3 == 1, "deny").otherwise("follow_up")
        ),
        "message": F.when(is_(2, 3) & (k % 2 == 1), F.concat(F.lit("note "), _s(k))),
    }
    return e.select(
        *[cols[f.name].cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(EVENTS)]
    )
