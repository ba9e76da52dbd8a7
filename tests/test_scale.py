"""Work that must grow no faster than the input: tasks for few bytes, pieces for many patterns, parts for large batches."""

from pyspark.sql import functions as F

from catalog import corpus as X
from catalog import state_queries as S
from veiltext.functions import json_strings as J
from veiltext.operators import allowing as W
from veiltext.operators import audit as G
from veiltext.operators import ner as N
from veiltext.plans import channels as C
from veiltext.sources.policies import policy_from


def test_rows_of_one_row_group_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "LONG_ROWS", 100)
    spark.range(1000).select((F.col("id") % 990).alias("c_custkey")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    policies = S.tenant_policies(spark, str(tmp_path))
    assert policies.rdd.getNumPartitions() >= 10
    assert sorted(r.policy_id for r in policies.collect()) == sorted(i % 990 for i in range(1000))


def test_few_rows_stay_where_they_are(spark, tmp_path):
    spark.range(50).select(F.when(F.col("id") > 5, F.col("id")).alias("c_custkey")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    assert "Exchange" not in S.tenant_policies(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()


def test_patterns_with_numbers_meet_only_texts_with_them(spark):
    """Of 20,000 patterns a text meets few; with pieces of three characters it met some hundred."""
    patterns = spark.range(100000, 120000).select(F.concat(F.lit("key_"), F.col("id").cast("string"), F.lit("[a-f]+")).alias("pattern"))
    texts = spark.range(100000, 120000, 40).select(F.concat(F.lit("KEY_"), F.col("id").cast("string"), F.lit("abc")).alias("text"))
    filed = patterns.select("pattern", W._literal("pattern").alias("literal"))
    assert {r[0] for r in filed.select(W._rung(F.col("literal"))).distinct().collect()} == {6}
    index = W._filed(filed.withColumn("size", W._rung(F.col("literal"))))
    met = W._held(texts, [6]).join(index, "piece")
    assert met.count() <= 12 * texts.count()
    assert W.pattern_hits(texts, patterns).count() == 500


def test_pieces_of_all_lengths(spark):
    words = ["abc", "abcdef", "abcdefghijkl", "x" * 30, "k" * 200 + "9", "ab", "q.+z"]
    patterns = spark.createDataFrame([(w,) for w in words], "pattern string")
    texts = spark.createDataFrame([(w.upper(),) for w in words] + [("abcd",), ("x" * 29,), ("k" * 200,), (None,), ("",), ("q--z",)], "text string")
    assert sorted(r.text for r in W.pattern_hits(texts, patterns).collect()) == sorted([w.upper() for w in words] + ["q--z"])


def test_a_model_is_given_parts_of_a_batch(spark, monkeypatch):
    rows = [(i, None if i == 7 else "x" * 300_000 if i % 10 == 0 else f"Joe {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "id int, text string").coalesce(1)

    def load():
        def model(texts, labels, floor):
            assert len(texts) <= 1000 and (len(texts) == 1 or sum(map(len, texts)) <= 1 << 20)
            return [[{"text": "Joe", "label": "person", "score": 0.9, "start": 0, "end": 3}] if t[0] == "J" else [] for t in texts]

        return model

    out = {r.id: r for r in N.run_ner(df, load, ["person"], policy_from({})).select("id", "ner", "ner_error", F.length("text").alias("n")).collect()}
    assert len(out) == 50 and all(r.ner_error is None for r in out.values())
    assert [i for i, r in sorted(out.items()) if r.ner] == [i for i in range(50) if i % 10 and i != 7]
    assert out[7].n is None and out[10].n == 300_000


def test_a_message_is_taken_apart_once(spark):
    rows = [('{"content":[{"type":"text","text":"joe@x.org"}],"a":1,"a":2}',), ('{"content":"x@y.org","content" : "call joe@x.org"}',), ("joe@x.org",), ("clean",), (None,)]
    out = C.tool_result_redact(spark.createDataFrame(rows, "m string"), policy_from({}), message="m")
    assert out._jdf.queryExecution().optimizedPlan().toString().count(J._SOUND) == 1
    want = ['{"content":[{"type":"text","text":"[EMAIL_1]"}],"a":1,"a":2}', '{"content":"","content" : "call [EMAIL_1]"}', "[EMAIL_1]"]
    assert "_strings" not in out.columns and sorted(r.m for r in out.collect()) == sorted(want)


FACTS = "channel string, label string, action string, record_id string, digest binary"


def _shuffled(df) -> int:
    """Rows that the exchanges of a run of df wrote."""

    def rows(node) -> int:
        own = node.metrics().get("shuffleRecordsWritten")
        inner = [node.children().apply(i) for i in range(node.children().size())]
        return (own.get().value() if own.isDefined() else 0) + sum(map(rows, inner))

    df.collect()
    return rows(df._jdf.queryExecution().executedPlan())


def test_the_cube_expands_sets_and_not_records(spark):
    """A record and a value are shuffled once per combination, and once more as a set; with the cube over them, 16 times."""
    kind = F.col("id") % 3
    facts = spark.range(3000).select(
        F.element_at(F.array(F.lit("in"), F.lit("out"), F.lit("tool")), (kind + 1).cast("int")).alias("channel"),
        F.lit("EMAIL").alias("label"), F.lit("redact").alias("action"), F.col("id").cast("string").alias("record_id"),
        F.col("id").cast("string").cast("binary").alias("digest"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _shuffled(G.audit_rollup(facts)) <= 5 * 3000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_rollup_of_nulls_and_repeats(spark):
    """Against counts in Python: null columns, null records and values, repeated rows, ids that are both a record and a value."""
    rows = []
    for i in range(300):
        pick = lambda *xs, k: xs[(i * k + i // 7) % len(xs)]
        record, value = pick(None, *(f"r{j}" for j in range(20)), k=5), pick(None, *(b"r%d" % j for j in range(12)), k=11)
        rows.append((pick("in", "out", None, k=1), pick("A", None, "B", '"', k=3), pick("block", "warn", None, k=7), record, value))
    want = {}
    for level in range(8):
        for row in rows:
            cell = tuple(None if level & bit else x for x, bit in zip(row, (4, 2, 1)))
            n, records, values = want.setdefault((*cell, level), ([], set(), set()))
            n.append(1)
            records.add(row[3])
            values.add(row[4])
    want = {k: (len(n), len(r - {None}), len(v - {None})) for k, (n, r, v) in want.items()}
    got = G.audit_rollup(spark.createDataFrame(rows, FACTS))
    found = {(r.channel, r.label, r.action, r.level): (r.entities, r.records, r.distinct_values) for r in got.collect()}
    assert got.count() == len(found) and found == want
    assert not G.audit_rollup(spark.createDataFrame([], FACTS)).collect()
