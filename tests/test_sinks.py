"""Batches in the sinks: whole or not at all, and a batch written again replaces itself."""

import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from veiltext.plans import channels as C
from veiltext.sources import sinks as S
from veiltext.sources.policies import policy_from
from veiltext.sources.sinks import clear_uncommitted, committed, read_sink, write_outputs
from veiltext.sources.texts import texts_from

PLAIN = policy_from({})


def job(spark, *bodies):
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    return C.outbound_redact(texts_from(df, text="body", record_id=F.col("id").cast("string"), channel="outbound"), PLAIN, changed_only=False)


def originals(spark, path):
    return sorted(r.original for r in read_sink(spark, path, "mapping").collect())


def on_disk(path):
    return [f for f in glob.glob(f"{path}/**/*.parquet", recursive=True) if "sink=mapping" in f]


def test_a_rerun_with_fewer_rows_leaves_none_behind(spark, tmp_path):
    out = str(tmp_path / "s")
    write_outputs(job(spark, "mail joe@x.org", "mail ann@x.org"), out, "outbound_scan", 3)
    write_outputs(job(spark, "mail bob@x.org"), out, "outbound_scan", 4)
    write_outputs(job(spark, "mail eve@x.org"), out, "tool_result_scan", 3)
    assert originals(spark, out) == ["ann@x.org", "bob@x.org", "eve@x.org", "joe@x.org"]
    write_outputs(job(spark, "clean", "mail ann@x.org"), out, "outbound_scan", 3)
    assert originals(spark, out) == ["ann@x.org", "bob@x.org", "eve@x.org"]
    write_outputs(job(spark, "clean"), out, "outbound_scan", 3)
    assert originals(spark, out) == ["bob@x.org", "eve@x.org"] and len(on_disk(out)) == 2
    assert sorted(r.redacted_text for r in read_sink(spark, out, "redacted").collect()) == ["clean", "mail [EMAIL_1]", "mail [EMAIL_1]"]
    assert committed(spark, out).count() == 3
    write_outputs(job(spark, "x").limit(0), out, "outbound_scan", 3)
    assert read_sink(spark, out, "redacted").count() == 2


def test_sinks_that_were_never_written(spark, tmp_path):
    out = str(tmp_path / "s")
    assert read_sink(spark, out, "audit").collect() == [] and committed(spark, out).collect() == []
    write_outputs(job(spark, "clean"), out, "outbound_scan", 0)
    assert read_sink(spark, out, "mapping").collect() == [] and read_sink(spark, out, "redacted").count() == 1
    assert clear_uncommitted(spark, out) == 0
    with pytest.raises(ValueError):
        write_outputs(job(spark, "clean"), out, "outbound/scan", 0)


@pytest.mark.parametrize("step", ["write", "move", "commit"])
def test_a_writer_that_fails_midway_changes_nothing(spark, tmp_path, monkeypatch, step):
    out = str(tmp_path / "s")
    write_outputs(job(spark, "mail joe@x.org"), out, "outbound_scan", 1)
    after = job(spark, "mail ann@x.org", "mail eve@x.org")
    if step == "write":
        after = after.withColumn("redacted_text", F.when(F.col("record_id") == "1", F.raise_error(F.lit("lost"))).otherwise(F.col("redacted_text")))
    elif step == "move":
        monkeypatch.setattr(S, "_attempt_folder", lambda *a, real=S._attempt_folder: (_ for _ in ()).throw(OSError("lost")) if a[1] == "audit" else real(*a))
    else:
        monkeypatch.setattr(S, "_records", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(Exception, match="lost"):
        write_outputs(after, out, "outbound_scan", 1)
    monkeypatch.undo()
    assert originals(spark, out) == ["joe@x.org"] and read_sink(spark, out, "redacted").count() == 1
    assert clear_uncommitted(spark, out) == 1 and len(on_disk(out)) == 1 and os.listdir(f"{out}/_staging") == []
    write_outputs(job(spark, "mail ann@x.org"), out, "outbound_scan", 1)
    assert originals(spark, out) == ["ann@x.org"]


def test_two_writers_of_one_batch_at_once(spark, tmp_path):
    out = str(tmp_path / "s")
    threads = [threading.Thread(target=write_outputs, args=(job(spark, *[f"mail {w}{i}@x.org" for i in range(5)]), out, "outbound_scan", 1)) for w in "ab"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = originals(spark, out)
    assert got in ([f"a{i}@x.org" for i in range(5)], [f"b{i}@x.org" for i in range(5)])
    assert {r.redacted_text for r in read_sink(spark, out, "redacted").collect()} == {"mail [EMAIL_1]"}
    assert read_sink(spark, out, "entities").count() == 5
