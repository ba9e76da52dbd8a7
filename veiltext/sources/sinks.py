"""Outputs of a redaction job: four tables from one pass over the texts.

Each record becomes rows for up to four sinks, and one write splits them into
directories by sink: ``redacted`` and ``audit`` are open, ``entities`` and
``mapping`` hold raw values and belong under restricted access.  The texts are
read and searched once, and nothing is shuffled.

A batch is written aside, moved into place as an attempt of its own, and then
committed by one small file, whose name says which attempt of which batch
counts.  Readers go by these records alone: they see a batch whole or not at
all, and the last committed attempt of it only.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.audit import AUDIT, audit_columns

_RECORD = "record_id string, channel string, session_id string, seq bigint, ts timestamp"
SINKS = {
    "redacted": (
        f"{_RECORD}, tool_name string, channel_id string, redacted_text string, message string, "
        "payload string, notice string, outcome string, reason string"
    ),
    "entities": (
        f"{_RECORD}, idx int, text string, label string, start_pos int, end_pos int, "
        "confidence double, source string"
    ),
    "mapping": f"{_RECORD}, idx int, placeholder string, original string",
    "audit": AUDIT,
}
RESTRICTED = ("entities", "mapping")


def _fields() -> dict[str, T.DataType]:
    return {
        f.name: f.dataType for ddl in SINKS.values() for f in T.StructType.fromDDL(ddl).fields
    }


def _row(df: DataFrame, sink: str, own: dict[str, Column]) -> Column:
    wanted = T.StructType.fromDDL(SINKS[sink]).fieldNames()
    cols = [F.lit(sink).alias("sink")]
    for name, kind in _fields().items():
        if name in own:
            value = own[name]
        elif name in wanted and name in df.columns:
            value = F.col(name)
        else:
            value = F.lit(None)
        cols.append(value.cast(kind).alias(name))
    return F.struct(*cols)


def sink_rows(
    processed: DataFrame,
    event: str,
    audit: bool = True,
    message: str = "message",
    payload: str = "payload",
) -> DataFrame:
    """The rows of all sinks for the output of a channel job, with the column ``sink``.

    ``redacted`` holds what the job delivers: the redacted text, the rewritten ``message`` or
    ``payload`` (as JSON), the notice, the gate's outcome.  Jobs without spans or map have no rows there.
    """
    df = processed

    def entity(e: Column, i: Column) -> Column:
        names = ("text", "label", "start_pos", "end_pos", "confidence", "source")
        return _row(df, "entities", {"idx": i, **{n: e[n] for n in names}})

    def mapped(m: Column, i: Column) -> Column:
        return _row(
            df, "mapping", {"idx": i, "placeholder": m["placeholder"], "original": m["original"]}
        )

    delivered = {}
    if message in df.columns:
        delivered["message"] = F.col(message)
    if payload in df.columns:
        delivered["payload"] = F.to_json(payload)
    parts = [F.array(_row(df, "redacted", delivered))]
    if "entities" in df.columns:
        parts.append(F.transform("entities", entity))
    if "mapping" in df.columns:
        parts.append(F.transform("mapping", mapped))
    if audit:
        due, columns = audit_columns(df, event)
        hit = F.array(_row(df, "audit", columns))
        parts.append(F.when(due, hit).otherwise(F.slice(hit, 1, 0)))
    return df.select(F.inline(F.concat(*parts)))


def _folder(spark: SparkSession, path: str):
    """A path and its file system, as Spark's own writers see them."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing in one that is not there."""
    files, where = _folder(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(where)) if files.exists(where) else []


def _remove(spark: SparkSession, path: str) -> None:
    files, where = _folder(spark, path)
    files.delete(where, True)


def _attempt_folder(path: str, sink: str, event: str, batch_id: int, attempt: str) -> str:
    return f"{path}/sink={sink}/written_by={event}/batch_id={batch_id}/attempt={attempt}"


#: event.batch.version.attempt, the name of a commit record
_RECORD_NAME = r"([A-Za-z0-9_-]+)\.(-?[0-9]+)\.([0-9]+)\.(a-[0-9a-f]+)"


def _records(spark: SparkSession, path: str, event: str, batch_id: int) -> list[tuple[int, str]]:
    """Version and attempt of the commits of one batch, in order."""
    files, where = _folder(spark, f"{path}/_commits/{event}.{batch_id}.*")
    found = [re.fullmatch(_RECORD_NAME, x.getPath().getName()) for x in files.globStatus(where) or ()]
    return sorted((int(m[3]), m[4]) for m in found if m)


def write_outputs(
    processed: DataFrame, path: str, event: str, batch_id: int, audit: bool = True, **columns: str
) -> None:
    """Write one batch of one job; the same batch of the same event written again replaces itself, in all sinks.

    Jobs of different events can share a path, and two writers of one batch do not disturb each other: the last to
    commit counts.  One that fails leaves nothing that a reader sees (``clear_uncommitted`` removes what it left).  The
    rows of replaced attempts are deleted, so no restricted value outlives the batch that held it.
    """
    if not re.fullmatch(r"[A-Za-z0-9_-]+", event):
        raise ValueError("event: letters, digits, _ and -")
    spark = processed.sparkSession
    attempt = f"a-{uuid.uuid4().hex}"
    staged = f"{path}/_staging/{attempt}"
    sink_rows(processed, event, audit, **columns).write.partitionBy("sink").parquet(staged)
    for sink in SINKS:
        files, source = _folder(spark, f"{staged}/sink={sink}")
        if files.exists(source):
            _, target = _folder(spark, _attempt_folder(path, sink, event, batch_id, attempt))
            if not (files.mkdirs(target.getParent()) and files.rename(source, target)):
                raise OSError(f"cannot move {source} to {target}")
    _remove(spark, staged)
    before = _records(spark, path, event, batch_id)
    version = before[-1][0] + 1 if before else 1
    files, record = _folder(spark, f"{path}/_commits/{event}.{batch_id}.{version}.{attempt}")
    out = files.create(record, False)
    out.writeBytes(attempt)  # Spark passes over files without content
    out.close()
    for old, replaced in _records(spark, path, event, batch_id):
        if (old, replaced) < (version, attempt):
            for sink in SINKS:
                _remove(spark, _attempt_folder(path, sink, event, batch_id, replaced))
            _remove(spark, f"{path}/_commits/{event}.{batch_id}.{old}.{replaced}")


def committed(spark: SparkSession, path: str) -> DataFrame:
    """``written_by, batch_id, attempt``: the attempt of each batch that counts."""
    if not _names(spark, f"{path}/_commits"):
        return spark.createDataFrame([], "written_by string, batch_id bigint, attempt string")
    name = F.regexp_extract("path", "[^/]+$", 0)
    part = lambda k: F.regexp_extract(name, _RECORD_NAME, k)
    records = spark.read.format("binaryFile").load(f"{path}/_commits").select(
        part(1).alias("written_by"), part(2).cast("bigint").alias("batch_id"), part(3).cast("bigint").alias("version"), part(4).alias("attempt")
    )
    last = F.max(F.struct("version", "attempt"))["attempt"]
    return records.groupBy("written_by", "batch_id").agg(last.alias("attempt"))


def read_sink(spark: SparkSession, path: str, sink: str) -> DataFrame:
    """One sink of ``write_outputs``: its own directory and its own columns, of committed attempts only."""
    own = T.StructType.fromDDL(SINKS[sink])
    if not _names(spark, f"{path}/sink={sink}"):
        return spark.createDataFrame([], own)
    keys = T.StructType.fromDDL("written_by string, batch_id bigint, attempt string")
    rows = spark.read.schema(T.StructType([*own, *keys])).parquet(f"{path}/sink={sink}")
    return rows.join(committed(spark, path), keys.names, "left_semi").select(*own.names)


def clear_uncommitted(spark: SparkSession, path: str) -> int:
    """Deletes what failed writers have left, and says how many attempts that were; no writer may be at work meanwhile."""
    known = {(r.written_by, str(r.batch_id), r.attempt) for r in committed(spark, path).toLocalIterator()}
    left = {(f"{path}/_staging/{name}", name) for name in _names(spark, f"{path}/_staging")}
    for sink in SINKS:
        for event in _names(spark, f"{path}/sink={sink}"):
            for batch in _names(spark, f"{path}/sink={sink}/{event}"):
                for attempt in _names(spark, f"{path}/sink={sink}/{event}/{batch}"):
                    key = tuple(x.partition("=")[2] for x in (event, batch, attempt))
                    if key not in known:
                        left.add((f"{path}/sink={sink}/{event}/{batch}/{attempt}", key[2]))
    for folder, _ in left:
        _remove(spark, folder)
    return len({attempt for _, attempt in left})
