"""Spans of a named-entity model: from a table, or from a model run inside the job."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import canonical_label, ner_labels
from ..functions.schema import ENTITIES, SOURCE_NER
from ..sources.policies import Policy


#: What a model is given at once, at most; only so much is ever held as Python strings.
PART_BYTES, PART_ROWS = 1 << 20, 1000


def ner_spans(spans: DataFrame, policy: Policy) -> DataFrame:
    """A model's raw spans as entities, one row each.

    Input: ``record_id, text, span_text (may be null), label, score, start_pos,
    end_pos`` and, if the model's order matters, ``ord``.  The floor is a plain
    comparison on ``score``, which a parquet scan takes over.
    """
    ordinal = F.col("ord") if "ord" in spans.columns else F.lit(0)
    return spans.filter(F.col("score") >= F.lit(policy.ner_floor)).select(
        "record_id",
        ordinal.cast("bigint").alias("ord"),
        F.struct(
            F.coalesce("span_text", "text").alias("text"),
            canonical_label("label").alias("label"),
            F.col("start_pos").cast("int").alias("start_pos"),
            F.col("end_pos").cast("int").alias("end_pos"),
            F.col("score").cast("double").alias("confidence"),
            F.lit(SOURCE_NER).alias("source"),
        ).alias("entity"),
    )


def attach_ner(texts: DataFrame, spans: DataFrame, policy: Policy) -> DataFrame:
    """Add ``ner``: each record's spans from a span table; none where the table has none.

    The spans of one record are gathered (their number is bounded by the
    length of its text), then joined on ``record_id``.
    """
    per_record = (
        ner_spans(spans, policy)
        .groupBy("record_id")
        .agg(F.array_sort(F.collect_list(F.struct("ord", "entity"))).alias("_n"))
        .select("record_id", F.transform("_n", lambda x: x["entity"]).alias("ner"))
    )
    return texts.join(per_record, "record_id", "left").withColumn(
        "ner", F.coalesce("ner", F.array().cast(ENTITIES))
    )


def asked_labels(policy: Policy, extra: Column | None = None) -> Column:
    """What a model is asked for under a policy: the default labels, the policy's own, those of the call."""
    custom = F.array(*[F.lit(x) for x in policy.custom_entities]).cast("array<string>")
    return ner_labels(custom, extra)


def _parts(batch) -> Iterator:
    """An Arrow batch in parts of at most ``PART_BYTES`` of text and ``PART_ROWS`` rows; a longer text is a part of its own."""
    import pyarrow.compute as pc

    start, held = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
        if i > start and (held + (n or 0) > PART_BYTES or i - start == PART_ROWS):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if len(batch) > start:
        yield batch.slice(start)


def run_ner(
    texts: DataFrame,
    load_model: Callable[[], Callable[[list[str], list[str], float], list[list[dict]]]],
    labels: list[str] | Column | None,
    policy: Policy,
) -> DataFrame:
    """Add ``ner`` and ``ner_error`` by running a model over Arrow batches.

    ``labels`` is what the model is asked for: a list, a column with one for each row (see
    ``asked_labels``), or None for the default ones and the policy's own.  A row without a list is
    asked for those too, one with an empty list for nothing.  Rows of a batch that ask alike go to the
    model together, so that tenants with labels of their own need no job of their own.

    ``load_model()`` is called once per Python worker and returns
    ``model(texts, labels, floor)``, which gives one list of spans per text:
    dicts of ``text, label, score, start, end`` and maybe ``spanText``.  A model
    that cannot load leaves all texts without NER spans; where it fails on a batch, the halves are
    tried again, down to the texts it fails on.  ``ner_error`` says why; the job never fails.
    Null texts are not shown to the model.
    """
    if not isinstance(labels, list):
        own = asked_labels(policy) if labels is None else F.coalesce(labels, asked_labels(policy))
        texts = texts.withColumn("_labels", own)
    schema = T.StructType(
        list(texts.schema)
        + [
            T.StructField("_spans", T.StringType()),
            T.StructField("ner_error", T.StringType()),
        ]
    )
    floor = policy.ner_floor
    fixed = labels if isinstance(labels, list) else None

    def _plain(s: dict) -> dict:
        return {
            "text": s.get("spanText") or s["text"],
            "label": s["label"],
            "score": float(s["score"]),
            "start": int(s["start"]),
            "end": int(s["end"]),
        }

    def infer(batches: Iterator) -> Iterator:
        import json

        import pyarrow as pa

        model, problem = None, None
        try:
            model = load_model()
        except Exception as e:  # noqa: BLE001
            problem = f"model failed to load: {e}"
        for batch in (part for whole in batches for part in _parts(whole)):
            given = batch.column("text").to_pylist()
            known = [i for i, t in enumerate(given) if t is not None]
            spans, error = ["[]"] * len(given), [problem] * len(given)
            asks = batch.column("_labels").to_pylist() if fixed is None else [fixed] * len(given)
            alike: dict[tuple[str, ...], list[int]] = {}
            for i in known if model is not None else ():
                alike.setdefault(tuple(asks[i]), []).append(i)
            # Halves of what failed, down to the single text that does.
            todo = [(list(asked), rows) for asked, rows in alike.items() if asked]
            while todo:
                asked, rows = todo.pop()
                try:
                    found = model([given[i] for i in rows], asked, floor)
                    for i, row in zip(rows, found, strict=True):
                        spans[i] = json.dumps([_plain(s) for s in row])
                except Exception as e:  # noqa: BLE001
                    if len(rows) == 1:
                        error[rows[0]] = f"model failed: {e}"
                    else:
                        todo += [(asked, rows[: len(rows) // 2]), (asked, rows[len(rows) // 2 :])]
            added = [pa.array(spans, pa.string()), pa.array(error, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "_spans", "ner_error"])

    raw = F.from_json(
        "_spans", "array<struct<text:string,label:string,score:double,start:int,end:int>>"
    )
    entities = F.transform(
        raw,
        lambda s: F.struct(
            s["text"].alias("text"),
            canonical_label(s["label"]).alias("label"),
            s["start"].alias("start_pos"),
            s["end"].alias("end_pos"),
            s["score"].alias("confidence"),
            F.lit(SOURCE_NER).alias("source"),
        ),
    )
    return texts.mapInArrow(infer, schema).withColumn("ner", entities).drop("_spans", "_labels")
