"""Token ids as binary rows of equal width, packed by best-fit decreasing."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiltext.llm.common import Work, batches
from veiltext.llm.packing import best_fit_decreasing
from veiltext.llm.tokens import default_path, encoder

SEQUENCES = (
    "sequence_id long, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
    "doc_ids array<long>, pieces array<int>, starts array<long>"
)


def _sequences(columns, path: str, width: int, end_id: int, window_tokens: int, pad_id: int):
    encode = encoder(path)
    first, made = TaskContext.get().partitionId() << 40, 0
    held: list[tuple[int | None, int, int, np.ndarray]] = []
    size = 0

    def packed(last: bool):
        """Rows of the bins; those with over a hundredth of room stay for the next window, unless this is the last."""
        nonlocal held, size, made
        bins, offsets = best_fit_decreasing(np.array([len(x[3]) for x in held], dtype=np.int64), width)
        order = np.lexsort((offsets, bins))
        groups = np.split(order, np.flatnonzero(np.diff(bins[order])) + 1) if len(order) else []
        rows, rest = [], []
        for group in groups:
            members = [held[i] for i in group.tolist()]
            lengths = [len(x[3]) for x in members]
            if not last and sum(lengths) < width - width // 100:
                rest.extend(members)
                continue
            ids, places = np.full(width, pad_id, encode.dtype), np.zeros(width, encode.dtype)
            ids[: sum(lengths)] = np.concatenate([x[3] for x in members])
            places[: sum(lengths)] = np.concatenate([np.arange(n) for n in lengths])
            ends = np.cumsum([0, *lengths])
            rows.append((first + made, int(ends[-1]), ids.tobytes(), places.tobytes(), ends.tolist(), *([x[k] for x in members] for k in range(3))))
            made += 1
        if len(rest) == len(held) and not last:
            rows, rest = packed(True), []
            held, size = [], 0
            return rows
        held, size = rest, sum(len(x[3]) for x in rest)
        return rows

    def as_batches(rows):
        names = ["sequence_id", "n_tokens", "input_ids", "position_ids", "cu_seqlens", "doc_ids", "pieces", "starts"]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
        for at in range(0, len(rows), 500):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at : at + 500], strict=True), kinds, strict=True)], names=names)

    for batch, texts in batches(columns):
        for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts), strict=True):
            ids = np.append(ids, encode.dtype.type(end_id))
            for piece, start in enumerate(range(0, len(ids), width)):
                held.append((doc, piece, start, ids[start : start + width]))
            size += len(ids)
            if size >= window_tokens:
                yield from as_batches(packed(False))
    if held:
        yield from as_batches(packed(True))


def token_matrix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    width: int = 4096,
    end_id: int = 1,
    pad_id: int = 0,
    window_tokens: int = 1 << 23,
) -> DataFrame:
    """Rows of a packed id matrix: sequence_id, n_tokens, input_ids and position_ids (`width` unsigned little-endian
    numbers each, two bytes wide if the vocabulary allows it), cu_seqlens (0, then the end of each segment), and
    for each segment its doc_ids, pieces and starts (the ids of the document before it).

    Each document is its ids and one end id. Longer ones are cut every `width` ids, so that its pieces joined are the
    document again. position_ids begin at 0 in each segment; beyond n_tokens ids are pad_id and places 0.

    A task packs its own input in windows of `window_tokens` ids, by best-fit decreasing with a segment tree over
    free space; bins with room are packed again with the next window. Nothing is shuffled, memory is that of a window
    (and of one document), and sequence ids derive from the partition, so that a repeated task writes the same rows.

    Null text: empty, one end id. Null and repeated ids are kept as they are. No rows: none.
    """
    Work(docs.sparkSession)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    run = partial(_sequences, path=tokenizer_path or default_path(), width=width, end_id=end_id, window_tokens=window_tokens, pad_id=pad_id)
    return texts.mapInArrow(run, SEQUENCES)


def write_token_matrix(docs: DataFrame, path: str, **options) -> None:
    """Writes token_matrix(docs, ...) as Parquet: fixed-width binary rows with their segment tables."""
    token_matrix(docs, **options).write.mode("errorifexists").parquet(path)
