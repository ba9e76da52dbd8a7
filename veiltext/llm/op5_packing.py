"""Packing of documents into as few sequences as possible, certified by lower bounds."""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiltext.llm.common import Work, batches, keyed
from veiltext.llm.packing import best_fit_decreasing, lower_bound
from veiltext.llm.tokens import default_path, encoder

PIECES = "row_key long, doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "row_key long, piece int, length long, part long, bin long, offset long, fill long, bins long, bound long"


def with_end(ids: np.ndarray, end_id: int) -> np.ndarray:
    return np.append(ids, ids.dtype.type(end_id))


def _pieces(columns, path: str, capacity: int, end_id: int):
    encode = encoder(path)
    for batch, texts in batches(columns):
        keys, docs = batch.column("row_key").to_pylist(), batch.column("doc_id").to_pylist()
        rows = []
        for key, doc, ids in zip(keys, docs, encode(texts), strict=True):
            ids = with_end(ids, end_id).astype("<u4")
            for piece, start in enumerate(range(0, len(ids), capacity)):
                part = ids[start : start + capacity]
                rows.append((key, doc, piece, start, len(part), zlib.crc32(part.tobytes())))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=["row_key", "doc_id", "piece", "start", "length", "ids_crc32"],
        )


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """One row for each piece of a keyed document; the texts are read where they lie."""
    docs = docs.select("row_key", F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(partial(_pieces, path=path, capacity=capacity, end_id=end_id), PIECES)


def _packer(capacity: int):
    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["row_key", "piece"], ignore_index=True)
        lengths = rows["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        return rows.assign(bin=bins, offset=offsets, fill=fill[bins], bins=len(fill), bound=lower_bound(lengths, capacity))

    return packed


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    capacity: int = 4096,
    end_id: int = 1,
    partition_pieces: int = 100_000,
) -> DataFrame:
    """Pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Partitions of about `partition_pieces` lengths are packed by best-fit decreasing. Each partition's bins are compared
    with a lower bound by dual-feasible functions. A partition above its bound hands on the documents of all its bins
    that are not full, a certified one those of its bins with most room (a tenth or more), and what is handed
    on is dealt to an eighth of the partitions and packed again. Rounds end when the bins left open are those of a
    single partition or a round saves nothing. Only lengths move; texts are read once and ids are not kept.

    Null text: empty, one end id. Null or repeated ids: packed like any other row (ids are not used as keys). No rows: none.
    """
    spark = docs.sparkSession
    work = Work(spark)
    table = work.save(pieces(keyed(docs, id_col, text_col), tokenizer_path or default_path(), capacity, end_id))
    left, placed, before = table.select("row_key", "piece", "length"), [], None
    parts = max(1, -(-table.count() // partition_pieces))
    level = 0
    while True:
        dealt = left.withColumn("part", F.pmod(F.xxhash64("row_key", "piece", F.lit(level)), F.lit(parts)))
        done = work.save(dealt.groupBy("part").applyInPandas(_packer(capacity), PLACED)).withColumn("level", F.lit(level))
        placed.append(done)
        opened = (F.col("fill") < capacity) & ((F.col("bins") > F.col("bound")) | (F.col("fill") <= capacity - capacity // 10))
        stats = done.select("part", "bin", "fill", "bins", "bound").distinct().agg(F.count("*").alias("bins"), F.count_if(opened).alias("open")).head()
        if parts == 1 or not stats.open or (before is not None and stats.bins >= before):
            break
        placed[-1], left, before = done.where(~opened), done.where(opened).select("row_key", "piece", "length"), stats.open
        parts, level = -(-parts // 8), level + 1
    everything = placed[0]
    for done in placed[1:]:
        everything = everything.unionByName(done)
    sequence = ((F.col("level") * (1 << 20) + F.col("part")) * (1 << 32) + F.col("bin")).alias("sequence_id")
    return table.join(everything.select("row_key", "piece", sequence, "offset"), ["row_key", "piece"]).drop("row_key")
