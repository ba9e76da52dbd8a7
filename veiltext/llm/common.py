"""Helpers of the corpus operators: input columns, shared tables, batches of texts, samples of labels."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts that a Python worker gets at a time. Long documents make large batches, hence a small number.
BATCH_ROWS = 1000
SPACES = b" \t\n\x0b\x0c\r"
_REPLAYED = re.compile(r"^[\s:+\-]*(Relation|Project|Filter|LocalRelation|Range|SubqueryAlias)\b")


def base_folder(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a folder of its own only on a local master without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="llm-"))
    return spark.conf.get("spark.checkpoint.dir")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python, unless they find it already (PYTHONPATH, working folder)."""
    root = Path(__file__).resolve().parents[2]
    found = [Path(p).resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p]
    if root in found or getattr(spark.sparkContext, "_veiltext_sent", False):
        return
    path = Path(tempfile.mkdtemp()) / "veiltext.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted((root / "veiltext").rglob("*.py")):
            out.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(path))
    spark.sparkContext._veiltext_sent = True


class Work:
    """Tables of one job in the shared folder. They cut lineage and survive the loss of executors."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{base_folder(spark)}/llm-{uuid.uuid4().hex}"
        self.count = 0
        ship(spark)
        small = min(BATCH_ROWS, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", small)

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        # what was shuffled to write it is garbage now; Spark deletes those files when the driver collects its own
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        """Removes tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            for path in {name.rpartition("/")[0] for name in table.inputFiles()}:
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def replayed(df: DataFrame, work: Work) -> DataFrame:
    """df itself if a second run reads the same rows in the same order (files, filters, projections), else a saved copy."""
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return df if all(_REPLAYED.match(line) for line in plan) else work.save(df)


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """row_key (unique long, in the order of the input), doc_id, text (null as empty), and more columns of df."""
    return df.select(
        F.monotonically_increasing_id().alias("row_key"),
        df[id_col].alias("doc_id"),
        F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"),
        *more,
    )


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; 0 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds, F.lit(0)).cast("int")


def batches(columns: Iterator[pa.RecordBatch], text: str = "text", most: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as bytes: about `most` bytes each, and one text at least."""
    for batch in columns:
        at = batch.schema.get_field_index(text)
        column = batch.column(at).cast(pa.large_binary())
        ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        begin = 0
        while begin < len(column):
            end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + most, side="right")) - 1)
            part = batch.slice(begin, end - begin)
            yield part, column.slice(begin, end - begin).to_pylist()
            begin = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser for 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(n: int) -> np.ndarray:
    out = np.full(n, 0x9E3779B97F4A7C15 | 1, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the lower-cased (A-Z) texts; each text's first word (one entry more than texts);
    each word's first and last byte place, counted over the texts with one byte between them."""
    whole = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    gap = (whole == 32) | ((whole >= 9) & (whole <= 13))
    edge = np.flatnonzero(gap)
    before = np.concatenate([[-1], edge[:-1]])
    begun = before + 1 < edge
    starts, ends = before[begun] + 1, edge[begun]
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first, starts, ends
    length = ends - starts
    top = 1 << int(length.max()).bit_length()
    at = np.arange(len(whole)) - np.repeat(before[begun] + 1, np.diff(np.concatenate([starts, [len(whole)]]))) if starts[0] == 0 else None
    if at is None:
        at = np.zeros(len(whole), dtype=np.int64)
        at[starts[0] :] = np.arange(starts[0], len(whole)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(whole)]])))
    values = (whole.astype(np.uint64) + np.uint64(1)) * _powers(top)[np.minimum(at, top - 1)]
    values[gap] = 0
    return mixed(np.add.reduceat(values, starts) + length.astype(np.uint64)), first, starts, ends


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the windows of n words (fewer words: none)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + size]
    return mixed(out)


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, out: int, most: int) -> DataFrame:
    """doc_id, text and y (0 or 1) of at most `most` labelled documents outside the held-out fold, the same ones each time.

    Labels that are null or of a null id are left out; of an id's several labels the largest counts. The ids are
    picked by a hash of the id before any text is read, so no text is shuffled; `most` bounds what is broadcast.
    """
    picked = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("y"))
        .where(fold(F.col("doc_id"), folds) != out)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    known = docs.select("doc_id", "text").where("doc_id is not null")
    return known.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "y")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression (last: constant), by Newton's method. Without rows of both labels, a smoothed prior."""
    x = np.column_stack([x, np.ones(len(y))])
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    if len(set(y.tolist())) < 2:
        return w
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (y - p) - penalty * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w
