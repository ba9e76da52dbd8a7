"""Intermediate tables in the folder that all executors share.

They hold what a job needs between its steps, so they belong under restricted access; the folder's
owner clears it, as for checkpoints (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; on a local master without one, a folder of this run."""
    named = spark.conf.get(_SETTING, None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="veiltext-")
    return _LOCAL[context.applicationId]


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table on shared storage.

    Several later steps can read it without computing it again, and a lost
    executor loses none of it.
    """
    path = f"{shared_folder(df.sparkSession)}/veiltext/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
