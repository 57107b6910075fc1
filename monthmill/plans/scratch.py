"""Where queries put tables of their own for a while."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``; where that is unset, under a folder of our own in local mode, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[\d*, ]+\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _own.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="spark-scratch-")
        _own[spark.sparkContext.applicationId] = root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet to a scratch path and read back, so that what reads it twice does not compute it twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
