"""What several operators share: scratch tables in the shared checkpoint folder and Arrow batch helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows that a Python helper turns into objects at once; keeps a worker's memory to a few MB of text beside its batch.
SLICE_ROWS = 256

#: Spark's setting by which a query's shuffle files go when it has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_dirs: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one of our own in local mode, as in tests, but an error
    on a cluster, where a folder of one machine is not seen by the others."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not re.fullmatch(r"local(\[[\d*, ]+\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="spark-checkpoint-")
    return _own_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df once as Parquet in the shared folder and read it back: cuts lineage, and survives lost executors. The write's
    shuffle files go with it, as nothing else reads them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing lazy reads any more."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that only a few rows become Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that df does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
