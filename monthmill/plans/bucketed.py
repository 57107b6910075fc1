"""Tables whose partitioning and order Spark knows: joins and groupings by their keys move no rows and sort none.

A table is bucketed and sorted by its keys, each bucket one file, written by the task that a shuffle by the keys gives it to. So
two tables of equal keys and buckets join bucket by bucket, and a grouping by the keys reads its groups in order. Spark trusts a
bucket's order only where ``spark.sql.legacy.bucketedTableScan.outputOrdering`` is on, which has it list files while it plans;
:func:`trust_order` turns that on for the session, once. Without it a bucket is sorted again, still without a shuffle.

A key that holds many rows makes one large bucket: these tables are for keys that are nearly unique, such as ids of games.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from .scratch import scratch_path

ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def trust_order(spark: SparkSession) -> None:
    spark.conf.set(ORDERED, "true")


def write_bucketed(rows: DataFrame, table: str, path: str, keys: list[str], buckets: int, sort: Iterable[str] = ()) -> DataFrame:
    """Write rows as a table of the catalogue whose files lie under path, bucketed by keys, and sorted by keys and then by
    ``sort``; the table. Appended rows would make further files of a bucket, which Spark no longer takes for sorted: write a
    table a run, as months are written."""
    order = [*keys, *sort]
    laid = rows.repartition(buckets, *keys).sortWithinPartitions(*order)
    laid.write.option("path", path).option("compression", "zstd").bucketBy(buckets, *keys).sortBy(*order).saveAsTable(table)
    return rows.sparkSession.table(table)


def bucketed(rows: DataFrame, name: str, keys: list[str], buckets: int | None = None, sort: Iterable[str] = ()) -> DataFrame:
    """The same for scratch tables: nothing stays in the catalogue, the files lie where scratch tables do. ``buckets`` is by
    default the session's number of shuffle partitions."""
    spark = rows.sparkSession
    table = f"mm_{name}_{uuid.uuid4().hex}"
    out = write_bucketed(rows, table, scratch_path(spark, name), keys, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), sort)
    out.schema  # resolved while the catalogue has it
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    return out
