"""Upkeep of published tables: compaction, expiry, orphans, inventory, and the drill that reads tables from files alone."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.landing import files_under, write_text
from .publish import Store, latest_runs


#: Size that compacted files have, about.
FILE_BYTES = 256 << 20


@dataclass(frozen=True)
class Settings:
    """How a table is kept; properties ``upkeep.*`` override the defaults."""

    strategy: str = "binpack"
    min_files: int = 5
    keep_days: int = 7
    keep_last: int = 3
    orphan_days: int = 3


def settings(properties: dict[str, str], defaults: Settings = Settings()) -> Settings:
    kinds = {"strategy": str, "min_files": int, "keep_days": int, "keep_last": int, "orphan_days": int}
    out = Settings(**{k: kind(properties.get(f"upkeep.{k}", getattr(defaults, k))) for k, kind in kinds.items()})
    if out.strategy not in ("binpack", "sort"):
        raise ValueError(f"unknown strategy: {out.strategy}")
    return out


def cutoff(now: dt.datetime, days: int) -> dt.datetime:
    return now - dt.timedelta(days=days)


def file_stats(files: DataFrame) -> DataFrame:
    """Files, their mean MB and all GB, by month."""
    month = F.regexp_extract("path", r"month=(\d{4}-\d{2})", 1)
    return files.groupBy(month.alias("month")).agg(F.count("*").alias("files"), F.round(F.avg("length") / 1e6, 2).alias("mean_mb"), F.round(F.sum("length") / 1e9, 3).alias("total_gb"))


def compact_month(store: Store, table: str, month: str, options: Settings = Settings(), sort: list[str] | None = None) -> bool:
    """Rewrite a published month into few files when it has many; whether it was rewritten.

    Rows, and the run ids in them, stay as they are, so no layer below becomes stale; a bucketed month stays bucketed, its
    buckets written side by side. The new files are another folder of the same run, to which the pointer is moved: whoever
    reads the old one goes on reading it until it expires.
    """
    ref = store.versions(table).where(F.col("month") == month).first()
    if ref is None:
        raise LookupError(f"{table} has no month {month}")
    path = store.run_path(table, month, ref.run_id, ref.folder)
    held = files_under(store.spark, path).agg(F.count("*").alias("files"), F.sum("length").alias("bytes")).first()
    rows = store.spark.read.parquet(path)
    bucketed = "bucket" in rows.columns
    least = rows.select("bucket").distinct().count() if bucketed else 1
    if held.files < max(options.min_files, least + 1):
        return False
    packed = rows.repartition("bucket") if bucketed else rows.repartition(max(1, held.bytes // FILE_BYTES))
    if options.strategy == "sort" and sort:
        packed = packed.sortWithinPartitions(*(["bucket"] if bucketed else []), *sort)
    folder = f"run={ref.run_id}.{uuid.uuid4().hex[:8]}"
    new_path = store.run_path(table, month, ref.run_id, folder)
    writer = packed.write.option("compression", "zstd")
    (writer.partitionBy("bucket") if bucketed else writer).parquet(new_path)
    if store.spark.read.parquet(new_path).count() != rows.count():
        store._delete(new_path)
        raise RuntimeError(f"{table} {month}: compaction changed the number of rows")
    store.point(table, month, ref.run_id, ref.source_run_id, folder)
    return True


def expired(refs: DataFrame, now: dt.datetime, keep_days: int, keep_last: int) -> DataFrame:
    """Published runs that are superseded, older than ``keep_days``, and beyond the last ``keep_last`` of their month."""
    place = F.row_number().over(Window.partitionBy("table_name", "month").orderBy(F.desc("published_at"), F.desc("run_id")))
    return refs.withColumn("place", place).where((F.col("place") > max(1, keep_last)) & (F.col("published_at") < F.lit(cutoff(now, keep_days)))).drop("place")


def expire_runs(store: Store, now: dt.datetime, options: Settings = Settings()) -> int:
    gone = expired(store.refs(), now, options.keep_days, options.keep_last).collect()  # a row a superseded run
    for r in gone:
        store._delete(store.run_path(r.table_name, r.month, r.run_id, r.folder))
    return len(gone)


def orphan_files(files: DataFrame, refs: DataFrame, now: dt.datetime, days: int) -> DataFrame:
    """Files (path, modified) under a table that belong to no published run and are older than ``days``."""
    at = r"/([^/]+)/month=(\d{4}-\d{2})/(run=[^/]+)/"
    keyed = files.withColumns({"table_name": F.regexp_extract("path", at, 1), "month": F.regexp_extract("path", at, 2), "folder": F.regexp_extract("path", at, 3)})
    old = keyed.where(F.col("modified") < F.lit(cutoff(now, days)))
    held = refs.select("table_name", "month", F.coalesce("folder", F.concat(F.lit("run="), "run_id")).alias("folder")).distinct()
    return old.join(held, ["table_name", "month", "folder"], "left_anti").select("path", "length", "modified")


def remove_orphans(store: Store, table: str, now: dt.datetime, options: Settings = Settings(), dry_run: bool = True) -> list[str]:
    found = orphan_files(files_under(store.spark, f"{store.root}/{table}"), store.refs(), now, options.orphan_days)
    paths = [r.path for r in found.select("path").toLocalIterator()]
    if not dry_run:
        for p in paths:
            store._delete(p)
    return paths


def maintain(store: Store, tables: list[str], now: dt.datetime, options: Settings = Settings(), dry_run: bool = True) -> dict[str, dict]:
    """Compact and clean each table; a report of files before and after. A table's failure does not stop the others."""
    report: dict[str, dict] = {}
    for table in tables:
        try:
            count = lambda: files_under(store.spark, f"{store.root}/{table}").count()  # noqa: E731, B023
            before = count()
            packed = [r.month for r in store.versions(table).collect() if compact_month(store, table, r.month, options)]
            report[table] = {"before": before, "compacted": packed, "orphans": remove_orphans(store, table, now, options, dry_run), "after": count()}
        except Exception as e:  # noqa: BLE001 - reported
            report[table] = {"error": str(e)[:200]}
    return report


def version_number(name: str) -> int | None:
    """The number that a versioned metadata name starts with: '00012-abc.json' is 12."""
    import re

    m = re.match(r"v?(\d+)[-.]", name)
    return int(m[1]) if m else None


def newest_version(names: DataFrame) -> DataFrame:
    """By table, the name with the largest number (not the last in listing order)."""
    number = F.nullif(F.regexp_extract("name", r"^v?(\d+)[-.]", 1), F.lit("")).cast("bigint")
    return names.withColumn("n", number).where(F.col("n").isNotNull()).groupBy("table_name").agg(F.max_by("name", "n").alias("name"))


def inventory(store: Store) -> DataFrame:
    """Where each table's published months lie: table_name, month, run_id, location."""
    refs = latest_runs(store.refs())
    folder = F.coalesce("folder", F.concat(F.lit("run="), "run_id"))
    return refs.select("table_name", "month", "run_id", F.concat_ws("/", F.lit(store.root), "table_name", F.concat(F.lit("month="), "month"), folder).alias("location"))


def write_inventory(store: Store, path: str) -> None:
    write_text(store.spark, path, json.dumps([r.asDict() for r in inventory(store).orderBy("table_name", "month").collect()]))  # a row a month


def read_inventory(spark, path: str) -> DataFrame:
    return spark.read.option("multiLine", "true").schema("table_name string, month string, run_id string, location string").json(path)


def fingerprints(rows: DataFrame, by: str, columns: list[str] | None = None) -> DataFrame:
    """By group, how many rows there are and two sums of row hashes: equal for equal multisets of rows, whatever their order or
    files, and else, but for a chance of 2**-64 or so, different."""
    kinds = dict(rows.dtypes)
    values = [F.to_json(F.col(f"`{c}`")) if kinds[c].startswith("map") else F.col(f"`{c}`") for c in sorted(columns or rows.columns)]
    # a hash passes over nulls, so which columns are null is hashed as well
    nulls = F.concat_ws("", *[F.when(v.isNull(), "0").otherwise("1") for v in values])
    whole = lambda *more: F.sum(F.xxhash64(*more, nulls, *values).cast("decimal(20,0)"))
    return rows.groupBy(by).agg(F.count("*").alias("rows"), whole().alias("sum_a"), whole(F.lit("b")).alias("sum_b"))


def restore_report(store: Store, listed: DataFrame) -> DataFrame:
    """Each listed month read from its location alone, against what readers see: table_name, month, from_files, live, verdict.

    Verdicts: same; missing (not listed) and unknown (not published); another month (its rows are those of another published
    month); rows lost or rows added, by their number; rows changed.
    """
    spark = store.spark
    places: dict[str, list] = {}
    for r in listed.collect():  # a row a month
        places.setdefault(r.table_name, []).append(r)
    folder = lambda c: F.concat_ws("/", F.regexp_extract(c, r"month=([^/]+)/run=", 1), F.regexp_extract(c, r"/(run=[^/]+)", 1))
    out = []
    for table, rows in sorted(places.items()):
        live_rows = store.read(table)
        columns = [c for c in live_rows.columns if c != "bucket"]
        told = spark.createDataFrame([(r.month, r.location) for r in rows], "listed string, location string").select("listed", folder(F.col("location")).alias("place"))
        read = spark.read.schema(live_rows.select(*columns).schema).option("recursiveFileLookup", "true").parquet(*[r.location for r in rows])
        found = fingerprints(read.withColumn("mm_place", folder(F.col("_metadata.file_path"))), "mm_place", columns).join(F.broadcast(told), F.col("mm_place") == F.col("place"))
        live = fingerprints(live_rows, "month", columns).withColumnsRenamed({"rows": "live", "sum_a": "live_a", "sum_b": "live_b"})
        others = live.select(F.col("live_a").alias("sum_a"), F.col("live_b").alias("sum_b"), F.lit(True).alias("known")).distinct()
        joined = found.join(others, ["sum_a", "sum_b"], "left").join(live, found["listed"] == live["month"], "full_outer")
        verdict = (
            F.when(F.col("listed").isNull(), "missing").when(F.col("live").isNull(), "unknown").when((F.col("sum_a") == F.col("live_a")) & (F.col("sum_b") == F.col("live_b")) & (F.col("rows") == F.col("live")), "same")
            .when(F.col("known"), "another month").when(F.col("rows") < F.col("live"), "rows lost").when(F.col("rows") > F.col("live"), "rows added").otherwise("rows changed")
        )
        out.append(joined.select(F.lit(table).alias("table_name"), F.coalesce("listed", "month").alias("month"), F.coalesce("rows", F.lit(0)).alias("from_files"), F.coalesce("live", F.lit(0)).alias("live"), verdict.alias("verdict")))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], "table_name string, month string, from_files bigint, live bigint, verdict string")


def restore_drill(store: Store, listed: DataFrame) -> DataFrame:
    """Rows of each table counted from the listed locations alone, beside those that readers see; ``matches``: they are the same
    rows, month by month."""
    report = restore_report(store, listed)
    return report.groupBy("table_name").agg(F.sum("from_files").alias("from_files"), F.sum("live").alias("live"), F.bool_and(F.col("verdict") == "same").alias("matches"))
