"""Write-audit-publish of single months on plain Parquet.

Data lie in ``root/table/month=YYYY-MM/run=ID/``. A month is written under a new run, audited there, and published by
appending one row to the pointer table ``root/_refs``; readers resolve the newest pointer of a month once and then read that
folder's files, which nothing changes: compaction writes another folder of the same run and moves the pointer. A rejected run
appends nothing and is deleted. An empty month can be published. One writer a month at a time is assumed; publishing is as
atomic as one file append.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .checks import Check, audit, filled, gate, judged

REF = "table_name string, month string, run_id string, source_run_id string, published_at timestamp, folder string"
HISTORY = "run_id string, checked_at timestamp, table_name string, partition string, check_name string, passed boolean, observed bigint, expected bigint, detail string, blocking boolean"

CHECK_ROW = "check_name string, passed boolean, observed bigint, expected bigint, detail string, blocking boolean"


def new_run_id() -> str:
    return uuid.uuid4().hex


@dataclass
class Store:
    spark: SparkSession
    root: str

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        p, fs = self._path(path)
        return fs.exists(p)

    def _delete(self, path: str) -> None:
        p, fs = self._path(path)
        fs.delete(p, True)

    def _log(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).option("mergeSchema", "true").parquet(path) if self._exists(path) else self.spark.createDataFrame([], schema)

    def refs(self) -> DataFrame:
        return self._log("_refs", REF)

    def history(self) -> DataFrame:
        """All check rows; rows from before the blocking flag count as blocking."""
        return self._log("_checks", HISTORY).withColumn("blocking", F.coalesce("blocking", F.lit(True)))

    def versions(self, table: str) -> DataFrame:
        """The published run of each month and its folder: month, run_id, source_run_id, folder."""
        return latest_runs(self.refs().where(F.col("table_name") == table)).select("month", "run_id", "source_run_id", "folder")

    def run_path(self, table: str, month: str, run_id: str, folder: str | None = None) -> str:
        return f"{self.root}/{table}/month={month}/{folder or f'run={run_id}'}"

    def point(self, table: str, month: str, run_id: str, source_run_id: str | None, folder: str | None = None) -> None:
        """Make a run, and the folder that holds it, the month's published one."""
        one = self.spark.range(1).select(
            F.lit(table).alias("table_name"), F.lit(month).alias("month"), F.lit(run_id).alias("run_id"), F.lit(source_run_id).cast("string").alias("source_run_id"), F.current_timestamp().alias("published_at"), F.lit(folder or f"run={run_id}").alias("folder")
        )
        one.coalesce(1).write.mode("append").parquet(f"{self.root}/_refs")

    def pin(self, table: str, month: str) -> str | None:
        row = self.versions(table).where(F.col("month") == month).first()
        return row.run_id if row else None

    def read_month(self, table: str, month: str, run_id: str | None = None) -> tuple[DataFrame, str]:
        """Rows of one published month as of one moment, and their run."""
        refs = self.refs().where((F.col("table_name") == table) & (F.col("month") == month))
        row = latest_runs(refs.where(F.col("run_id") == run_id) if run_id else refs).first()
        if row is None:
            raise LookupError(f"{table} has no month {month}")
        return self.spark.read.parquet(self.run_path(table, month, row.run_id, row.folder)), row.run_id

    def read(self, table: str, from_month: str | None = None, to_month: str | None = None) -> DataFrame:
        """Published rows of a range of months; only those months' files are listed and read."""
        v = self.versions(table)
        if from_month:
            v = v.where(F.col("month") >= from_month)
        if to_month:
            v = v.where(F.col("month") <= to_month)
        paths = [self.run_path(table, r.month, r.run_id, r.folder) for r in v.orderBy("month").collect()]  # a row a month
        if not paths:
            raise LookupError(f"{table} has no months in that range")
        return self._read_runs(paths)

    def _read_runs(self, paths: list[str]) -> DataFrame:
        """Rows of several runs; a single one keeps the column of its bucket folders, which several roots cannot have."""
        reader = self.spark.read.option("mergeSchema", "true")
        return (reader.option("recursiveFileLookup", "true") if len(paths) > 1 else reader).parquet(*paths)

    def read_months(self, table: str, months: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
        """Rows of the given published months as of one moment, and the run of each."""
        asked = set(months)
        found = [r for r in self.versions(table).collect() if r.month in asked]  # a row a month
        if missing := asked - {r.month for r in found}:
            raise LookupError(f"{table} has no month {min(missing)}")
        paths = [self.run_path(table, r.month, r.run_id, r.folder) for r in found]
        return self._read_runs(paths), {r.month: r.run_id for r in found}

    def record(self, table: str, month: str, run_id: str, checks: DataFrame) -> None:
        self._record(table, run_id, checks.withColumn("partition", F.lit(month)))

    def _record(self, table: str, run_id: str, checks: DataFrame) -> None:
        stamped = checks.select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("checked_at"), F.lit(table).alias("table_name"), "partition", "check_name", "passed", "observed", "expected", "detail", "blocking")
        stamped.coalesce(1).write.mode("append").parquet(f"{self.root}/_checks")

    def _audited_write(self, rows: DataFrame, path: str, measures: dict, checks: list[Check], bucketed: bool) -> DataFrame:
        """Write rows, and the check rows of what was written. The measures are observed while the rows are written, in the
        tasks that write them; measures that cannot be, such as distinct counts, are taken from the written files."""
        try:
            seen = Observation()
            rows = rows.observe(seen, *filled(measures))
        except AnalysisException:
            seen = None
        writer = rows.write.option("compression", "zstd")
        (writer.partitionBy("bucket") if bucketed else writer).parquet(path)
        values = seen.get if seen is not None else {}
        if set(values) == set(measures):
            return judged(self.spark.range(1).select(*[F.lit(values[k]).alias(k) for k in measures]), checks)
        return audit(self.spark.read.schema(rows.schema).parquet(path), measures, checks)

    def publish(self, table: str, month: str, rows: DataFrame, measures: dict, checks: list[Check], run_id: str, source_run_id: str | None = None, bucket: str | None = None, buckets: int = 16, sort: Iterable[str] = ()) -> bool:
        """Write and audit one month in one job, publish or reject it; whether it was published. Checks are recorded either way."""
        path = self.run_path(table, month, run_id)
        sort = list(sort)
        if bucket:
            rows = rows.withColumn("bucket", F.pmod(F.xxhash64(bucket), F.lit(buckets)).cast("int")).repartition(buckets, "bucket").sortWithinPartitions("bucket", *sort)
        elif sort:
            rows = rows.sortWithinPartitions(*sort)
        judged_rows = self._audited_write(rows, path, measures, checks, bool(bucket))
        found = self.spark.createDataFrame(judged_rows.collect(), CHECK_ROW)  # a row a check
        ok = gate(found)
        if ok:
            self.point(table, month, run_id, source_run_id)
        else:
            self._delete(path)
        self.record(table, month, run_id, found)
        return ok

    def publish_months(self, table: str, rows: DataFrame, measures: dict, checks: list[Check], run_id: str, source_run_id: str | dict[str, str] | None = None, told: DataFrame | None = None, sort: Iterable[str] = (), bucket: str | None = None, buckets: int = 16) -> dict[str, bool]:
        """Write all months of rows (by their column ``month``) in one job, audit them in one pass by month, and publish those
        that pass; whether each was. ``told``: a row a month, joined to rows for the audit. ``source_run_id``: one of all, or
        one a month. Months are moved into place, one folder each, and their pointers appended together."""
        staging = f"{self.root}/{table}/_staging-{run_id}"
        parts = ["mm_month"]
        if bucket:
            rows = rows.withColumn("bucket", F.pmod(F.xxhash64(bucket), F.lit(buckets)).cast("int"))
            parts.append("bucket")
        # where a month is larger than the session's advisory size, AQE splits it among tasks, a file each
        laid = rows.withColumn("mm_month", F.col("month")).hint("rebalance", *parts).sortWithinPartitions(*parts, *sort)
        laid.write.option("compression", "zstd").partitionBy(*parts).parquet(staging)
        written = self.spark.read.schema(rows.drop("bucket").schema).option("recursiveFileLookup", "true").parquet(staging)
        facts = {c: F.max(c) for c in told.columns if c != "month"} if told is not None else {}
        seen = written.join(F.broadcast(told), "month", "left") if told is not None else written
        found = self.spark.createDataFrame(audit(seen, measures | facts, checks, ["month"]).collect(), "month string, " + CHECK_ROW)  # a row a month and check
        good = found.groupBy("month").agg(F.bool_and(F.coalesce("passed", F.lit(False)) | ~F.coalesce("blocking", F.lit(True))).alias("ok")).collect()
        fs = self._path(staging)[1]
        for r in good:
            if r.ok:
                target = self._path(self.run_path(table, r.month, run_id))[0]
                fs.mkdirs(target.getParent())
                if not fs.rename(self._path(f"{staging}/mm_month={r.month}")[0], target):
                    raise RuntimeError(f"{table} {r.month}: could not be moved into place")
        self._delete(staging)
        sources = source_run_id if isinstance(source_run_id, dict) else {r.month: source_run_id for r in good}
        published = self.spark.createDataFrame([(r.month, sources.get(r.month)) for r in good if r.ok], "month string, source_run_id string")
        refs = published.select(F.lit(table).alias("table_name"), "month", F.lit(run_id).alias("run_id"), "source_run_id", F.current_timestamp().alias("published_at"), F.lit(f"run={run_id}").alias("folder"))
        refs.coalesce(1).write.mode("append").parquet(f"{self.root}/_refs")
        self._record(table, run_id, found.withColumnRenamed("month", "partition"))
        return {r.month: r.ok for r in good}

    def pending(self, source: str, *targets: str) -> list[str]:
        """Months of source that a target lacks, or built from another run than the one now published."""
        out: set[str] = set()
        for target in targets:
            out |= {r.month for r in pending_months(self.versions(source), self.versions(target)).collect()}
        return sorted(out)


def latest_runs(refs: DataFrame) -> DataFrame:
    """The newest pointer of each table and month: of equal times the larger run id."""
    newest = F.max(F.struct("published_at", "run_id", *[c for c in refs.columns if c not in ("table_name", "month", "published_at", "run_id")])).alias("r")
    return refs.groupBy("table_name", "month").agg(newest).select("table_name", "month", "r.*")


def pending_months(source: DataFrame, target: DataFrame) -> DataFrame:
    """Months of source (month, run_id) that target (month, source_run_id) lacks or has from another run."""
    built = target.select("month", F.col("source_run_id").alias("built_from"))
    return source.join(built, "month", "left").where(~F.col("run_id").eqNullSafe(F.col("built_from"))).select("month")


def build(store: Store, months: list[str] | str, source: str, targets: list[str], build_month: Callable[[Store, str], bool]) -> dict[str, bool]:
    """Build the given months, or those that are 'pending'; whether each was published."""
    todo = store.pending(source, *targets) if months == "pending" else list(months)
    return {m: build_month(store, m) for m in todo}


def with_defaults(rows: DataFrame, defaults: dict[str, object], legacy: Iterable[str] = ()) -> DataFrame:
    """Add columns that old files lack, and drop those that new ones no longer have."""
    for name, value in defaults.items():
        rows = rows.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in rows.columns else F.lit(value))
    return rows.drop(*legacy)
