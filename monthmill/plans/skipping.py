"""File skipping for published months: an index of what each file holds, consulted before files are listed or opened.

For each indexed column of a file the index has a Bloom filter of one hash, kept as the bitmaps of the 32,768-bit buckets that are
not empty, and, for strings, the least and the largest value. A lookup computes the bucket of its value, so it reads one bitmap of
4 KB a file, and lists the files whose bitmap has the value's bit and whose range has the value; only these are opened. Months that
were never indexed, or were compacted since, are read whole: a missing entry skips nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .publish import Store

INDEX = "table_name string, folder string, path string, column string, bucket bigint, bitmap binary, least string, most string"
#: Bits of a file's filter; only buckets with set bits take space. A file of a million keys has one in 17 of them set.
BITS = 1 << 24


def _place(value: Column) -> Column:
    return F.pmod(F.xxhash64(value.cast("string")), F.lit(BITS)) + 1


def _folder(path: Column) -> Column:
    """month=.../run=... of a file."""
    return F.regexp_extract(path, r"(month=[^/]+/run=[^/]+)/", 1)


def index_months(store: Store, table: str, columns: list[str], from_month: str | None = None, to_month: str | None = None) -> int:
    """Index these columns of the published files of a range of months; how many files were. One pass over the columns alone."""
    rows = store.read(table, from_month, to_month)
    kinds = dict(rows.dtypes)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), F.lit(kinds[c] == "string").alias("ordered")) for c in columns]))
    told = rows.select(F.col("_metadata.file_path").alias("path"), *columns).select("path", each.alias("e")).select("path", "e.*").where(F.col("value").isNotNull())
    ends = told.groupBy("path", "column").agg(F.min(F.when(F.col("ordered"), F.col("value"))).alias("least"), F.max(F.when(F.col("ordered"), F.col("value"))).alias("most"))
    at = _place(F.col("value"))
    maps = told.groupBy("path", "column", F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap"))
    index = maps.join(ends, ["path", "column"]).select(F.lit(table).alias("table_name"), _folder(F.col("path")).alias("folder"), "path", "column", "bucket", "bitmap", "least", "most")
    path = f"{store.root}/_index"
    before = _index(store)
    done = before.where(F.col("table_name") == table).select("path", "column").distinct()
    index.join(done, ["path", "column"], "left_anti").sortWithinPartitions("column", "bucket").select("table_name", "folder", "path", "column", "bucket", "bitmap", "least", "most").write.mode("append").parquet(path)
    return told.select("path").distinct().count()


def _index(store: Store) -> DataFrame:
    return store._log("_index", INDEX)


def files_for(store: Store, table: str, column: str, value, from_month: str | None = None, to_month: str | None = None) -> tuple[list[str], list[str]]:
    """Files of the published months that may have the value, and folders without an index, which must be read whole."""
    versions = store.versions(table)
    if from_month:
        versions = versions.where(F.col("month") >= from_month)
    if to_month:
        versions = versions.where(F.col("month") <= to_month)
    held = {f"month={r.month}/{r.folder or f'run={r.run_id}'}": store.run_path(table, r.month, r.run_id, r.folder) for r in versions.collect()}  # a row a month
    if not held:
        raise LookupError(f"{table} has no months in that range")
    own = _index(store).where((F.col("table_name") == table) & (F.col("column") == column) & F.col("folder").isin(*held))
    known = {r.folder for r in own.select("folder").distinct().collect()}
    told = F.lit(value).cast("string")
    at = _place(told)
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright(b, p) & 1") == 1
    hits = own.where((F.col("bucket") == F.bitmap_bucket_number(at)) & (F.col("least").isNull() | told.between(F.col("least"), F.col("most"))))
    hits = hits.withColumn("b", byte).withColumn("p", (bit % 8).cast("int")).where(is_set)
    return sorted(r.path for r in hits.select("path").distinct().collect()), sorted(p for f, p in held.items() if f not in known)


def lookup(store: Store, table: str, column: str, value, from_month: str | None = None, to_month: str | None = None) -> tuple[DataFrame, int]:
    """Published rows that have the value, and how many indexed files are opened for them."""
    files, whole = files_for(store, table, column, value, from_month, to_month)
    if not files and not whole:
        return store.read(table, from_month, to_month).where(F.lit(False)), 0
    rows = store.spark.read.option("mergeSchema", "true").parquet(*files, *whole)
    return rows.where(F.col(column) == F.lit(value)), len(files)
