"""The landing area: Parquet a month, a manifest that commits it, and what compares the two with the source's inventory."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "month string, games bigint, sha256 string, files array<string>"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def files_under(spark: SparkSession, path: str) -> DataFrame:
    """Files under a path: path, length, modified; from the file source's own listing, without reading them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path"), F.col("length"), F.col("modificationTime").alias("modified"))


def land_month(spark: SparkSession, games: DataFrame, root: str, month: str, expected: int, sha256: str, file_rows: int = 1_000_000) -> int:
    """Write a month and commit it: files first, then the count is compared with the published one, then the manifest is
    written, then files of earlier tries go. A wrong count leaves the manifest, and so the month, as it was."""
    import uuid

    data = f"{root}/month={month}"
    part = f"{data}/{uuid.uuid4().hex}"
    games.write.option("compression", "zstd").option("maxRecordsPerFile", file_rows).parquet(part)
    rows = spark.read.parquet(part).count()
    fs, p = _fs(spark, part)
    if rows != expected:
        fs.delete(p, True)
        raise ValueError(f"{month}: {rows} games landed, {expected} published")
    names = [f.getPath().getName() for f in fs.listStatus(p) if f.getPath().getName().startswith("part-")]
    write_text(spark, f"{root}/_manifests/{month}.json", json.dumps({"month": month, "games": rows, "sha256": sha256, "files": names}))
    for old in fs.listStatus(p.getParent()):
        if old.getPath().getName() != p.getName():
            fs.delete(old.getPath(), True)
    return rows


def read_landing(spark: SparkSession, root: str, month: str) -> DataFrame:
    """Rows of a landed month; the files' own ``month`` column is the one that counts."""
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/month={month}")


def manifests(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("multiLine", "true").json(f"{root}/_manifests/*.json")


def rows_by_month(rows: DataFrame) -> DataFrame:
    return rows.groupBy("month").agg(F.count("*").alias("rows"))


def landed_vs_manifest(landed: DataFrame, manifest: DataFrame) -> DataFrame:
    """Months of either side with both counts; ``matches`` is false where one is missing or they differ."""
    joined = manifest.select("month", F.col("games").alias("expected")).join(landed.select("month", F.col("rows").alias("landed")), "month", "full_outer")
    return joined.withColumn("matches", F.col("expected").eqNullSafe(F.col("landed")))


def ingest_plan(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    """Status of each month of the inventory: pending without a manifest, changed with another checksum, else done."""
    m = manifest.select("month", F.col("sha256").alias("landed_sha256"))
    status = F.when(F.col("landed_sha256").isNull(), "pending").when(F.col("landed_sha256") != F.col("sha256"), "changed").otherwise("done")
    return inventory.join(m, "month", "left").withColumn("status", status)


def unpublished(manifest: DataFrame, published: DataFrame) -> DataFrame:
    """Months with a manifest that were never published."""
    return manifest.select("month").join(published.select("month"), "month", "left_anti")


def read_inventory(spark: SparkSession, root: str, suffix: str = ".pgn.zst") -> DataFrame:
    """The source's list, counts and checksums (list.txt, counts.txt, sha256sums.txt) joined by file name: month, file, url,
    games, sha256, by month. Names with another ending are ignored; a file without a count or checksum fails the query."""
    text = lambda name: spark.read.text(f"{root}/{name}").select(F.trim("value").alias("line")).where(F.col("line") != "")
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    urls = text("list.txt").select(F.col("line").alias("url"), name(F.col("line")).alias("file")).where(F.col("file").endswith(suffix))
    words = F.split("line", r"\s+")
    counts = text("counts.txt").select(name(words[0]).alias("file"), words[1].try_cast("bigint").alias("games"))
    sums = text("sha256sums.txt").select(name(words[1]).alias("file"), words[0].alias("sha256"))
    need = lambda c, what: F.coalesce(F.col(c), F.raise_error(F.concat(F.lit(f"no {what} for "), F.col("file"))).cast(dict(games="bigint", sha256="string")[c]))
    rows = urls.join(counts, "file", "left").join(sums, "file", "left")
    return rows.select(F.regexp_extract("file", r"(\d{4}-\d{2})", 1).alias("month"), "file", "url", need("games", "count").alias("games"), need("sha256", "checksum").alias("sha256")).orderBy("month")


def read_inventory_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", "true").schema("month string, file string, games bigint, bytes bigint, bytes_per_game double").csv(path)


def inventory_by_year(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy(F.substring("month", 1, 4).alias("year")).agg(F.count("*").alias("months"), F.sum("games").alias("games"), F.sum("bytes").alias("bytes"))
