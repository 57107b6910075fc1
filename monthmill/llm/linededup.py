"""Line dedup with levelled sorted runs of line hashes, in DataFrame functions only.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased; it is held as two 64-bit hashes
with different salts. :class:`LineRuns` keeps, like a log-structured store, levels of runs: a run is a Parquet table of
(key, number of documents with it), dealt by key into files and sorted in each. A batch is reduced to a
run of level 0; when a level holds ``fanout`` runs they are merged into one of the next level. A batch is merge-anti-joined
with the runs first: a key that a run already has in enough documents is settled, and need not be stored again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, fresh, require, scratch_path

#: Blanks that a key loses at both ends.
BLANKS = " \t\n\x0b\x0c\r"
#: A key in at least so many documents is boilerplate.
MIN_DOCS = 10
#: Runs of a level that are merged into one of the next.
FANOUT = 3
#: Batches into which one table is dealt: the last one meets a merged run.
BATCHES = 4
#: Tasks to which the rows of one key, or of one text, are dealt.
SALTS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """Lines of a text; null or empty: one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.btrim(F.translate(line, UPPER, LOWER), F.lit(BLANKS))


def key_hash(key: Column) -> Column:
    """128 bits of a key; null for an empty key, which is never dropped."""
    return F.when(F.length(key) > 0, F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b")))


def key_hashes(text: Column) -> Column:
    """The distinct key hashes of a text's lines."""
    return F.array_compact(F.array_distinct(F.transform(lines_of(text), lambda x: key_hash(line_key(x)))))


class LineRuns:
    """Levelled sorted runs of (key hash, documents) in the shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        if fanout < 2 or min_docs < 1:
            raise ValueError("fanout must be at least 2 and min_docs at least 1")
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.root = scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = []

    def read(self, path: str) -> DataFrame:
        return self.spark.read.schema("a bigint, b bigint, n bigint").parquet(path)

    def runs(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def _write(self, counts: DataFrame, level: int) -> str:
        path = f"{self.root}/level={level}/{uuid.uuid4().hex}"
        counts.sortWithinPartitions("a", "b").write.parquet(path)
        return path

    def _merged(self, paths: Sequence[str]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.read(p) for p in paths]).groupBy("a", "b").agg(F.sum("n").alias("n"))

    def add(self, docs: DataFrame, text_col: str = "text") -> None:
        """Add a batch of documents; a document counts once for each of its keys."""
        self.put(docs.select(F.explode(key_hashes(F.col(text_col))).alias("k")).groupBy("k.a", "k.b").agg(F.count("*").alias("n")))

    def put(self, counts: DataFrame) -> None:
        """Add a batch's counts (a, b, n) as a run of level 0, without the keys that are settled, then compact."""
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(self.unsettled(counts), 0))
        self.compact()

    def compact(self) -> None:
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                old = self.levels[level]
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(self._merged(old), level + 1))
                self.levels[level] = []
                discard(self.spark, *old)
            level += 1

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """Rows of counts whose key no run alone has in min_docs documents: one merge-anti-join with each run."""
        for path in self.runs():
            counts = counts.join(self.read(path).where(F.col("n") >= self.min_docs).select("a", "b"), ["a", "b"], "left_anti")
        return counts

    def common(self) -> DataFrame:
        """Keys (a, b) in at least min_docs documents of all batches."""
        if not self.runs():
            return self.spark.createDataFrame([], "a bigint, b bigint")
        return self._merged(self.runs()).where(F.col("n") >= self.min_docs).select("a", "b")


def drop_common_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Every row with its ``kept_text``, ``n_lines`` and ``n_dropped``: lines whose key is in at least ``min_docs`` rows go.

    All columns of docs come back; where docs has a column of a result's name, it is replaced. Each row is a document, also
    where rows repeat. Null or empty texts are one empty line, which stays ('' kept, never null); keys without a code point
    are never dropped. Empty tables give no rows.

    Rows are dealt into ``batches`` by a hash of the text, and each batch is added to the runs in turn. Lines become hashes
    where they are read, counts are combined before they are dealt by key, and each row's dropped keys come back by the
    row's own hash; texts move once, in that last join.
    """
    require(docs, text_col)
    if batches < 1:
        raise ValueError("batches must be at least 1")
    spark = docs.sparkSession
    text = F.col(text_col)
    runs = LineRuns(spark, min_docs, fanout)
    # the keys of each row, hashed once; a row is known by its text, as rows with equal texts lose equal lines
    staged = scratch_path(spark, "line-keys")
    own = docs.select(text.alias("t")).select(F.xxhash64("t").alias("ta"), F.xxhash64(F.lit("text"), "t").alias("tb"), F.explode(key_hashes(F.col("t"))).alias("k"))
    own.select("ta", "tb", "k.a", "k.b", F.pmod("ta", F.lit(batches)).cast("int").alias("batch")).write.partitionBy("batch").parquet(staged)
    keys = spark.read.schema("ta bigint, tb bigint, a bigint, b bigint, batch int").parquet(staged)
    for batch in range(batches):
        runs.put(keys.where(F.col("batch") == batch).groupBy("a", "b").agg(F.count("*").alias("n")))
    # a key of very many rows is dealt to SALTS tasks, and the common keys to each of them
    bad = runs.common().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mine = keys.select("ta", "tb", "a", "b", F.pmod("tb", F.lit(SALTS)).cast("int").alias("salt"))
    drops = mine.join(bad, ["a", "b", "salt"], "left_semi").groupBy("ta", "tb").agg(F.collect_set(F.struct("a", "b")).alias("bad"))
    ta, tb, salt, hit = (fresh(docs, c) for c in ("mm_ta", "mm_tb", "mm_salt", "mm_bad"))
    rest = [c for c in docs.columns if c.lower() not in ("kept_text", "n_lines", "n_dropped")]
    # copies of a text are told apart by their other columns, so that no task gets a large group of them
    other = [F.col(f"`{c}`") for c, t in docs.dtypes if c != text_col and not t.startswith("map")]
    spread = F.pmod(F.xxhash64(*other), F.lit(SALTS)).cast("int") if other else F.lit(0)
    named = docs.select(*[F.col(f"`{c}`") for c in rest], *([] if text_col in rest else [text]), F.xxhash64(text).alias(ta), F.xxhash64(F.lit("text"), text).alias(tb), spread.alias(salt))
    drops = drops.select(F.col("ta").alias(ta), F.col("tb").alias(tb), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(salt), F.col("bad").alias(hit))
    lines = lines_of(text)
    kept = F.when(F.col(hit).isNull(), lines).otherwise(F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col(hit), key_hash(line_key(x))), F.lit(False))))
    joined = named.join(drops, [ta, tb, salt], "left")
    return joined.select(*[F.col(f"`{c}`") for c in rest], F.array_join(kept, "\n").alias("kept_text"), F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(kept)).cast("long").alias("n_dropped"))
