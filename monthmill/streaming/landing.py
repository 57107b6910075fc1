"""Landing as a stream: new PGN files become games as they arrive, and each batch is handed on month by month."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import pgnsource
from ..sources.pgn import parse_games


def stream_games(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Games of PGN files as they are put under path; the month is that of a game's UTC date. Lines end in LF; of a file with
    CR LF, which a separator cannot cut, all games are still found, but by one task."""
    text = spark.readStream.format("text").option("lineSep", "\n\n[").option("maxFilesPerTrigger", files_per_batch).load(path)
    games = parse_games(text.select("value", F.col("_metadata.file_name").alias("_source_file")))
    return games.withColumn("month", F.replace(F.substring("UTCDate", 1, 7), F.lit("."), F.lit("-")))


def stream_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The same by the source "pgn": files come whole into a batch, but in byte ranges, with either line end."""
    pgnsource.register(spark)
    games = parse_games(spark.readStream.format("pgn").load(path).select("value", F.col("file").alias("_source_file")))
    return games.withColumn("month", F.replace(F.substring("UTCDate", 1, 7), F.lit("."), F.lit("-")))


def land_stream(games: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Give each batch to ``sink`` (which may publish months), until what is there has been read."""
    return games.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_landing(root: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes a batch under its own folder, so that a batch that comes again replaces itself."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").partitionBy("month").parquet(f"{root}/batch={number}")

    return sink
