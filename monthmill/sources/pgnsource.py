"""PGN text as a Spark data source: ``format("pgn")`` reads plain files in byte ranges, batch and stream, and writes them.

A game begins at a bracket behind a blank line, whatever the lines end with. A range has the games that begin in it: its reader
steps back over the blanks before the range, so that it sees a boundary at its very beginning, and reads on beyond the range
until its last game ends. Nothing but a directory's listing happens on the driver. Records come as they are (``value``, ``file``,
``start``); :func:`monthmill.sources.pgn.parse_games` makes games of them.

Zstd files are read by frames (:func:`read_frames`): one task a file finds where its frames begin, from the headers alone; each
frame is then unpacked by any task, and the ends of games that frames cut are put together again. A file of one frame is one
task's work, as a frame cannot be entered but at its beginning.

A write puts a file for each task, zstd ones in frames of ``frameGames`` games, and its commit writes ``manifest.json``: what is
not in it was not committed. Files are opened by any file system that Arrow knows.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

SCHEMA = "value string, file string, start bigint"
MANIFEST = "manifest.json"
#: Bytes of a range, bytes read at once, records of an Arrow batch, games of a zstd frame.
SPLIT_BYTES, READ_BYTES, BATCH_ROWS, FRAME_GAMES = 64 << 20, 4 << 20, 2000, 20_000
#: Packed bytes read at once.
PACKED_BYTES = 128 << 10
#: Bytes first read beyond a range's end, for the end of its last game.
READ_BEYOND = 4096
#: Where there are more ranges, those that follow one another share a task, which has about SPLIT_BYTES at most.
RANGE_TASKS = 256
BLANKS = b" \t\r\n"
BOUNDARY = re.compile(rb"\n[ \t\r]*\n\[")


def file_system(path: str):
    """Arrow's file system for a path, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(path: str) -> list[tuple[str, int, int]]:
    """Data files under a path, or the file itself: path, bytes, modified (ns)."""
    from pyarrow import fs

    system, at = file_system(path)
    info = system.get_file_info(at)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(at, recursive=True))
    return sorted((f.path, f.size, f.mtime_ns) for f in found if f.type == fs.FileType.File and f.base_name[0] not in "_." and f.base_name != MANIFEST)


def committed(path: str) -> list[tuple[str, int, int]]:
    """The same, but where a manifest lies there only the files in it: others are of writes that failed, or still go on."""
    files = listed(path)
    system, at = file_system(path)
    if not system.get_file_info(f"{at}/{MANIFEST}").is_file:
        return files
    with system.open_input_stream(f"{at}/{MANIFEST}") as f:
        names = {x["file"] for x in json.loads(f.read())["files"]}
    return [x for x in files if x[0].rpartition("/")[2] in names]


def cut(chunks: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """Records of a stream with the offsets at which they begin; the first begins with the stream, the last ends with it."""
    held, begin, scan = b"", 0, 0
    for chunk in chunks:
        held += chunk
        at = 0
        while m := BOUNDARY.search(held, scan):
            yield begin + at, held[at : m.start() + 1]
            at = scan = m.end() - 1
        held, begin = held[at:], begin + at
        # a boundary that is not yet whole begins with the blanks at the end
        scan = len(held.rstrip(BLANKS))
    if held:
        yield begin, held


def read_on(f, at: int, end: int) -> Iterator[bytes]:
    """What lies from ``at`` to ``end``, and then, as little as may end a game, what lies behind."""
    f.seek(at)
    beyond = READ_BEYOND
    while chunk := f.read(min(READ_BYTES, end - at) if at < end else beyond):
        beyond = min(READ_BYTES, 2 * beyond) if at >= end else beyond
        at += len(chunk)
        yield chunk


def records_of_range(f, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """The records that begin in a range of bytes, with their offsets."""
    base = start
    while base > 0:
        low = max(0, base - 4096)
        f.seek(low)
        before = f.read(base - low)
        kept = len(before.rstrip(BLANKS))
        base = low + kept
        if kept:
            break
    for offset, record in cut(read_on(f, base, end)):
        at = base + offset
        if at >= end:
            return
        # behind the file's beginning, what the stream begins with is the rest of an earlier game
        if at >= start and (offset or start == 0):
            yield at, record


def batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], most: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    split: int = SPLIT_BYTES


def ranges(root: str, files: list[tuple[str, int, int]], split: int) -> list[Range]:
    """What tasks read: bytes of a file, to be read in ranges of ``split`` bytes. A task has one of them, or, where there would
    be more than RANGE_TASKS, some that follow one another; so a small ``split`` makes no task for each few games."""
    scheme = re.match(r"^(?!file:)\w+://", root)
    named = [(f"{scheme[0]}{path}" if scheme else path, size) for path, size, _ in files]
    of_task = split * max(1, min(SPLIT_BYTES, sum(size for _, size in named) // RANGE_TASKS) // split)
    return [Range(path, at, min(size, at + of_task), split) for path, size in named for at in range(0, size, of_task)]


def read_range(part: Range) -> Iterator[pa.RecordBatch]:
    system, at = file_system(part.path)
    name = at.rpartition("/")[2]
    with system.open_input_file(at) as f:
        found = (x for low in range(part.start, part.end, part.split) for x in records_of_range(f, low, min(part.end, low + part.split)))
        rows = ((record.decode("utf-8", "replace"), name, start) for start, record in found if record.strip())
        yield from batches(rows, ["value", "file", "start"], [pa.string(), pa.string(), pa.int64()])


class PgnReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("splitBytes", SPLIT_BYTES))

    def partitions(self):
        return ranges(self.path, committed(self.path), self.split) or [Range(self.path, 0, 0)]

    def read(self, partition):
        return read_range(partition) if partition.end else iter(())


class PgnStreamReader(DataSourceStreamReader):
    """An offset is the last file seen, by time of change, then path: a batch has the files behind the one before's."""

    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("splitBytes", SPLIT_BYTES))

    def initialOffset(self):
        return {"changed": 0, "path": ""}

    def latestOffset(self):
        last = max(((changed, path) for path, _, changed in committed(self.path)), default=(0, ""))
        return {"changed": last[0], "path": last[1]}

    def partitions(self, start, end):
        low, high = ((o["changed"], o["path"]) for o in (start, end))
        return ranges(self.path, [f for f in committed(self.path) if low < (f[2], f[0]) <= high], self.split)

    def read(self, partition):
        return read_range(partition)

    def commit(self, end):
        """Nothing is kept of batches that are done."""


@dataclass
class Written(WriterCommitMessage):
    file: str
    games: int
    bytes: int
    sha256: str


class PgnWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite):
        self.path, self.zstd, self.frame = options["path"].rstrip("/"), options.get("compression") == "zstd", int(options.get("frameGames", FRAME_GAMES))
        self.overwrite = overwrite

    def write(self, iterator):
        import zstandard

        system, root = file_system(self.path)
        system.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.pgn{'.zst' if self.zstd else ''}"
        told, games = hashlib.sha256(), 0
        size = 0
        with system.open_output_stream(f"{root}/{name}", compression=None) as out:

            def put(texts: list[str]) -> int:
                body = "".join(texts).encode()
                body = zstandard.ZstdCompressor().compress(body) if self.zstd else body
                told.update(body)
                out.write(body)
                return len(body)

            held: list[str] = []
            for batch in iterator:
                for text in batch.column(0).to_pylist():
                    held.append(f"{(text or '').strip()}\n\n")
                    games += 1
                    if len(held) == self.frame:
                        size += put(held)
                        held = []
            if held:
                size += put(held)
        return Written(name, games, size, told.hexdigest())

    def commit(self, messages):
        system, root = file_system(self.path)
        new = [m for m in messages if m is not None]
        kept = []
        if not self.overwrite and system.get_file_info(f"{root}/{MANIFEST}").is_file:
            with system.open_input_stream(f"{root}/{MANIFEST}") as f:
                kept = json.loads(f.read())["files"]
        files = [*kept, *({"file": m.file, "games": m.games, "bytes": m.bytes, "sha256": m.sha256} for m in new if m.games)]
        with system.open_output_stream(f"{root}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps({"games": sum(f["games"] for f in files), "files": files}).encode())
        listed_now = {f["file"] for f in files}
        for path, _, _ in listed(self.path):
            own = path.rpartition("/")[2]
            # files of an overwritten table, and empty ones of this write
            if own not in listed_now and (self.overwrite or own in {m.file for m in new}):
                system.delete_file(path)

    def abort(self, messages):
        system, root = file_system(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(f"{root}/{m.file}")


class PgnSource(DataSource):
    @classmethod
    def name(cls):
        return "pgn"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PgnReader(self.options)

    def streamReader(self, schema):
        return PgnStreamReader(self.options)

    def writer(self, schema, overwrite):
        return PgnWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PgnSource)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files of the last commit: file, games, bytes, sha256."""
    one = spark.read.option("multiLine", "true").schema("games bigint, files array<struct<file: string, games: bigint, bytes: bigint, sha256: string>>").json(f"{path}/{MANIFEST}")
    return one.select(F.explode("files").alias("f")).select("f.*")


# -- zstd by frames --------------------------------------------------------------------------------------------------


def frames(f, size: int) -> Iterator[tuple[int, int]]:
    """Where each zstd frame begins and how long it is, from frame and block headers alone; skippable frames are passed over."""
    import zstandard

    at = 0
    while at < size:
        f.seek(at)
        head = f.read(18)
        if head[1:4] == b"\x2a\x4d\x18" and head[0] >> 4 == 5:
            at += 8 + int.from_bytes(head[4:8], "little")
            continue
        checked = zstandard.get_frame_parameters(head).has_checksum
        end = at + zstandard.frame_header_size(head)
        last = False
        while not last:
            f.seek(end)
            block = f.read(3)
            told = int.from_bytes(block, "little")
            last = bool(told & 1)
            end += 3 + (1 if told >> 1 & 3 == 1 else told >> 3)
            if len(block) < 3 or end > size:
                raise ValueError(f"the frame at {at} is cut off")
        end += 4 * checked
        yield at, end - at
        at = end


def frame_index(files: DataFrame) -> DataFrame:
    """path, frame, at, bytes of every frame of the zstd files of a column ``path``; a task a file."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for path in batch.column(0).to_pylist():
                system, at = file_system(path)
                with system.open_input_file(at) as f:
                    rows = ((path, i, a, n) for i, (a, n) in enumerate(frames(f, f.size())))
                    yield from batches(rows, ["path", "frame", "at", "bytes"], [pa.string(), pa.int64(), pa.int64(), pa.int64()])

    n = max(1, files.count())
    return files.select("path").repartition(n, "path").mapInArrow(run, "path string, frame bigint, at bigint, bytes bigint")


def unpacked(index: DataFrame) -> DataFrame:
    """path, frame, part, value: the records of each frame; part 0 is what it begins with, 2 what it ends with, which other
    frames may go on with, 1 what lies between. A frame streams through its task, a few MB at a time."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        def stream(f, at, size):
            f.seek(at)
            unpack = zstandard.ZstdDecompressor().decompressobj()
            # what comes of a read may be many times its size
            while size > 0 and (packed := f.read(min(size, PACKED_BYTES))):
                size -= len(packed)
                yield unpack.decompress(packed)

        def rows(path, frame, f, at, size):
            held = None
            for offset, record in cut(stream(f, at, size)):
                if held is not None:
                    yield path, frame, 0 if held[0] == 0 else 1, held[1]
                held = offset, record
            if held is not None:
                yield path, frame, 0 if held[0] == 0 else 2, held[1]

        for batch in found:
            for path, frame, at, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, place = file_system(path)
                with system.open_input_file(place) as f:
                    yield from batches(rows(path, frame, f, at, size), ["path", "frame", "part", "value"], [pa.string(), pa.int64(), pa.int32(), pa.binary()])

    spark = index.sparkSession
    # each frame is a task's own where there are as many tasks; AQE does not join them again
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = index.repartition(tasks, F.xxhash64("path", "frame"))
    return dealt.mapInArrow(run, "path string, frame bigint, part int, value binary")


def stitched(parts: DataFrame) -> DataFrame:
    """path and value of whole records: those that frames cut are joined in the order of frames, as bytes, since a frame may end
    within a character. A record begins with each part 2 and with a file."""
    whole = parts.where("part = 1").select("path", F.col("value").cast("string").alias("value"))
    cut_ones = parts.where("part <> 1")
    order = Window.partitionBy("path").orderBy("frame", "part")  # two short rows a frame
    numbered = cut_ones.withColumn("record", F.sum((F.col("part") == 2).cast("long")).over(order))
    joined: Column = F.aggregate(F.array_sort(F.collect_list(F.struct("frame", "part", "value"))), F.lit(b""), lambda acc, x: F.concat(acc, x["value"]))
    return whole.unionByName(numbered.groupBy("path", "record").agg(joined.cast("string").alias("value")).select("path", "value"))


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """path and value of the records of all zstd files under a path; a listing by Spark's own file source, no contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zst").option("recursiveFileLookup", "true").load(path).select("path")
    manifest = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")
    if manifest.getFileSystem(spark._jsc.hadoopConfiguration()).exists(manifest):
        names = read_manifest(spark, path).select(F.col("file").alias("name"))
        files = files.join(names, F.element_at(F.split("path", "/"), -1) == F.col("name"), "left_semi")
    return stitched(unpacked(frame_index(files)))
