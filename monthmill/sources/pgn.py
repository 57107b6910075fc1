"""Game dumps in PGN text to one row a game.

A record ends at a blank line followed by a tag line. The source "pgn" reads plain files in ranges; for packed ones that
separator is the ``lineSep`` of Spark's text reader, a record but the first comes without its leading bracket, and a file's first
lines tell how its lines end. The text reader may miss a separator among further blank lines at the edge of its buffer, so a record that
still holds one is cut again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pgnsource

# The tags that get a column.
TAGS = "Event Site Date Round White Black Result UTCDate UTCTime WhiteElo BlackElo WhiteRatingDiff BlackRatingDiff WhiteTitle BlackTitle ECO Opening TimeControl Termination Variant FEN SetUp".split()
#: What lies between the quotes of a usual header: a first name, a further one, the end.
BETWEEN = re.compile(r"(\[?|\]\n\[)(\w+) ", re.A)
#: Any tag line: its name, and its value, quoted to the line's end or bare.
TAG = re.compile(r'\[?(\w++)[ \t]*+("(?:[^"\\]++|\\.)*+"(?=[ \t]*\]?\Z)|.*?)[ \t]*\]?\Z', re.A)
#: Where a record that holds several games is cut, and a first line that is a tag though its separator took the bracket.
CUT, BARE_TAG = re.compile(r"\n[ \t]*\n\["), re.compile(r"\w+(\s.*)?\]\Z", re.A)
EXTRA = pa.map_(pa.string(), pa.string())
#: Records that are parsed at once, as what the kernels make of them on the way is many times their size.
PARSE_ROWS = 2000


def unquoted(value: str) -> str:
    """A tag's value without its quotes, \\" and then \\\\ unescaped; an unquoted value as it is; a missing one ''."""
    quoted = len(value) > 1 and value[0] == value[-1] == '"'
    return value[1:-1].replace('\\"', '"').replace("\\\\", "\\") if quoted else value


def game_by_lines(text: str) -> tuple[dict[str, str], str]:
    """Tags, the last of a name winning, and movetext of any text, line by line."""
    lines = [line for x in text.split("\n") if (line := x.strip(" \t\r"))]
    is_tag = [x[0] == "[" or (i == 0 and BARE_TAG.match(x) is not None) for i, x in enumerate(lines)]
    told = [m for x, t in zip(lines, is_tag, strict=True) if t and (m := TAG.match(x))]
    return {m[1]: unquoted(m[2]) for m in told}, " ".join([x for x, t in zip(lines, is_tag, strict=True) if not t])


def odd_games(records: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """The games of any records (binary), with the places of their records: a column for each tag, movetext and the others.
    Bytes that are no UTF-8 become U+FFFD."""
    texts = [(x or b"").decode("utf-8", "replace").strip(" \t\r\n").replace("\r\n", "\n") for x in records.to_pylist()]
    games = [(i, *game_by_lines(x)) for i, text in enumerate(texts) for x in CUT.split(text) if x]
    told = [pa.array([tags.get(t) for _, tags, _ in games], pa.string()) for t in TAGS]
    extra = [[(k, v) for k, v in tags.items() if k not in TAGS] or None for _, tags, _ in games]
    return np.array([i for i, _, _ in games], np.int64), [*told, pa.array([m for _, _, m in games], pa.string()), pa.array(extra, EXTRA)]


def usual_games(text: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """The same of those records (trimmed, lines ending in LF) that are one game with a usual header: tag lines, the first
    perhaps without its bracket, nothing escaped in them, then a blank line and moves. Headers are cut at their quotes, all at
    once; every second cut must then be what lies between two values."""
    n = len(text)
    halves = pc.split_pattern(text, "\n\n", max_splits=1)
    at = halves.offsets.to_numpy().astype(np.int64)
    head = halves.values.take(pa.array(at[:-1]))
    moves = pc.utf8_trim(pc.fill_null(halves.values.take(pa.array(at[:-1] + 1, mask=np.diff(at) < 2)), ""), " \t\r\n")
    cuts = pc.split_pattern(head, '"')
    at = cuts.offsets.to_numpy().astype(np.int64)
    count = np.diff(at)
    record = np.repeat(np.arange(n), count)
    place = np.arange(len(record)) - at[:-1][record]
    even = np.flatnonzero(place % 2 == 0)
    codes = cuts.values.take(pa.array(even)).dictionary_encode()
    # of each different piece between quotes: is it a first name (1), a further one (2), the end (3); and which name
    pieces = codes.dictionary.to_pylist()
    found = [BETWEEN.fullmatch(x) for x in pieces]
    kinds = np.array([3 if x == "]" else 0 if m is None else 2 if m[1][:1] == "]" else 1 for x, m in zip(pieces, found, strict=True)], np.int8)
    names = [m and m[2] for m in found]
    code = codes.indices.to_numpy()
    wanted = np.where(place[even] == 0, 1, np.where(place[even] == count[record[even]] - 1, 3, 2))
    wrong = np.bincount(record[even], kinds[code] != wanted, n)
    lines = count // 2
    good = (wrong == 0) & (count % 2 == 1) & (lines > 0) & (pc.count_substring(head, "\n").to_numpy() == lines - 1)
    good &= ~np.asarray(pc.match_substring(head, "\\")) & ~np.asarray(pc.match_substring_regex(moves, r"(?m)^[ \t]*\["))
    kept = np.flatnonzero(good)
    row = np.full(n, -1)
    row[kept] = np.arange(len(kept))
    used = good[record[even]] & (kinds[code] != 3)
    rows, values, code = row[record[even][used]], even[used] + 1, code[used]

    def value_of(names_codes: list[int]) -> pa.Array:
        here = np.isin(code, names_codes) if len(names_codes) != 1 else code == names_codes[0]
        found_at = np.full(len(kept), -1)
        found_at[rows[here]] = values[here]  # the last of a name wins
        return cuts.values.take(pa.array(found_at, mask=found_at < 0))

    told = [value_of([i for i, x in enumerate(names) if x == t]) for t in TAGS]
    extra: list = [None] * len(kept)
    others = np.flatnonzero(np.array([x not in TAGS for x in names], bool)[code])
    for r, v, c in zip(rows[others].tolist(), cuts.values.take(pa.array(values[others])).to_pylist(), code[others].tolist(), strict=True):
        extra[r] = {**(extra[r] or {}), names[c]: v}
    moves = pc.replace_substring_regex(moves.take(pa.array(kept)), r"[ \t\r\f\v]*\n[ \t\r\n\f\v]*", " ")
    return kept, [*told, moves, pa.array([x and list(x.items()) for x in extra], EXTRA)]


def parse_games(records: DataFrame, value: str = "value") -> DataFrame:
    """One row for each game: a column for each known tag, ``movetext`` (its lines joined by a space, '' where there is
    none) and ``extra_tags`` (a map, null where empty). Bytes that are no UTF-8 become U+FFFD. Null and blank records are
    skipped, and a record that holds several games, as a separator may be missed or lines may end otherwise, is cut into them.

    Usual games are parsed by Arrow's kernels, a batch at once; only odd ones one by one. As column expressions, each of which
    makes a string of its own, the same took twice the time and more."""
    rest = [c for c in records.columns if c != value]
    strings = ", ".join(f"{t} string" for t in [*TAGS, "movetext"])
    schema = T.StructType([records.schema[c] for c in rest] + T._parse_datatype_string(f"{strings}, extra_tags map<string,string>").fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, PARSE_ROWS) for whole in batches for at in range(0, whole.num_rows, PARSE_ROWS)):
            held, raw, odd = batch.columns[:-1], batch.column(len(rest)), np.arange(batch.num_rows)
            try:
                text = pc.replace_substring(pc.utf8_trim(pc.fill_null(raw.cast(pa.string()), ""), " \t\r\n"), "\r\n", "\n")
                kept, columns = usual_games(text)
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(kept)) for c in held), *columns], names=names)
                odd = np.setdiff1d(odd, kept)
            except pa.ArrowInvalid:  # bytes that are no UTF-8
                pass
            if len(odd):
                at, columns = odd_games(raw.take(pa.array(odd)))
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(odd[at])) for c in held), *columns], names=names)

    return records.select(*rest, F.col(value).cast("binary").alias("mm_value")).mapInArrow(run, schema)


def with_lineage(rows: DataFrame, month: str, source_file: str | Column, run_id: str) -> DataFrame:
    source = source_file if isinstance(source_file, Column) else F.lit(source_file)
    return rows.withColumns({"month": F.lit(month), "_source_file": source, "_run_id": F.lit(run_id), "_ingested_at": F.current_timestamp()})


def line_ends(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files under path by how their lines end, told by the first 64 KB of each, unpacked where Hadoop has the codec."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    out: dict[str, list[str]] = {}
    for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").collect():  # a row a file
        p = jvm.org.apache.hadoop.fs.Path(r.path)
        stream = p.getFileSystem(conf).open(p)
        codec = codecs.getCodec(p)
        stream = codec.createInputStream(stream) if codec is not None else stream
        try:
            head = bytes(stream.readNBytes(1 << 16))
        finally:
            stream.close()
        out.setdefault("\r\n" if head.partition(b"\n")[0].endswith(b"\r") else "\n", []).append(r.path)
    return out


def read_pgn(spark: SparkSession, path: str, month: str, run_id: str, source_file: str | None = None, split_bytes: int = pgnsource.SPLIT_BYTES) -> DataFrame:
    """Games of the PGN text under path, whose lines end in LF or in CR LF. Plain files are read in byte ranges by the source
    "pgn"; where some are packed (.gz, .bz2), or lie where only Spark reads, Spark's text reader reads them."""
    files = [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").collect()]  # a row a file
    try:
        pgnsource.file_system(path)
        ranged = not any(f.endswith((".gz", ".bz2", ".zst")) for f in files)
    except (ValueError, OSError):
        ranged = False
    if ranged:
        pgnsource.register(spark)
        text = spark.read.format("pgn").option("splitBytes", split_bytes).load(path).select("value", F.col("file").alias("mm_file"))
    else:
        texts = [spark.read.option("lineSep", f"{end}{end}[").text(held) for end, held in sorted(line_ends(spark, path).items())]
        text = reduce(DataFrame.unionByName, [t.select("value", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("mm_file")) for t in texts])
    return with_lineage(parse_games(text), month, source_file or F.col("mm_file"), run_id).drop("mm_file")


def read_pgn_zst(spark: SparkSession, path: str, month: str, run_id: str) -> DataFrame:
    """The same for zstd files of any size, a task a frame: see :mod:`monthmill.sources.pgnsource`."""
    texts = pgnsource.read_frames(spark, path).select("value", F.element_at(F.split("path", "/"), -1).alias("mm_file"))
    return with_lineage(parse_games(texts), month, F.col("mm_file"), run_id).drop("mm_file")


def as_pgn(games: DataFrame) -> Column:
    """A raw game row as PGN text: its tags that are not null, a blank line, its movetext."""
    quoted = lambda c: F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    tags = [F.when(F.col(t).isNotNull(), F.concat(F.lit(f"[{t} \""), quoted(F.col(t)), F.lit('"]\n'))).otherwise("") for t in TAGS if t in games.columns]
    return F.concat(*tags, F.lit("\n"), F.coalesce(F.col("movetext"), F.lit("")), F.lit("\n"))


def write_pgn(games: DataFrame, path: str) -> None:
    games.select(as_pgn(games).alias("value")).write.option("lineSep", "\n").text(path)


def unknown_tags(games: DataFrame, k: int = 20) -> DataFrame:
    """Games by unknown tag, the most frequent ``k``."""
    names = games.select(F.explode(F.map_keys("extra_tags")).alias("tag"))
    return names.groupBy("tag").agg(F.count("*").alias("games")).orderBy(F.desc("games"), "tag").limit(k)
