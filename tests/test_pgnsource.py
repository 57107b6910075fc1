"""The source "pgn": ranges, frames, streams and commits."""

import io
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from monthmill.sources import pgn, pgnsource
from monthmill.streaming import landing as streaming


def text(games, end="\n", seed=1):
    """Games with comments, blank lines of blanks, brackets in moves and multi-byte characters."""
    rng = random.Random(seed)
    out = []
    for i in range(games):
        moves = rng.choice(["1. e4 e5 *", "*", "1. d4 {[%clk 0:01] é} d5" + end + "2. c4 *", "1. e4 " + "a" * rng.randrange(200)])
        out.append(f'[Event "{"ü" * rng.randrange(9)}"]{end}[Site "s{i}"]{end}{rng.choice(["", " ", chr(9) + "  "])}{end}{moves}{end}{rng.choice(["", end, "  " + end])}{end}')
    return "".join(out)


def sites(df):
    return sorted((r.Site, r.Event, r.movetext) for r in df.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_of_any_size_have_each_game_once(end):
    body = text(60, end).encode()
    whole = [r for _, r in pgnsource.cut([body])]
    assert len(whole) == 60
    f = io.BytesIO(body)
    for split in (1, 7, 64, 1000, len(body)):
        found = [r for at in range(0, len(body), split) for _, r in pgnsource.records_of_range(f, at, min(len(body), at + split))]
        assert found == whole
    assert [r for _, r in pgnsource.cut(body[i : i + 3] for i in range(0, len(body), 3))] == whole
    blanks = b"[A \"1\"]" + b"\n" + b" " * 20_000 + b"\n[B \"2\"]\n"
    assert len([r for at in range(0, len(blanks), 512) for _, r in pgnsource.records_of_range(io.BytesIO(blanks), at, at + 512)]) == 2


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_batch_and_stream(spark, tmp_path, end):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.pgn").write_bytes(text(40, end, i).encode())
    got = sites(pgn.read_pgn(spark, str(folder), "2020-01", "r", split_bytes=500))
    assert len(got) == 120 and got == sites(pgn.read_pgn(spark, str(folder), "2020-01", "r"))
    assert pgn.read_pgn(spark, str(folder), "2020-01", "r", split_bytes=500).rdd.getNumPartitions() > 10
    out, seen = [], streaming.stream_ranges(spark, str(folder))
    run = lambda: streaming.land_stream(seen, str(tmp_path / "checkpoint"), lambda batch, number: out.append(batch.count())).awaitTermination()
    run()
    assert sum(out) == 120
    (folder / "9.pgn").write_bytes(text(5, end, 9).encode())
    run()
    assert sum(out) == 125


def test_write_commits_by_its_manifest(spark, tmp_path):
    pgnsource.register(spark)
    rows = spark.createDataFrame([(f'[Site "s{i}"]\n\n*', "", 0) for i in range(50)], pgnsource.SCHEMA).repartition(4)
    path = str(tmp_path / "out")
    for mode, games in (("append", 50), ("append", 100), ("overwrite", 50)):
        rows.write.format("pgn").mode(mode).save(path)
        told = pgnsource.read_manifest(spark, path)
        assert told.agg(F.sum("games")).first()[0] == games == pgn.read_pgn(spark, path, "m", "r").count()
        assert {r.file for r in told.collect()} == {p.rpartition("/")[2] for p, _, _ in pgnsource.listed(path)}
    # what a task left that was lost is not in the manifest, and not read
    (tmp_path / "out" / "part-lost.pgn").write_text('[Site "half')
    assert pgn.read_pgn(spark, path, "m", "r").count() == 50
    packed = str(tmp_path / "packed")
    rows.write.format("pgn").mode("append").options(compression="zstd", frameGames=7).save(packed)
    (tmp_path / "packed" / "part-lost.pgn.zst").write_bytes(zstandard.ZstdCompressor().compress(b'[Site "half"]'))
    assert pgn.read_pgn_zst(spark, packed, "m", "r").count() == 50
    with pytest.raises(Exception, match="boom"):
        rows.select(F.when(F.col("value").contains("s7"), F.raise_error(F.lit("boom"))).otherwise(F.col("value")).alias("value"), "file", "start").write.format("pgn").mode("append").save(path)
    assert pgnsource.read_manifest(spark, path).agg(F.sum("games")).first()[0] == 50


@pytest.mark.parametrize("step", [97, 5000, 10**6])
def test_frames_cut_anywhere(spark, tmp_path, step):
    """Frames that end within games, boundaries and characters, a skippable frame, and one whose size is not told."""
    body = text(80).encode()
    packed = b"".join(zstandard.ZstdCompressor(write_checksum=bool(i % 2), write_content_size=bool(i % 3)).compress(body[i : i + step]) for i in range(0, len(body), step))
    skip = bytes([0x53, 0x2A, 0x4D, 0x18]) + (5).to_bytes(4, "little") + b"xxxxx"
    (tmp_path / "a.pgn.zst").write_bytes(packed[:0] + skip + packed)
    (tmp_path / "b.pgn.zst").write_bytes(zstandard.ZstdCompressor().compress(text(3, seed=4).encode()))
    index = pgnsource.frame_index(spark.createDataFrame([(str(tmp_path / n),) for n in ("a.pgn.zst", "b.pgn.zst")], "path string"))
    assert index.count() == -(-len(body) // step) + 1
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.pgn").write_bytes(body)
    (tmp_path / "plain" / "b.pgn").write_bytes(text(3, seed=4).encode())
    got = pgn.read_pgn_zst(spark, str(tmp_path), "m", "r")
    assert sites(got) == sites(pgn.read_pgn(spark, str(tmp_path / "plain"), "m", "r"))
    with pytest.raises(ValueError, match="cut off"):
        list(pgnsource.frames(io.BytesIO(packed[:-8]), len(packed) - 8))


class Counted(io.BytesIO):
    """A file that tells how much was read of it."""

    told = 0

    def read(self, n=-1):
        out = super().read(n)
        self.told += len(out)
        return out


def test_small_ranges_read_little_and_share_tasks():
    """A range reads about itself, not megabytes beyond it; a large input in small ranges is read by some hundred tasks."""
    body = text(5000).encode()
    f = Counted(body)
    for at in range(0, len(body), 20_000):
        list(pgnsource.records_of_range(f, at, min(len(body), at + 20_000)))
    assert f.told < 2 * len(body)
    files = [(f"/d/{i}", 10**9 + i, 0) for i in range(5)]
    tasks = pgnsource.ranges("/d", files, 100_000)
    assert len(tasks) < 2 * pgnsource.RANGE_TASKS and {t.split for t in tasks} == {100_000}
    for path, size, _ in files:
        own = [(t.start, t.end) for t in tasks if t.path == path]
        assert own[0][0] == 0 and own[-1][1] == size and all(a[1] == b[0] and a[1] % 100_000 == 0 for a, b in zip(own, own[1:], strict=False))


def test_ranges_of_a_task_have_each_game_once(tmp_path):
    (tmp_path / "a.pgn").write_bytes(body := text(500).encode())
    read = [r for b in pgnsource.read_range(pgnsource.Range(str(tmp_path / "a.pgn"), 0, len(body), 300)) for r in b.column(0).to_pylist()]
    assert [x.encode() for x in read] == [r for _, r in pgnsource.cut([body])]


def test_parsing_and_unpacking_go_a_little_at_once(spark, tmp_path, monkeypatch):
    """A large batch is parsed in slices, and a frame that packs well comes out in pieces."""
    assert pgn.PARSE_ROWS <= 2000
    rows = spark.range(9000, numPartitions=1).select(F.concat(F.lit('[Site "s'), "id", F.lit('"]\n\n*')).alias("value"), (F.spark_partition_id() * 0).alias("mm_at"))
    assert pgn.parse_games(rows).select("Site").distinct().count() == 9000
    packed = zstandard.ZstdCompressor().compress(("[Site \"s\"]\n\n" + "1. e4 " * 50 + "\n\n").encode() * 40_000)
    (tmp_path / "a.pgn.zst").write_bytes(packed)
    assert pgn.read_pgn_zst(spark, str(tmp_path), "m", "r").count() == 40_000
