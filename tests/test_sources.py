import datetime as dt
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from monthmill.sources import cost, landing, pgn

TEXT = """[Event "A \\"quoted\\" \\\\ name"]
[Site "https://games.example/abcd1234"]
[White plain]
[Black]
[Extra "one"]
[Extra "two"]

1. e4 e5
2. Nf3 1-0

[Event "Second"]
[Result "0-1"]

[Event "Third"]

* """


def test_read_pgn(spark, tmp_path):
    (tmp_path / "a.pgn").write_bytes(TEXT.encode() + b"\n\n[Event \"bad \xff byte\"]\n\n1. d4 *\n")
    rows = {r.Event: r for r in pgn.read_pgn(spark, str(tmp_path), "2013-01", "run").collect()}
    assert set(rows) == {'A "quoted" \\ name', "Second", "Third", "bad � byte"}
    first = rows['A "quoted" \\ name']
    assert (first.White, first.Black, first.extra_tags, first.movetext, first.Result) == ("plain", "", {"Extra": "two"}, "1. e4 e5 2. Nf3 1-0", None)
    assert (rows["Second"].movetext, rows["Second"].Result, rows["Third"].movetext, rows["Second"].extra_tags) == ("", "0-1", "*", None)
    assert first._source_file == "a.pgn" and first.month == "2013-01"


@pytest.mark.parametrize(("end", "blanks"), [("\n", 1), ("\r\n", 1), ("\n", 3), ("\r\n", 2)])
def test_splits_never_cut_a_game(spark, tmp_path, end, blanks):
    games = ("\n" * blanks).join(f'[Event "E{i}"]\n[Site "s{i}"]\n\n1. e4 e5 {i}\n' for i in range(400))
    (tmp_path / "b.pgn").write_bytes(games.replace("\n", end).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "777b")
    try:
        got = {r.Event: r.movetext for r in pgn.read_pgn(spark, str(tmp_path), "2013-01", "run").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {f"E{i}": f"1. e4 e5 {i}" for i in range(400)}


def test_large_dumps_with_either_line_end(spark, tmp_path):
    """Separators across the edges of read buffers, with further blank lines before them."""
    for name, end, blanks in (("a", "\n", 2), ("b", "\r\n", 2), ("c", "\r\n", 1)):
        games = ("\n" * blanks).join(f'[Event "{name}{i}"]\n[Site "s{"x" * (i % 61)}"]\n\n1. e4 e5 {i}\n' for i in range(20_000))
        (tmp_path / f"{name}.pgn").write_bytes(games.replace("\n", end).encode())
    rows = pgn.read_pgn(spark, str(tmp_path), "2013-01", "run")
    assert rows.groupBy("_source_file").count().where("count = 20000").count() == 3
    assert rows.where(F.col("movetext") != F.concat(F.lit("1. e4 e5 "), F.substring("Event", 2, 9))).isEmpty()


def test_games_that_are_no_tag_block_and_moves(spark):
    texts = ['[Event "A"]\n1. e4 *\n[Site "s"]', 'Event "B"]\n\n1. e4 {[%clk 1]}\n\ne5\n', "1. d4 *", '[Event "C"]\n\n[Site "t"]\n\n*', "\r\n \r\n", '[Event "D"]\r\n\r\n1. c4\r\n\r\n\r\n[Event "E"]\r\n\r\n*']
    rows = pgn.parse_games(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert sorted((r.Event or "", r.Site or "", r.movetext) for r in rows) == [("", "", "1. d4 *"), ("", "t", "*"), ("A", "s", "1. e4 *"), ("B", "", "1. e4 {[%clk 1]} e5"), ("C", "", ""), ("D", "", "1. c4"), ("E", "", "*")]


def test_zst_and_write(spark, tmp_path):
    import zstandard

    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "m.pgn.zst").write_bytes(zstandard.compress(TEXT.encode()))
    rows = pgn.read_pgn_zst(spark, str(tmp_path / "z" / "*.zst"), "2013-01", "run")
    assert sorted(r.Event for r in rows.collect()) == ['A "quoted" \\ name', "Second", "Third"]
    pgn.write_pgn(rows, str(tmp_path / "out"))
    back = pgn.read_pgn(spark, str(tmp_path / "out"), "2013-01", "run")
    assert sorted(r.Event for r in back.collect()) == ['A "quoted" \\ name', "Second", "Third"]
    assert [tuple(r) for r in pgn.unknown_tags(rows).collect()] == [("Extra", 1)]


def test_landing(spark, tmp_path):
    root = str(tmp_path / "landing")
    games = spark.range(10).select(F.col("id"), F.lit("2013-01").alias("month"))
    assert landing.land_month(spark, games, root, "2013-01", 10, "abc") == 10
    with pytest.raises(ValueError, match="published"):
        landing.land_month(spark, games.limit(3), root, "2013-01", 10, "abc")
    assert landing.read_landing(spark, root, "2013-01").count() == 10
    assert landing.land_month(spark, games.limit(4), root, "2013-01", 4, "def") == 4
    assert landing.read_landing(spark, root, "2013-01").count() == 4
    m = landing.manifests(spark, root).collect()
    assert [(r.month, r.games, r.sha256) for r in m] == [("2013-01", 4, "def")] and m[0].files


def test_inventory(spark, tmp_path):
    (tmp_path / "list.txt").write_text("https://x/d_2013-02.pgn.zst\nhttps://x/d_2013-01.pgn.zst\nhttps://x/readme.txt\n")
    (tmp_path / "counts.txt").write_text("d_2013-01.pgn.zst 10\nd_2013-02.pgn.zst 20\n")
    (tmp_path / "sha256sums.txt").write_text("aa  d_2013-01.pgn.zst\nbb  d_2013-02.pgn.zst\n")
    got = [(r.month, r.games, r.sha256) for r in landing.read_inventory(spark, str(tmp_path)).collect()]
    assert got == [("2013-01", 10, "aa"), ("2013-02", 20, "bb")]
    (tmp_path / "counts.txt").write_text("d_2013-01.pgn.zst 10\n")
    with pytest.raises(Exception, match="no count"):
        landing.read_inventory(spark, str(tmp_path)).collect()
    (tmp_path / "inv.csv").write_text("month,file,games,bytes,bytes_per_game\n2013-01,a,10,100,10\n2013-02,b,20,300,15\n")
    year = landing.inventory_by_year(landing.read_inventory_csv(spark, str(tmp_path / "inv.csv"))).first()
    assert tuple(year) == ("2013", 2, 30, 400)


@pytest.mark.parametrize("name", ["Cost", "PreTaxCost", "totalCost"])
def test_cost_pages(spark, tmp_path, name):
    page = {"properties": {"columns": [{"name": n} for n in (name, "UsageDate", "ServiceName", "Currency")], "rows": [[1.25, 20261019, "storage", "USD"], [-2, 20261020, None, "USD"]], "nextLink": None}}
    (tmp_path / "p.json").write_text(json.dumps(page))
    got = [tuple(r) for r in cost.read_cost_pages(spark, str(tmp_path), "rg", "2026-10").orderBy("usage_date").collect()]
    assert got == [("2026-10", dt.date(2026, 10, 19), "rg", "storage", None, 1.25, "USD"), ("2026-10", dt.date(2026, 10, 20), "rg", None, None, -2.0, "USD")]


def test_cost_page_without_cost(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"properties": {"columns": [{"name": "UsageDate"}], "rows": [[20261019]]}}))
    with pytest.raises(Exception, match="no cost column"):
        cost.read_cost_pages(spark, str(tmp_path), "rg", "2026-10").collect()


def test_stream(spark, tmp_path):
    from monthmill.streaming import landing as streaming

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pgn").write_text('[Event "A"]\n[UTCDate "2013.01.02"]\n\n1. e4 *\n\n[Event "B"]\n[UTCDate "2013.02.02"]\n\n*\n')
    games = streaming.stream_games(spark, str(tmp_path / "in"))
    streaming.land_stream(games, str(tmp_path / "ckpt"), streaming.append_landing(str(tmp_path / "out"))).awaitTermination()
    assert {(r.Event, str(r.month)) for r in spark.read.parquet(str(tmp_path / "out" / "batch=*")).select("Event", "UTCDate").withColumn("month", F.substring("UTCDate", 1, 7)).collect()} == {("A", "2013.01"), ("B", "2013.02")}


def test_usual_games_as_line_by_line():
    """What the batch kernels take as usual is what looking at every line makes of it, whatever the texts are made of."""
    rng = random.Random(3)
    bits = ['[Event "A"]', '[Site "b c"]', '[Event "z"]', '[Odd "q"]', '[White "x\\"y"]', "[Black x]", "[ECO]", '[FEN "a\\\\"]', "\n", "\n\n", "\n \n", "1. e4 e5", "{ [%clk 0:1] }", "[", '"', "]", " ", 'Foo "x"]', "1-0", "é", '[[Round "1"]']
    texts = ["".join(rng.choice(bits) + rng.choice(["\n", "\n", "", "\n\n"]) for _ in range(rng.randint(0, 9))).strip(" \t\r\n") for _ in range(20000)]
    kept, columns = pgn.usual_games(pa.array(texts))
    assert 500 < len(kept) < 4000
    at, told = pgn.odd_games(pa.array([texts[i].encode() for i in kept], pa.binary()))
    assert at.tolist() == list(range(len(kept)))  # one game each
    for got, want in zip(columns[:-1], told[:-1], strict=True):
        assert got.to_pylist() == want.to_pylist()
    assert [x and dict(x) for x in columns[-1].to_pylist()] == [x and dict(x) for x in told[-1].to_pylist()]


def test_one_record_of_bad_bytes_leaves_the_others(spark):
    rows = spark.createDataFrame([(1, b'[Event "a\xff"]\n\n1. e4'), (2, b'[Event "b"]\n\n1. d4 *'), (3, None), (4, b" \n"), (5, b'[Event "c"]\n\n*\n\n[Event "d"]\n\n1-0')], "id int, value binary")
    got = sorted((r.id, r.Event, r.movetext) for r in pgn.parse_games(rows).collect())
    assert got == [(1, "a�", "1. e4"), (2, "b", "1. d4 *"), (5, "c", "*"), (5, "d", "1-0")]
    assert pgn.parse_games(rows.limit(0)).count() == 0
