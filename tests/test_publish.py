import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_typing import RAW, raw_row

from monthmill.operators import serve
from monthmill.plans import checks, layers, publish, upkeep


def put_raw(store, month, rows):
    run = publish.new_run_id()
    df = store.spark.createDataFrame(rows, RAW)
    measures, rules = checks.raw_audit(F.lit(month), F.lit(len(rows)))
    assert store.publish(layers.RAW, month, df.withColumn("_run_id", F.lit(run)), measures, rules, run)


@pytest.fixture
def store(spark, tmp_path):
    return publish.Store(spark, str(tmp_path / "store"))


def test_layers_end_to_end(store):
    good = [raw_row(i, movetext="1. e4 e5 2. Nf3 1-0") for i in range(40)]
    good[0] = raw_row(0, Result="*")
    good[1] = raw_row(1, WhiteElo="4100", WhiteTitle="BOT")
    good[2] = raw_row(2, Termination="Something else")
    put_raw(store, "2013-01", good)
    bad = [raw_row(i, month="2013-02", UTCDate="2013.02.01") for i in range(10)]
    bad[0] = raw_row(0, month="2013-02", TimeControl="abc")
    put_raw(store, "2013-02", bad)
    built = layers.build_pending(store)
    assert built[layers.CURATED] == {"2013-01": True, "2013-02": False}
    assert built[layers.PLAYERS] == {"2013-01": True}
    assert store.pending(layers.RAW, layers.CURATED) == ["2013-02"]
    with pytest.raises(LookupError):
        store.read_month(layers.CURATED, "2013-02")
    total = store.read(layers.SUMMARY).where("speed = 'all'").first()
    assert (total.games, total.players, total.unfinished, total.bot_games) == (40, 41, 1, 1)
    failed = {r.check_name: r.observed for r in store.history().where("not passed").collect()}
    assert failed["time_control_parseable"] == 1 and failed["rating_in_range"] == 1 and failed["termination_known"] == 1 and failed["result_decided"] == 1
    assert store.read(layers.EXPLORER).where("position = 'w  '").agg(F.sum("games")).first()[0] == 40
    # nothing is pending; a republished source makes what lies above it pending again
    again = layers.build_pending(store)
    assert again[layers.PLAYERS] == {} and again[layers.SUMMARY] == {}
    put_raw(store, "2013-01", good[:20])
    assert store.pending(layers.RAW, layers.CURATED) == ["2013-01", "2013-02"]
    assert layers.build_curated(store, "2013-01") and store.pending(layers.CURATED, layers.PLAYERS) == ["2013-01"]
    assert store.read(layers.CURATED).count() == 20
    assert {r.check_name for r in checks.pass_counts(store.history()).collect()} >= {"not_empty", "two_rows_per_game"}


def test_costs_allow_an_empty_month(store):
    rows = store.spark.createDataFrame([], "month string, usage_date date, resource_group string, service_name string, resource_type string, cost double, currency string")
    assert layers.build_costs(store, rows, "2026-10")
    assert store.read(layers.COSTS).count() == 0


def test_gate_and_defaults(spark):
    rows = spark.createDataFrame([(1,)], "x int")
    old = publish.with_defaults(rows, {"_source_run_id": "legacy", "x": 5}, ["gone"])
    assert [tuple(r) for r in old.collect()] == [(1, "legacy")]
    made = spark.createDataFrame([("a", True, True), ("b", False, False)], "check_name string, passed boolean, blocking boolean")
    assert checks.gate(made)
    assert not checks.gate(made.unionByName(spark.createDataFrame([("c", False, None)], made.schema)))


def test_upkeep(store):
    spark = store.spark
    run = publish.new_run_id()
    df = spark.range(100).select("id", F.lit("2013-01").alias("month"), F.lit(run).alias("_run_id")).repartition(8)
    assert store.publish("t", "2013-01", df, {"rows": F.count("*")}, [checks.not_empty()], run)
    old = store.read_month("t", "2013-01")[0]
    assert upkeep.compact_month(store, "t", "2013-01", upkeep.Settings(min_files=5))
    assert old.count() == 100  # whoever reads the old folder goes on
    assert store.pin("t", "2013-01") == run
    assert not upkeep.compact_month(store, "t", "2013-01", upkeep.Settings(min_files=5))
    assert store.read("t").count() == 100 and {r._run_id for r in store.read("t").select("_run_id").distinct().collect()} == {run}
    stray = f"{store.root}/t/month=2013-01/run=nobody"
    spark.range(1).write.parquet(stray)
    later = dt.datetime.now() + dt.timedelta(days=10)
    found = upkeep.remove_orphans(store, "t", later, dry_run=False)
    assert found and all("run=nobody" in p for p in found)
    for _ in range(4):
        new = publish.new_run_id()
        assert store.publish("t", "2013-01", df.limit(10), {"rows": F.count("*")}, [checks.not_empty()], new)
    assert upkeep.expire_runs(store, later, upkeep.Settings(keep_days=1, keep_last=3)) == 3
    assert store.read("t").count() == 10
    path = f"{store.root}/inventory.json"
    upkeep.write_inventory(store, path)
    drill = upkeep.restore_drill(store, upkeep.read_inventory(spark, path)).collect()
    assert [(r.table_name, r.from_files, r.live, r.matches) for r in drill] == [("t", 10, 10, True)]
    report = upkeep.maintain(store, ["t", "missing"], later)
    assert "after" in report["t"] and "error" in report["missing"]
    assert upkeep.file_stats(upkeep.files_under(spark, f"{store.root}/t")).first().month == "2013-01"


def test_compaction_keeps_buckets(store):
    run = publish.new_run_id()
    df = store.spark.range(200).select("id", F.lit("2013-01").alias("month"))
    assert store.publish("b", "2013-01", df, {"rows": F.count("*")}, [checks.not_empty()], run, bucket="id", buckets=4)
    assert not upkeep.compact_month(store, "b", "2013-01", upkeep.Settings(min_files=2))  # a file a bucket already
    ref = store.versions("b").first()
    folder = f"{ref.folder}.many"
    store.read_month("b", "2013-01")[0].repartition(5).write.partitionBy("bucket").parquet(store.run_path("b", "2013-01", run, folder))
    store.point("b", "2013-01", run, None, folder)
    assert upkeep.compact_month(store, "b", "2013-01", upkeep.Settings(min_files=2, strategy="sort"), ["id"])
    path = store.run_path("b", "2013-01", run, store.versions("b").first().folder)
    files = [r.path for r in upkeep.files_under(store.spark, path).collect()]
    assert len(files) == 4 and all("/bucket=" in f for f in files)
    rows = store.read("b")
    assert rows.count() == 200 and rows.where(F.col("bucket") != F.pmod(F.xxhash64("id"), F.lit(4))).isEmpty()


def test_settings_and_versions(spark):
    assert upkeep.settings({"upkeep.min_files": "9"}).min_files == 9
    with pytest.raises(ValueError):
        upkeep.settings({"upkeep.strategy": "magic"})
    assert upkeep.version_number("00012-abc.json") == 12 and upkeep.version_number("abc") is None
    names = spark.createDataFrame([("t", "00009-a.json"), ("t", "00010-b.json"), ("t", "9-c.json")], "table_name string, name string")
    assert upkeep.newest_version(names).first().name == "00010-b.json"


def test_arguments():
    for bad in ("2013", "2013-13", None, "x"):
        with pytest.raises(ValueError):
            serve.check_month(bad)
    with pytest.raises(ValueError):
        serve.check_range("2013-02", "2013-01")
    with pytest.raises(ValueError):
        serve.check_limit(101)
    with pytest.raises(ValueError):
        serve.check_fen("nonsense")
    assert serve.check_fen("rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1")


def test_selectors(spark):
    m = spark.createDataFrame([("2015-12",), ("2016-01",), ("2026-08",)], "month string")
    assert [r.month for r in serve.select_months(m, "2015:2016").collect()] == ["2015-12", "2016-01"]
    with pytest.raises(ValueError):
        serve.select_months(m, "1999")
    assert [tuple(r) for r in serve.month_gaps(m).collect()] == [("2016-01", "2026-08")]
    assert tuple(serve.resolve_range(m, "2026-08", "2015-12").first()) == ("2015-12", "2026-08")
    assert [r.truncated for r in serve.capped(m, 2).collect()] == [True, True] and [r.truncated for r in serve.capped(m, 3).collect()] == [False] * 3
    assert [tuple(map(str, r)) for r in m.select(*serve.month_bounds(F.lit("2024-02"))).limit(1).collect()] == [("2024-02-01", "2024-02-29")]
