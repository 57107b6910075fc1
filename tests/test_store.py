"""Audits inside the write, months published together, fingerprints, sketches, and the build command."""

import pytest
from pyspark.sql import functions as F
from test_publish import put_raw
from test_typing import raw_row

from monthmill import queries_store
from monthmill.operators import serve, sketches
from monthmill.plans import build, checks, layers, publish, skipping, upkeep


@pytest.fixture
def store(spark, tmp_path):
    return publish.Store(spark, str(tmp_path / "store"))


def test_a_month_is_audited_while_it_is_written(store, monkeypatch):
    rows = store.spark.range(1000).select("id", F.lit("2013-01").alias("month"), (F.col("id") % 7).alias("k"))
    measures = {"rows": F.count("*"), "sevens": F.count_if(F.col("k") == 0), "none": F.sum(F.when(F.col("k") > 9, 1))}
    rules = [checks.not_empty(), checks.none_of("no_sevens", "sevens", blocking=False), checks.none_of("none", "none")]
    expected = sorted(map(tuple, checks.audit(rows, measures, rules).collect()), key=str)

    def no_reading(*_):
        raise AssertionError("the month was read again")

    monkeypatch.setattr(publish, "audit", no_reading)
    for options in ({}, {"bucket": "id", "buckets": 3, "sort": ["id"]}, {"sort": ["k"]}):
        run = publish.new_run_id()
        assert store.publish("t", "2013-01", rows, measures, rules, run, **options)
        found = store.history().where(F.col("run_id") == run).select(*checks.CHECK_FIELDS)
        assert sorted(map(tuple, found.collect()), key=str) == expected
    assert not store.publish("t", "2013-01", rows.limit(0), measures, rules, publish.new_run_id())
    monkeypatch.undo()
    # distinct counts cannot be observed, and are taken from the files
    assert store.publish("t", "2013-01", rows, {"rows": F.count_distinct("k")}, [checks.equal("seven", "rows", F.lit(7))], publish.new_run_id())


def test_months_published_together(store):
    rows = store.spark.range(900).select("id", F.concat(F.lit("2013-0"), (F.col("id") % 3 + 1).cast("string")).alias("month"))
    told = store.spark.createDataFrame([("2013-01", 300), ("2013-02", 299), ("2013-03", 300)], "month string, told bigint")
    run = publish.new_run_id()
    done = store.publish_months("t", rows, {"rows": F.count("*")}, [checks.equal("count", "rows", F.col("told"))], run, "src", told, ["id"])
    assert done == {"2013-01": True, "2013-02": False, "2013-03": True}
    assert store.read("t").count() == 600 and store.pin("t", "2013-01") == run
    with pytest.raises(LookupError):
        store.read_month("t", "2013-02")
    assert {(r.partition, r.passed) for r in store.history().collect()} == {("2013-01", True), ("2013-02", False), ("2013-03", True)}
    assert not [r.path for r in upkeep.files_under(store.spark, f"{store.root}/t").collect() if "_staging" in r.path or "2013-02" in r.path]
    assert store.publish("t", "2013-02", rows.where("month = '2013-02'"), {"rows": F.count("*")}, [checks.not_empty()], publish.new_run_id())
    assert store.read("t").count() == 900


def test_fingerprints_tell_multisets_apart(spark):
    base = [("m", 1, "a", {"k": "v"}), ("m", 1, "a", {"k": "v"}), ("m", 2, None, None)]
    schema = "month string, i int, s string, t map<string,string>"
    of = lambda rows: tuple(upkeep.fingerprints(spark.createDataFrame(rows, schema), "month").first())
    assert of(base) == of(base[::-1])
    spoilt = [base[:2], [*base, base[0]], [base[0], base[2], base[2]], [*base[:2], ("m", 2, "", None)], [*base[:2], ("m", None, "2", None)], [*base[:2], ("m", 2, None, {"k": "v"})]]
    assert len({of(x) for x in [base, *spoilt]}) == 1 + len(spoilt)


def test_build_command(store, capsys):
    put_raw(store, "2013-01", [raw_row(i) for i in range(5)])
    put_raw(store, "2013-02", [raw_row(i, month="2013-02", UTCDate="2013.02.01", TimeControl="abc") for i in range(5)])
    run = lambda *argv: build.main([store.root, *argv], store.spark)
    assert run("curated", "--months", "2013-01") == 0 and capsys.readouterr().out == "2013-01 published\n"
    assert run("curated", "--pending") == 1 and capsys.readouterr().out == "2013-02 rejected\n"
    assert run("players", "--pending") == 0 and store.versions(layers.PLAYERS).count() == 1
    assert run("players", "--pending") == 0
    for wrong in (["curated"], ["curated", "--months", "2013-13"], ["nothing", "--pending"], ["curated", "--pending", "--months", "2013-01"]):
        with pytest.raises(SystemExit) as e:
            run(*wrong)
        assert e.value.code == 2


def test_sketches_over_ranges(spark):
    n = 60_000
    rows = spark.range(n).select(
        F.concat(F.lit("2013-0"), (F.col("id") % 4 + 1).cast("string")).alias("month"), F.when(F.col("id") % 2 == 0, "blitz").alias("speed"), F.lit(False).alias("is_duplicate"),
        F.when(F.col("id") % 5 == 0, "busy").otherwise(F.concat(F.lit("p"), (F.col("id") % 23_456).cast("string"))).alias("player_id"), F.when(F.col("id") % 11 > 0, F.col("id") % 2000 + 800).cast("int").alias("rating"),
    )
    kept = sketches.month_sketches(rows).persist()
    assert kept.count() == 4  # a row a month and speed
    chosen = rows.where("month between '2013-02' and '2013-04'")
    exact = chosen.agg(F.count("*"), F.count_distinct("player_id"), F.expr("percentile_disc(0.5) within group (order by rating)"), F.count("rating")).first()
    told = sketches.players_over(kept, "2013-02", "2013-04").first()
    assert told.player_games == exact[0] and abs(told.players - exact[1]) <= 0.03 * exact[1]
    middle = sketches.rating_quantile_over(kept, "2013-02", "2013-04").first()
    assert middle.rated == exact[3] and abs(middle.rating - exact[2]) <= 25
    assert sketches.players_over(kept, "2013-02", "2013-04", ["blitz"]).first().player_games == chosen.where("speed = 'blitz'").count()
    top = sketches.heaviest_over(kept, "2013-02", "2013-04", 1).first()
    busy = chosen.where("player_id = 'busy'").count()
    assert top.player_id == "busy" and abs(top.player_games - busy) <= 0.02 * busy
    with pytest.raises(ValueError):
        sketches.players_over(kept, "2013-04", "2013-02")


def sides(spark, players, months):
    """Player-games of so many different players in each month; one in a thousand has two."""
    i = F.col("id") % months
    month = F.concat(F.lit("19"), (F.floor(i / 12) + 10).cast("string"), F.lit("-"), F.lpad((i % 12 + 1).cast("string"), 2, "0"))
    own = spark.range(players * months).select(month.alias("month"), F.lit("blitz").alias("speed"), F.lit(False).alias("is_duplicate"), F.concat(F.lit("player"), "id").alias("player_id"))
    return own.unionByName(own.where(F.xxhash64("player_id") % 1000 == 0))


def test_estimates_hold_in_every_month(spark):
    rows = sides(spark, 2000, 100)
    told = serve.approx_players(rows).collect()
    assert len(told) == 100 and all(abs(r.players - 2000) <= 100 for r in told)
    assert serve.approx_players(rows.withColumn("player_id", F.lit(None).cast("string"))).first().players == 0


def test_tallies_are_exact_over_ranges(spark):
    """Ranges with more players than a sketch tells apart or tracks."""
    rows = sides(spark, 20_000, 3)
    tallies = sketches.month_tallies(rows.unionByName(rows.withColumn("is_duplicate", F.lit(True))))
    chosen = rows.where("month between '1910-01' and '1910-02'")
    told = sketches.exact_players_over(tallies, "1910-01", "1910-02", by=("speed",)).first()
    assert (told.speed, told.player_games, told.players) == ("blitz", chosen.count(), 40_000)
    busiest = chosen.groupBy("player_id").count().orderBy(F.desc("count"), "player_id").limit(10)
    assert [tuple(r) for r in sketches.exact_heaviest_over(tallies, "1910-01", "1910-02").collect()] == [tuple(r) for r in busiest.collect()]
    assert sketches.exact_players_over(tallies, "1910-01", "1910-02", ["rapid"]).first().players == 0


def test_lookups_open_the_files_that_may_have_a_value(store):
    rows = store.spark.range(3000).select(F.sha1(F.col("id").cast("string")).alias("key"), "id", F.concat(F.lit("2013-0"), (F.col("id") % 3 + 1).cast("string")).alias("month"))
    measures, rules = {"rows": F.count("*")}, [checks.not_empty()]
    for month in ("2013-01", "2013-02", "2013-03"):
        assert store.publish("t", month, rows.where(F.col("month") == month).repartition(8), measures, rules, publish.new_run_id())
    key = lambda i: rows.where(F.col("id") == i).first().key
    assert skipping.index_months(store, "t", ["key", "id"], "2013-01", "2013-02") == 16
    assert skipping.index_months(store, "t", ["key", "id"], "2013-01", "2013-02") == 16  # again: nothing is indexed twice
    assert store._log("_index", skipping.INDEX).select("path", "column", "bucket").distinct().count() == store._log("_index", skipping.INDEX).count()
    for i in range(0, 60, 7):
        found, opened = skipping.lookup(store, "t", "key", key(i))
        assert [r.id for r in found.collect()] == [i] and opened <= 1
        found, opened = skipping.lookup(store, "t", "id", i)
        assert [r.id for r in found.collect()] == [i] and opened <= 1
    assert skipping.lookup(store, "t", "key", "nowhere", "2013-01", "2013-02")[0].count() == 0
    assert skipping.files_for(store, "t", "key", key(2))[1]  # the third month has no index, and is read whole
    upkeep.compact_month(store, "t", "2013-01", upkeep.Settings(min_files=2))
    assert [r.id for r in skipping.lookup(store, "t", "key", key(0))[0].collect()] == [0]
    with pytest.raises(LookupError):
        skipping.lookup(store, "t", "key", "x", "2014-01")


def test_layers_refreshed_together_are_those_built_month_by_month(store, tmp_path):
    other = publish.Store(store.spark, str(tmp_path / "other"))
    games = {m: [raw_row(i % 4, UTCDate=m.replace("-", ".") + ".01", month=m) for i in range(6)] for m in ("2013-01", "2013-02")}
    for s in (store, other):
        for m, rows in games.items():
            put_raw(s, m, rows)
    assert all(step(store, m) for m in games for step in (layers.build_curated, layers.build_players, layers.build_aggregates))
    done = layers.refresh(other)
    assert done == {t: dict.fromkeys(games, True) for t in (layers.CURATED, layers.PLAYERS, *layers.AGGREGATES)}
    clock = ["_built_at", "_run_id", "_source_run_id"]
    for t in done:
        a, b = store.read(t).drop(*clock), other.read(t).drop(*clock)
        assert "bucket" not in a.columns
        assert sorted(a.columns) == sorted(b.columns)
        assert a.exceptAll(b.select(a.columns)).isEmpty() and a.count() == b.count()
    sources = {r.month: r.source_run_id for r in other.versions(layers.CURATED).collect()}
    assert sources == {m: other.pin(layers.RAW, m) for m in games}
    assert {(r.month, r._source_run_id) for r in other.read(layers.CURATED).select("month", "_source_run_id").distinct().collect()} == set(sources.items())
    assert layers.refresh(other) == {}
    # one month landed again makes that month's layers pending, whoever built them; copies are told within a month
    put_raw(store, "2013-02", games["2013-02"][:5])
    assert {t: list(m) for t, m in layers.refresh(store, buckets=2).items()} == {t: ["2013-02"] for t in done}
    assert store.read(layers.PLAYERS).where("month = '2013-02'").count() == 10 and store.read(layers.CURATED).where("is_duplicate").count() == 3
    with pytest.raises(LookupError):
        other.read_months(layers.RAW, ["2013-01", "2015-01"])


def test_pages_of_costs_are_bounded_whatever_the_keys(spark, sf, tmp_path, monkeypatch):
    one_key = spark.read.parquet(f"{sf}/lineitem.parquet").limit(3000).withColumn("l_orderkey", F.lit(None).cast("bigint"))
    one_key.write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, plain = [], queries_store.cost.parse_cost_pages
    monkeypatch.setattr(queries_store.cost, "parse_cost_pages", lambda pages, *a: seen.append(pages.agg(F.max(F.size("properties.rows"))).first()[0]) or plain(pages, *a))
    assert queries_store.cost_pages(spark, str(tmp_path)).count() == 3000 and seen[0] <= 100
