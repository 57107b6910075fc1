"""Tables whose partitioning and order Spark knows."""

import re

from pyspark.sql import functions as F

from monthmill import queries as Q
from monthmill.operators import sequences
from monthmill.plans import bucketed, publish
from monthmill.plans.checks import Check


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(df, name: str) -> int:
    return len(re.findall(rf"^[\s:+\-*(\d)]*{name}\b", plan_of(df), re.M))


def tables(spark, sf, **kw):
    games = bucketed.bucketed(sequences.counted_games(Q.games(spark, sf)), "counted", sequences.GAME, **kw)
    return games, bucketed.bucketed(sequences.game_texts(Q.raw_games(spark, sf)), "texts", sequences.GAME, **kw)


def test_games_meet_their_moves_without_exchange_or_sort(spark, sf):
    bucketed.trust_order(spark)
    games, texts = tables(spark, sf, buckets=4)
    joined = sequences.rows_of(games.hint("merge"), texts)
    assert nodes(joined, "SortMergeJoin") == 1
    assert nodes(joined, "Exchange") == nodes(joined, "Sort") == 0
    plain = sequences.game_rows(Q.raw_games(spark, sf), Q.games(spark, sf))
    told = lambda df: sorted(map(tuple, df.withColumn("steps", F.array_join("steps", " ")).collect()), key=str)
    assert told(joined) == told(plain)
    # a grouping by the keys moves nothing either
    assert nodes(texts.groupBy(*sequences.GAME).count(), "Exchange") == 0
    assert nodes(plain, "Exchange") > 0


def test_without_trust_buckets_are_sorted_but_not_moved(spark, sf):
    spark.conf.unset(bucketed.ORDERED)
    games, texts = tables(spark, sf, buckets=3)
    joined = sequences.rows_of(games.hint("merge"), texts)
    assert nodes(joined, "Exchange") == 0 and nodes(joined, "Sort") == 2


def test_nothing_stays_in_the_catalogue_and_a_bucket_is_one_sorted_file(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    out = bucketed.bucketed(rows.unionByName(rows), "twice", ["k"], 4, ["v"])
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("mm_")]
    assert out.count() == 2000 and len(out.inputFiles()) == 4
    for path in out.inputFiles():
        held = [(r.k, r.v is not None, r.v or 0) for r in spark.read.parquet(path).coalesce(1).collect()]
        assert held == sorted(held)
    empty = bucketed.bucketed(rows.limit(0), "none", ["k"], 4)
    assert empty.count() == 0 and empty.schema == rows.schema


def test_a_table_stays_where_it_is_named(spark, tmp_path):
    rows = spark.range(50).withColumnRenamed("id", "k")
    bucketed.write_bucketed(rows, "kept_by_name", str(tmp_path / "t"), ["k"], 2)
    try:
        assert spark.table("kept_by_name").count() == 50
        assert len(list((tmp_path / "t").glob("*.parquet"))) == 2
    finally:
        spark.sql("DROP TABLE kept_by_name")
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 2


def test_a_large_month_is_written_by_several_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 10 > 0, "2020-01").otherwise("2020-02").alias("month"), F.sha2(F.col("id").cast("string"), 256).alias("game_id"))
        store = publish.Store(spark, str(tmp_path))
        checks = [Check("not_empty", F.col("n"), F.lit(None), F.col("n") > 0)]
        assert store.publish_months("t", rows, {"n": F.count("*")}, checks, "r1", sort=["game_id"]) == {"2020-01": True, "2020-02": True}
        files = lambda m: list((tmp_path / "t" / f"month={m}" / "run=r1").glob("*.parquet"))
        assert len(files("2020-01")) > 4
        assert store.read("t").exceptAll(rows).isEmpty() and store.read("t").count() == 60_000
        for f in files("2020-01"):
            held = [r.game_id for r in spark.read.parquet(str(f)).coalesce(1).collect()]
            assert held == sorted(held)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
