"""The three monthly aggregates over games that count once each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

ALL = "all"


def once(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("is_duplicate"))


def results() -> list:
    """Counts of games by result; undecided games have none."""
    r = F.col("result")
    return [F.count("*").alias("games"), F.count_if(r == "white").alias("white_wins"), F.count_if(r == "draw").alias("draws"), F.count_if(r == "black").alias("black_wins"), F.count_if(r.isNull()).alias("unfinished")]


def _month_and_all(df: DataFrame, *measures) -> DataFrame:
    """measures by month and speed, and by month with speed 'all'; a null speed stays a group of its own."""
    sets = df.groupingSets([["month", "speed"], ["month"]], "month", "speed")
    out = sets.agg(F.grouping("speed").alias("is_all"), *measures)
    return out.withColumn("speed", F.when(F.col("is_all") == 1, ALL).otherwise(F.col("speed"))).drop("is_all")


def monthly_summary(games: DataFrame, players: DataFrame) -> DataFrame:
    """Games, results, bot games and mean rating, and distinct players, by month and speed and over all speeds.

    Each input is read and expanded once; the two small results meet on month and speed, null speeds included.
    """
    bots = F.count_if(F.col("white_is_bot") | F.col("black_is_bot")).alias("bot_games")
    rating = F.avg(C.mean_rating(F.col("white_elo"), F.col("black_elo"))).alias("avg_rating")
    left = _month_and_all(once(games).select("month", "speed", "result", "white_is_bot", "black_is_bot", "white_elo", "black_elo"), *results(), bots, rating)
    right = _month_and_all(once(players).select("month", "speed", "player_id"), F.count_distinct("player_id").alias("players"))
    right = right.select(F.col("month").alias("p_month"), F.col("speed").alias("p_speed"), "players")
    joined = left.join(right, left["month"].eqNullSafe(right["p_month"]) & left["speed"].eqNullSafe(right["p_speed"]), "left")
    return joined.select("month", "speed", "games", F.coalesce("players", F.lit(0)).alias("players"), "white_wins", "draws", "black_wins", "unfinished", "bot_games", "avg_rating")


def opening_counts(games: DataFrame) -> DataFrame:
    """Results by month, speed, opening and the 200-point band of the players' mean rating."""
    rated = once(games).withColumn("rating_band", C.band(C.mean_rating(F.col("white_elo"), F.col("black_elo")), 200))
    return rated.groupBy("month", "speed", "eco", "opening", "rating_band").agg(*results())


def rating_distribution(players: DataFrame) -> DataFrame:
    """Player-games and distinct players by month, speed and 50-point bucket."""
    rows = once(players).withColumn("rating_bucket", C.band(F.col("rating"), 50))
    return rows.groupBy("month", "speed", "rating_bucket").agg(F.count("*").alias("player_games"), F.count_distinct("player_id").alias("players"))
