"""Sketches a month and speed of what does not add up: distinct players, rating quantiles, the heaviest players.

A month's sketches are built once, kept as binary columns of a few KB whatever the month's size, and merged over any range of
months and any speeds, without going back to the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregates import once
from .serve import in_range

#: Registers of the distinct count (2**15: about 0.6 % error), size of the quantile sketch (about 0.4 % of the ranks), items tracked.
LG_REGISTERS, QUANTILE_SIZE, TRACKED = 15, 800, 10_000


def month_sketches(players: DataFrame) -> DataFrame:
    """By month and speed: player_games, players_hll, ratings_kll and heaviest, over player-games that count."""
    return once(players).groupBy("month", "speed").agg(
        F.count("*").alias("player_games"),
        F.hll_sketch_agg("player_id", LG_REGISTERS).alias("players_hll"),
        F.kll_sketch_agg_bigint(F.col("rating").cast("bigint"), QUANTILE_SIZE).alias("ratings_kll"),
        F.expr(f"approx_top_k_accumulate(player_id, {TRACKED})").alias("heaviest"),
    )


def month_tallies(players: DataFrame) -> DataFrame:
    """By month, speed and player: player_games, over player-games that count. Where a sketch's error will not do, these are
    what months keep: a row a player, so they grow with the players, but they merge exactly over any range and any speeds."""
    return once(players).groupBy("month", "speed", "player_id").agg(F.count("*").alias("player_games"))


def exact_players_over(tallies: DataFrame, from_month: str, to_month: str, speeds: list[str] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """player_games, and how many players they have, over a range; null is no player."""
    own = _chosen(tallies, from_month, to_month, speeds).groupBy(*by, "player_id").agg(F.sum("player_games").alias("player_games"))
    return own.groupBy(*by).agg(F.sum("player_games").alias("player_games"), F.count("player_id").alias("players"))


def exact_heaviest_over(tallies: DataFrame, from_month: str, to_month: str, k: int = 10, speeds: list[str] | None = None) -> DataFrame:
    """The ``k`` players of most player-games over a range, ties to the lesser id."""
    own = _chosen(tallies, from_month, to_month, speeds).groupBy("player_id").agg(F.sum("player_games").alias("player_games"))
    return own.orderBy(F.desc("player_games"), F.asc_nulls_last("player_id")).limit(int(k))


def _chosen(sketches: DataFrame, from_month: str, to_month: str, speeds: list[str] | None) -> DataFrame:
    rows = in_range(sketches, from_month, to_month)
    return rows.where(F.col("speed").isin(*speeds)) if speeds else rows


def players_over(sketches: DataFrame, from_month: str, to_month: str, speeds: list[str] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """player_games, and about how many players they have, over a range."""
    return _chosen(sketches, from_month, to_month, speeds).groupBy(*by).agg(F.sum("player_games").alias("player_games"), F.hll_sketch_estimate(F.hll_union_agg("players_hll")).alias("players"))


def rating_quantile_over(sketches: DataFrame, from_month: str, to_month: str, quantile: float = 0.5, speeds: list[str] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """How many ratings there are, and about which one this share of them does not pass, over a range."""
    merged = _chosen(sketches, from_month, to_month, speeds).groupBy(*by).agg(F.kll_merge_agg_bigint("ratings_kll").alias("s"))
    n = F.kll_sketch_get_n_bigint("s")
    return merged.select(*by, n.alias("rated"), F.when(n > 0, F.kll_sketch_get_quantile_bigint("s", F.lit(quantile))).alias("rating"))


def heaviest_over(sketches: DataFrame, from_month: str, to_month: str, k: int = 10, speeds: list[str] | None = None) -> DataFrame:
    """About the ``k`` players of most player-games over a range, those that surely are among them."""
    # one group, so that a task without rows makes no buffer, which Spark 4.1 cannot serialise for this sketch
    top = _chosen(sketches, from_month, to_month, speeds).groupBy(F.lit("all").alias("range")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(heaviest, {TRACKED}), {int(k)})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("player_id"), F.col("t.count").alias("player_games"))
