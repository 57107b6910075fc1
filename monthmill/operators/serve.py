"""Queries over the monthly aggregates: ranges, top-N, shares, trends, lookups. Arguments are checked before a plan is made."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .aggregates import ALL

MONTH = re.compile(r"^\d{4}-(0[1-9]|1[0-2])$")
#: Registers of the distinct count of a month's players, as a power of two.
LG_REGISTERS = 14
RESULT_SUMS = ["games", "white_wins", "draws", "black_wins", "unfinished"]


# -- arguments -------------------------------------------------------------------------------------------------------


def check_month(month: str) -> str:
    if not MONTH.match(month or ""):
        raise ValueError(f"not a month (YYYY-MM): {month!r}")
    return month


def check_range(from_month: str, to_month: str) -> None:
    check_month(from_month)
    check_month(to_month)
    if from_month > to_month:
        raise ValueError(f"{from_month} is after {to_month}")


def check_limit(limit: int, most: int = 100) -> int:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be 1 to {most}")
    return limit


def check_choice(value, allowed, what: str):
    if value not in allowed:
        raise ValueError(f"unknown {what}: {value!r}")
    return value


def check_fen(fen: str) -> str:
    if not re.match(r"^([pnbrqkPNBRQK1-8]+/){7}[pnbrqkPNBRQK1-8]+ [wb] (-|[KQkq]{1,4})( .*)?$", fen or ""):
        raise ValueError("not a FEN")
    return fen


def in_range(df: DataFrame, from_month: str, to_month: str) -> DataFrame:
    check_range(from_month, to_month)
    return df.where(F.col("month").between(from_month, to_month))


def month_selector(spec: str) -> Column:
    """Predicate on ``month`` of 'YYYY', 'YYYY-MM', 'a:b' ranges, and comma-joined mixes; a year as the upper bound means
    its December, as the lower its January."""

    def bound(text: str, last: bool) -> str:
        if re.fullmatch(r"\d{4}", text):
            return f"{text}-{'12' if last else '01'}"
        return check_month(text)

    parts = [p.strip() for p in spec.split(",") if p.strip()]
    if not parts:
        raise ValueError("no months asked for")
    out = F.lit(False)
    for part in parts:
        low, _, high = part.partition(":")
        low, high = bound(low, False), bound(high or low, True)
        if low > high:
            raise ValueError(f"{low} is after {high}")
        out = out | F.col("month").between(low, high)
    return out


def select_months(entries: DataFrame, spec: str) -> DataFrame:
    """The distinct months of entries that a selector names, in order; none is an error."""
    found = entries.where(month_selector(spec)).select("month").distinct().orderBy("month")
    if found.isEmpty():
        raise ValueError(f"no month matches {spec!r}")
    return found


def resolve_range(months: DataFrame, from_month: str | None, to_month: str | None, span: int = 12) -> DataFrame:
    """One row (from_month, to_month): unknown ends become the last ``span`` months with data; reversed ends are swapped."""
    known = months.select("month").distinct()
    ordered = known.withColumn("n", F.row_number().over(Window.orderBy(F.desc("month"))))  # a row a month
    last = ordered.agg(F.max("month").alias("last"), F.min(F.when(F.col("n") <= span, F.col("month"))).alias("first"), F.max(F.col("month") == F.lit(from_month)).alias("has_from"), F.max(F.col("month") == F.lit(to_month)).alias("has_to"))
    low = F.when(F.coalesce("has_from", F.lit(False)), F.lit(from_month)).otherwise(F.col("first"))
    high = F.when(F.coalesce("has_to", F.lit(False)), F.lit(to_month)).otherwise(F.col("last"))
    return last.select(F.least(low, high).alias("from_month"), F.greatest(low, high).alias("to_month"))


# -- ranges and top-N ------------------------------------------------------------------------------------------------


def months(summary: DataFrame) -> DataFrame:
    return summary.select("month").distinct().orderBy("month")


def summary_range(summary: DataFrame, from_month: str, to_month: str, speeds: list[str] | None = None) -> DataFrame:
    """Summary rows of a range, of some speeds or of all; null speeds last in a month."""
    rows = in_range(summary, from_month, to_month)
    if speeds:
        rows = rows.where(F.col("speed").isin(*speeds))
    return rows.orderBy("month", F.asc_nulls_last("speed"))


def ratings_of(distribution: DataFrame, month: str, speeds: list[str] | None = None) -> DataFrame:
    rows = distribution.where(F.col("month") == check_month(month))
    if speeds:
        rows = rows.where(F.col("speed").isin(*speeds))
    return rows.orderBy(F.asc_nulls_last("speed"), F.asc_nulls_first("rating_bucket"))


def opening_totals(openings: DataFrame, from_month: str, to_month: str, speed: str | None = None, rating_band: int | None = None) -> DataFrame:
    rows = in_range(openings, from_month, to_month)
    if speed is not None:
        rows = rows.where(F.col("speed") == speed)
    if rating_band is not None:
        rows = rows.where(F.col("rating_band") == rating_band)
    return rows.groupBy("eco", "opening").agg(*[F.sum(c).alias(c) for c in RESULT_SUMS])


def top_openings(openings: DataFrame, from_month: str, to_month: str, speed: str | None = None, rating_band: int | None = None, limit: int = 20) -> DataFrame:
    """The most played openings of a selection, each with the selection's total."""
    totals = opening_totals(openings, from_month, to_month, speed, rating_band)
    with_total = totals.withColumn("total_games", F.sum("games").over(Window.partitionBy()))  # openings, not games
    return with_total.orderBy(F.desc("games"), F.asc_nulls_last("eco"), F.asc_nulls_last("opening")).limit(check_limit(limit))


def capped(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, and in ``truncated`` whether there were more: one row more is asked for, in one run."""
    asked = rows.limit(most + 1)
    counted = asked.withColumn("truncated", F.count(F.lit(1)).over(Window.partitionBy()) > most)  # over most + 1 rows at most
    return counted.limit(most)


def opening_highlights(totals: DataFrame) -> DataFrame:
    """The most played opening, White's best and the most drawish one; ties to the more played, then by name."""
    share = lambda c: F.try_divide(F.col(c).cast("double"), F.col("games").cast("double"))
    name = F.struct(F.col("eco"), F.col("opening"))
    best = lambda value: F.min_by(name, F.struct(-value, -F.col("games"), F.coalesce("eco", F.lit("~")), F.coalesce("opening", F.lit("~"))))
    one = totals.agg(best(F.col("games").cast("double")).alias("most_played"), best(share("white_wins")).alias("best_for_white"), best(share("draws")).alias("most_drawish"))
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("highlight"), F.col(k).alias("o")) for k in ("most_played", "best_for_white", "most_drawish")])).alias("h")).select("h.highlight", "h.o.eco", "h.o.opening").where(F.col("eco").isNotNull() | F.col("opening").isNotNull())


def openings_by_share(totals: DataFrame, column: str = "white_wins") -> DataFrame:
    """Openings with their popularity rank, sorted by the share of one result."""
    rank = F.row_number().over(Window.orderBy(F.desc("games"), F.asc_nulls_last("eco"), F.asc_nulls_last("opening")))  # openings, not games
    return totals.withColumn("rank", rank).withColumn("share", F.try_divide(column, "games")).orderBy(F.desc("share"), "rank")


# -- reshaping for charts --------------------------------------------------------------------------------------------


def _of_speeds(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("speed").isin(*C.SPEED_ORDER))


def speed_shares(summary: DataFrame) -> DataFrame:
    """Each known speed's share of a month's games; 0 where the month has none."""
    total = F.sum("games").over(Window.partitionBy("month"))
    return _of_speeds(summary).select("month", "speed", "games", F.when(total > 0, F.col("games") / total).otherwise(0.0).alias("share"))


def month_kpis(summary: DataFrame) -> DataFrame:
    """Headline numbers of each month, and the change in games against the month before that has data."""
    w = Window.orderBy("month")  # a row a month
    rows = summary.where(F.col("speed") == ALL)
    previous = F.lag("games").over(w)
    return rows.select(
        "month",
        "games",
        "players",
        "avg_rating",
        F.when(F.col("games") > 0, F.col("bot_games") / F.col("games")).otherwise(0.0).alias("bot_share"),
        F.when(previous > 0, F.col("games") / previous - 1).alias("games_change"),
        F.lag("month").over(w).alias("previous_month"),
    )


def month_gaps(months_df: DataFrame) -> DataFrame:
    """Pairs of months with data between which the calendar has others."""
    follow = months_df.select("month").distinct().withColumn("next_month", F.lead("month").over(Window.orderBy("month")))  # a row a month
    calendar = F.date_format(F.add_months(F.to_date(F.concat("month", F.lit("-01"))), 1), "yyyy-MM")
    return follow.where(F.col("next_month") != calendar).select("month", "next_month")


def median_bucket(distribution: DataFrame) -> DataFrame:
    """By month and speed, the first rating bucket up to which half of the rated player-games lie."""
    keys = ["month", "speed"]
    rated = distribution.where(F.col("rating_bucket").isNotNull())
    so_far = F.sum("player_games").over(Window.partitionBy(*keys).orderBy("rating_bucket").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("player_games").over(Window.partitionBy(*keys))
    return rated.withColumns({"so_far": so_far, "total": total}).where((F.col("total") > 0) & (F.col("so_far") * 2 >= F.col("total"))).groupBy(*keys).agg(F.min("rating_bucket").alias("median_bucket"))


def results_by_speed(summary: DataFrame, from_month: str, to_month: str) -> DataFrame:
    """Results over a range: all speeds first, then each known one that has games."""
    rows = in_range(summary, from_month, to_month).where(F.col("speed").isin(ALL, *C.SPEED_ORDER))
    sums = rows.groupBy("speed").agg(*[F.sum(c).alias(c) for c in RESULT_SUMS]).where(F.col("games") > 0)
    return sums.orderBy(C.speed_rank(F.col("speed")))


def white_win_percentage(summary: DataFrame) -> DataFrame:
    """White's wins in percent of each month's games, one decimal."""
    return summary.where(F.col("speed") == ALL).select("month", F.round(100.0 * F.col("white_wins") / F.col("games"), 1).alias("white_win_pct")).orderBy("month")


# -- costs -----------------------------------------------------------------------------------------------------------


def one_currency() -> Column:
    found = F.collect_set("currency")
    return F.when(F.size(found) == 1, F.element_at(found, 1))


def daily_cost(costs: DataFrame, from_month: str) -> DataFrame:
    """Cost by day and service from a month on; null costs are 0."""
    rows = costs.where(F.col("month") >= check_month(from_month))
    return rows.groupBy("usage_date", "service_name").agg(F.round(F.coalesce(F.sum(F.col("cost").cast("decimal(18,4)")), F.lit(0)), 4).alias("cost"), F.max("currency").alias("currency")).orderBy("usage_date", "service_name")


def cost_months(costs: DataFrame) -> DataFrame:
    """Cost by month, with its currency where there is just one."""
    return costs.groupBy("month").agg(F.round(F.sum(F.col("cost").cast("decimal(18,4)")), 2).alias("cost"), one_currency().alias("currency"))


def month_bounds(month: Column) -> tuple[Column, Column]:
    """First and last day of a month."""
    first = F.to_date(F.concat(month, F.lit("-01")))
    return first, F.last_day(first)


def recent_months(day: Column) -> Column:
    """The month before a day's and the day's own: costs settle late, so both are built anew."""
    return F.array(F.date_format(F.add_months(F.trunc(day, "month"), -1), "yyyy-MM"), F.date_format(day, "yyyy-MM"))


# -- players and games -----------------------------------------------------------------------------------------------


def _counted(players: DataFrame) -> DataFrame:
    return players.where(~F.col("is_duplicate"))


def player_record(players: DataFrame, player: str) -> DataFrame:
    """A player's games and points by month."""
    own = _counted(players).where(F.col("player_id") == player.lower())
    return own.groupBy("month").agg(F.count("*").alias("games"), F.sum("score").alias("points")).orderBy("month")


def head_to_head(players: DataFrame, player: str, opponent: str) -> DataFrame:
    """Games and results of one player against another."""
    rows = _counted(players).where((F.col("player_id") == player.lower()) & (F.col("opponent_id") == opponent.lower()))
    o = F.col("outcome")
    return rows.groupBy("player_id", "opponent_id").agg(F.count("*").alias("games"), F.count_if(o == "win").alias("wins"), F.count_if(o == "draw").alias("draws"), F.count_if(o == "loss").alias("losses"), F.sum("score").alias("points"))


def bot_leaderboard(players: DataFrame, limit: int = 20) -> DataFrame:
    rows = _counted(players).where("is_bot").groupBy("player_id").agg(F.count("*").alias("games"), F.sum("score").alias("points"))
    return rows.orderBy(F.desc("games"), "player_id").limit(check_limit(limit))


def score_by_rating(games: DataFrame, least: int = 1000) -> DataFrame:
    """White's mean score by 100-point bucket of White's rating, buckets of at least ``least`` games."""
    score = C.either({"white": 1.0, "draw": 0.5, "black": 0.0}, F.col("result"))
    rated = games.where(~F.col("is_duplicate") & F.col("event").startswith("Rated") & F.col("white_elo").isNotNull())
    rows = rated.select(C.band(F.col("white_elo"), 100).alias("rating_bucket"), score.alias("score"))
    return rows.groupBy("rating_bucket").agg(F.count("*").alias("games"), F.avg("score").alias("white_score")).where(F.col("games") >= least).orderBy("rating_bucket")


def get_game(games: DataFrame, game_id: str) -> DataFrame:
    """One game by its id, without copies; sorted files let the scan skip all row groups but one."""
    if not re.fullmatch(r"[A-Za-z0-9]{8}", game_id or ""):
        raise ValueError("a game id has 8 letters or digits")
    return games.where((F.col("game_id") == game_id) & ~F.col("is_duplicate")).limit(1)


def approx_players(players: DataFrame) -> DataFrame:
    """About how many players a month has, and its player-games: what skew to expect. The sketch's standard error is 0.8 %, so that
    among many months none is off by a tenth, as some were at the 5 % that Spark's approx_count_distinct has unless told."""
    estimate = F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg("player_id", LG_REGISTERS)), F.lit(0))
    return players.groupBy("month").agg(estimate.alias("players"), F.count("*").alias("player_games"))


def heaviest_players(players: DataFrame, k: int = 10) -> DataFrame:
    """About the most frequent players, by a bounded sketch."""
    return players.agg(F.expr(f"approx_top_k(player_id, {int(k)})").alias("top")).select(F.explode("top").alias("t")).select(F.col("t.item").alias("player_id"), F.col("t.count").alias("player_games"))
