"""Audits: the measures of each table's month as one aggregate, and its check rows as one unpivot of that."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.aggregates import ALL

CHECK_FIELDS = ["check_name", "passed", "observed", "expected", "detail", "blocking"]


@dataclass(frozen=True)
class Check:
    """A rule over measures: what is observed and expected, when it passes, and whether a failure blocks publishing."""

    name: str
    observed: Column
    expected: Column
    passed: Column
    detail: str = ""
    blocking: bool = True


def none_of(name: str, measure: str, detail: str = "", blocking: bool = True) -> Check:
    return Check(name, F.col(measure), F.lit(0), F.col(measure) == 0, detail, blocking)


def equal(name: str, measure: str, expected: Column, detail: str = "") -> Check:
    return Check(name, F.col(measure), expected, F.coalesce(F.col(measure) == expected, F.lit(False)), detail)


def not_empty(blocking: bool = True) -> Check:
    return Check("not_empty", F.col("rows"), F.lit(None), F.col("rows") > 0, "", blocking)


def filled(measures: dict[str, Column]) -> list[Column]:
    return [F.coalesce(m, F.lit(0)).alias(k) for k, m in measures.items()]


def audit(rows: DataFrame, measures: dict[str, Column], checks: list[Check], by: list[str] | None = None) -> DataFrame:
    """Check rows (of each group, with ``by``) from one pass over rows."""
    return judged(rows.groupBy(*(by or [])).agg(*filled(measures)), checks, by)


def judged(stats: DataFrame, checks: list[Check], by: list[str] | None = None) -> DataFrame:
    """Check rows from the measures' values, a row of them (for each group)."""
    made = [F.struct(F.lit(c.name).alias("check_name"), c.passed.alias("passed"), c.observed.cast("bigint").alias("observed"), c.expected.cast("bigint").alias("expected"), F.lit(c.detail).alias("detail"), F.lit(c.blocking).alias("blocking")) for c in checks]
    return stats.select(*(by or []), F.explode(F.array(*made)).alias("c")).select(*(by or []), *[f"c.{f}" for f in CHECK_FIELDS])


def gate(checks: DataFrame) -> bool:
    """Whether all blocking checks passed; a missing flag blocks."""
    return checks.where(F.coalesce("blocking", F.lit(True)) & ~F.coalesce("passed", F.lit(False))).isEmpty()


def count_if(c: Column) -> Column:
    return F.count_if(c)


def wrong_month(month: Column) -> Column:
    return F.count_if(F.col("month") != month)


def raw_audit(month: Column, expected: Column) -> tuple[dict, list[Check]]:
    measures = {"rows": F.count("*"), "missing_site": count_if(F.coalesce(F.col("Site") == "", F.lit(True))), "bad_result": count_if(F.col("Result").isNull() | ~F.col("Result").isin(*C.RAW_RESULTS)), "wrong_month": wrong_month(month)}
    return measures, [equal("row_count_matches_manifest", "rows", expected), none_of("site_present", "missing_site"), none_of("result_valid", "bad_result"), none_of("month_column_consistent", "wrong_month"), not_empty()]


def curated_audit(month: Column, raw_rows: Column) -> tuple[dict, list[Check]]:
    out = lambda c: F.col(c).isNotNull() & ~F.col(c).between(C.LEAST_RATING, C.MOST_RATING)
    measures = {
        "rows": F.count("*"),
        "missing_game_id": count_if(F.col("game_id").isNull()),
        "bad_time_control": count_if(F.col("speed").isNull()),
        "missing_played_at": count_if(F.col("played_at").isNull()),
        "wrong_month": wrong_month(month),
        "duplicates": count_if(F.col("is_duplicate")),
        "rating_out_of_range": count_if(out("white_elo") | out("black_elo")),
        "undecided": count_if(F.col("result").isNull()),
        "unknown_termination": count_if(F.col("termination").isNull() | ~F.col("termination").isin(*C.TERMINATIONS)),
        "outside_month": count_if(F.col("played_at").isNotNull() & (F.date_format("played_at", "yyyy-MM") != month)),
    }
    return measures, [
        equal("row_count_matches_raw", "rows", raw_rows),
        none_of("game_id_present", "missing_game_id"),
        none_of("time_control_parseable", "bad_time_control"),
        none_of("played_at_present", "missing_played_at"),
        none_of("month_column_consistent", "wrong_month"),
        not_empty(),
        none_of("game_id_unique", "duplicates", "copies are flagged", False),
        none_of("rating_in_range", "rating_out_of_range", "", False),
        none_of("result_decided", "undecided", "unfinished games", False),
        none_of("termination_known", "unknown_termination", "", False),
        none_of("played_at_in_month", "outside_month", "", False),
    ]


def player_games_audit(month: Column, games: Column) -> tuple[dict, list[Check]]:
    measures = {
        "rows": F.count("*"),
        "white_rows": count_if(F.col("color") == "white"),
        "black_rows": count_if(F.col("color") == "black"),
        "missing_player": count_if(F.coalesce(F.col("player_id") == "", F.lit(True))),
        "wrong_month": wrong_month(month),
        "undecided": count_if(F.col("outcome").isNull()),
    }
    return measures, [
        equal("two_rows_per_game", "rows", games * 2),
        equal("one_white_row_per_game", "white_rows", games),
        equal("one_black_row_per_game", "black_rows", games),
        none_of("player_present", "missing_player"),
        none_of("month_column_consistent", "wrong_month"),
        not_empty(),
        none_of("outcome_decided", "undecided", "unfinished games", False),
    ]


def summary_audit(unique_games: Column) -> tuple[dict, list[Check]]:
    measures = {"rows": F.count("*"), "total_games": F.sum(F.when(F.col("speed") == ALL, F.col("games"))), "speed_games": F.sum(F.when(~F.col("speed").eqNullSafe(F.lit(ALL)), F.col("games")))}
    return measures, [equal("total_matches_curated", "total_games", unique_games), equal("speeds_add_up", "speed_games", unique_games), not_empty()]


def openings_audit(unique_games: Column) -> tuple[dict, list[Check]]:
    return {"rows": F.count("*"), "games": F.sum("games")}, [equal("games_add_up", "games", unique_games), not_empty()]


def ratings_audit(unique_games: Column) -> tuple[dict, list[Check]]:
    return {"rows": F.count("*"), "player_games": F.sum("player_games")}, [equal("player_games_add_up", "player_games", unique_games * 2), not_empty()]


def explorer_audit(unique_games: Column, joined_games: Column, kept_pairs: Column, unparsed_pairs: Column, start: str) -> tuple[dict, list[Check]]:
    measures = {
        "rows": F.count("*"),
        "start_games": F.sum(F.when(F.col("position") == start, F.col("games"))),
        "results_over_games": count_if(F.col("white_wins") + F.col("draws") + F.col("black_wins") > F.col("games")),
    }
    return measures, [
        not_empty(),
        Check("games_joined_once", joined_games, unique_games, joined_games == unique_games),
        Check("start_not_overcounted", F.col("start_games"), unique_games, F.col("start_games") <= unique_games),
        none_of("results_within_games", "results_over_games"),
        Check("moves_replay", unparsed_pairs, F.floor(kept_pairs / 100), unparsed_pairs * 100 <= kept_pairs),
        Check("start_coverage", F.col("start_games"), unique_games, F.col("start_games") * 100 >= unique_games * 98, "rare first moves drop out", False),
    ]


def cost_audit(month: Column) -> tuple[dict, list[Check]]:
    measures = {"rows": F.count("*"), "out_of_month": count_if(F.date_format("usage_date", "yyyy-MM") != month), "currencies": F.count_distinct("currency"), "negative": count_if(F.col("cost") < 0)}
    return measures, [
        none_of("usage_date_in_month", "out_of_month"),
        Check("single_currency", F.col("currencies"), F.lit(1), F.col("currencies") <= 1),
        not_empty(False),
        none_of("no_negative_costs", "negative", "credits and refunds", False),
    ]


def pass_counts(history: DataFrame) -> DataFrame:
    """Passes and failures by check."""
    return history.groupBy("check_name").agg(F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))
