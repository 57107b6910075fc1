"""Month builders of each layer: landed games, typed games, player sides, aggregates, explorer, costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates, curate, sequences
from ..sources import landing
from . import checks
from .publish import Store, new_run_id

RAW, CURATED, PLAYERS, SUMMARY, OPENINGS, RATINGS, EXPLORER, COSTS = "raw_games", "curated_games", "player_games", "monthly_summary", "openings", "rating_distribution", "position_moves", "costs"
AGGREGATES = [SUMMARY, OPENINGS, RATINGS]


def build_raw(store: Store, landing_root: str, month: str) -> bool:
    rows = landing.read_landing(store.spark, landing_root, month)
    told = landing.manifests(store.spark, landing_root).where(F.col("month") == month).agg(F.max("games")).first()[0]
    run = new_run_id()
    measures, rules = checks.raw_audit(F.lit(month), F.lit(told).cast("bigint"))
    return store.publish(RAW, month, rows.withColumn("_run_id", F.lit(run)), measures, rules, run)


def build_curated(store: Store, month: str) -> bool:
    raw, source = store.read_month(RAW, month)
    run = new_run_id()
    measures, rules = checks.curated_audit(F.lit(month), F.lit(raw.count()))
    return store.publish(CURATED, month, curate.curate_games(raw, source, run), measures, rules, run, source, sort=["game_id"])


def build_players(store: Store, month: str) -> bool:
    games, source = store.read_month(CURATED, month)
    run = new_run_id()
    measures, rules = checks.player_games_audit(F.lit(month), F.lit(games.count()))
    return store.publish(PLAYERS, month, curate.player_sides(games, source, run), measures, rules, run, source, bucket="player_id", sort=["player_id", "played_at"])


def build_aggregates(store: Store, month: str) -> bool:
    """The three aggregates, each checked against the games they count; built from the player sides' run."""
    players, source = store.read_month(PLAYERS, month)
    games, _ = store.read_month(CURATED, month)
    unique = F.lit(aggregates.once(games).count())
    run = new_run_id()
    made: dict[str, tuple[DataFrame, tuple]] = {
        SUMMARY: (aggregates.monthly_summary(games, players), checks.summary_audit(unique)),
        OPENINGS: (aggregates.opening_counts(games), checks.openings_audit(unique)),
        RATINGS: (aggregates.rating_distribution(players), checks.ratings_audit(unique)),
    }
    return all([store.publish(t, month, df.withColumns({"_source_run_id": F.lit(source), "_run_id": F.lit(run), "_built_at": F.current_timestamp()}), *rules, run, source) for t, (df, rules) in made.items()])


def build_explorer(store: Store, month: str, state_fn=None, min_support: int = sequences.MIN_SUPPORT, start: str = "w  ") -> bool:
    games, source = store.read_month(CURATED, month)
    raw, _ = store.read_month(RAW, month)
    rows = sequences.game_rows(raw, games).persist()
    try:
        unique, joined = aggregates.once(games).count(), rows.count()
        n, bad = sequences.pair_counts(rows, state_fn, min_support).agg(F.coalesce(F.sum("pairs"), F.lit(0)), F.coalesce(F.sum("unplaced"), F.lit(0))).first()
        run = new_run_id()
        measures, rules = checks.explorer_audit(F.lit(unique), F.lit(joined), F.lit(n), F.lit(bad), start)
        moves = sequences.next_steps(rows, state_fn, min_support).withColumns({"_source_run_id": F.lit(source), "_run_id": F.lit(run), "_built_at": F.current_timestamp()})
        return store.publish(EXPLORER, month, moves, measures, rules, run, source, bucket="position", sort=["position", "move"])
    finally:
        rows.unpersist()


def build_costs(store: Store, rows: DataFrame, month: str) -> bool:
    """A month of costs, replaced whole; an empty month is published."""
    run = new_run_id()
    measures, rules = checks.cost_audit(F.lit(month))
    return store.publish(COSTS, month, rows.where(F.col("month") == month).withColumns({"_run_id": F.lit(run), "_fetched_at": F.current_timestamp()}), measures, rules, run)


def build_pending(store: Store) -> dict[str, dict[str, bool]]:
    """Bring every layer up to date, in order; a rejected month stops its own later layers only."""
    out: dict[str, dict[str, bool]] = {}
    for source, targets, step in ((RAW, [CURATED], build_curated), (CURATED, [PLAYERS], build_players), (PLAYERS, AGGREGATES, build_aggregates), (CURATED, [EXPLORER], build_explorer)):
        out[targets[0]] = {m: step(store, m) for m in store.pending(source, *targets)}
    return out


def refresh(store: Store, buckets: int = 16) -> dict[str, dict[str, bool]]:
    """Bring typed games, player sides and aggregates up to date, all pending months of a table in one job, each audited against
    its own counts of the layer below; by table, whether each month built was published. A rejected month stops its own later
    layers only; where nothing is pending nothing is read. The result is that of the builders month by month."""
    done: dict[str, dict[str, bool]] = {}
    count = lambda rows, name: rows.groupBy("month").agg(F.count("*").alias(name))
    if todo := store.pending(RAW, CURATED):
        raw, runs = store.read_months(RAW, todo)
        run = new_run_id()
        rows = curate.curate_games(raw, _by_month(runs), run, within=["month"])
        done[CURATED] = store.publish_months(CURATED, rows, *checks.curated_audit(F.col("month"), F.col("told")), run, runs, count(raw, "told"), sort=["game_id"])
    if todo := store.pending(CURATED, PLAYERS):
        games, runs = store.read_months(CURATED, todo)
        run = new_run_id()
        rows = curate.player_sides(games, _by_month(runs), run)
        done[PLAYERS] = store.publish_months(PLAYERS, rows, *checks.player_games_audit(F.col("month"), F.col("told")), run, runs, count(games, "told"), bucket="player_id", buckets=buckets, sort=["player_id", "played_at"])
    if todo := store.pending(PLAYERS, *AGGREGATES):
        players, runs = store.read_months(PLAYERS, todo)
        games, _ = store.read_months(CURATED, todo)
        told, run, unique = count(aggregates.once(games), "told"), new_run_id(), F.col("told")
        made = {
            SUMMARY: (aggregates.monthly_summary(games, players), checks.summary_audit(unique)),
            OPENINGS: (aggregates.opening_counts(games), checks.openings_audit(unique)),
            RATINGS: (aggregates.rating_distribution(players), checks.ratings_audit(unique)),
        }
        for table, (rows, audit) in made.items():
            done[table] = store.publish_months(table, rows.withColumns({"_source_run_id": _by_month(runs), "_run_id": F.lit(run), "_built_at": F.current_timestamp()}), *audit, run, runs, told)
    return done


def _by_month(runs: dict[str, str]) -> Column:
    """The run of a row's month."""
    return F.create_map(*[F.lit(x) for pair in runs.items() for x in pair])[F.col("month")]
