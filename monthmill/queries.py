"""The registered queries: every operator on the driver's tables, each with its DuckDB twin.

The tables hold no games, so a deterministic relation of raw games is derived from ``orders`` by one statement that both
engines accept; costs are derived from ``lineitem``, event sequences from ``events``. All run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import columns as C
from .operators import aggregates, curate, sequences, serve
from .plans import checks, publish
from .plans.scratch import written
from .sources import landing, pgn

RUN = "run-2"
FROM, TO = "1996-01", "1998-12"

RAW_SQL = """
SELECT 'https://games.example/' || lpad(CAST(k AS STRING), 8, '0') AS Site,
  CASE WHEN k % 11 = 0 THEN 'Rated tournament https://games.example/tournament/t' || CAST(k % 100 AS STRING)
       WHEN k % 13 = 0 THEN 'Rated swiss https://games.example/swiss/s' || CAST(k % 100 AS STRING) ELSE 'Rated game' END AS Event,
  'Player' || CAST(w AS STRING) AS White, 'player' || CAST(b AS STRING) AS Black,
  CASE WHEN k % 101 = 0 THEN '*' WHEN s = 'F' THEN '1-0' WHEN s = 'O' THEN '0-1' ELSE '1/2-1/2' END AS Result,
  replace(substr(d, 1, 10), '-', '.') AS UTCDate,
  lpad(CAST(k % 24 AS STRING), 2, '0') || ':' || lpad(CAST(k % 60 AS STRING), 2, '0') || ':00' AS UTCTime,
  CASE WHEN k % 53 = 0 THEN '?' ELSE CAST(800 + (w * 37) % 2000 AS STRING) END AS WhiteElo,
  CASE WHEN k % 53 = 0 THEN '?' ELSE CAST(800 + (b * 41) % 2000 AS STRING) END AS BlackElo,
  CASE WHEN k % 53 <> 0 THEN '+' || CAST(k % 15 AS STRING) END AS WhiteRatingDiff,
  CASE WHEN k % 53 <> 0 THEN '-' || CAST(k % 15 AS STRING) END AS BlackRatingDiff,
  CASE WHEN w % 50 = 0 THEN 'BOT' WHEN w % 70 = 0 THEN 'GM' END AS WhiteTitle,
  CASE WHEN b % 60 = 0 THEN 'BOT' END AS BlackTitle,
  CASE k % 5 WHEN 0 THEN 'A04' WHEN 1 THEN 'D02' WHEN 2 THEN 'C20' WHEN 3 THEN 'B01' ELSE 'A40' END AS ECO,
  'Opening ' || p AS Opening,
  CASE k % 7 WHEN 0 THEN '15+0' WHEN 1 THEN '60+0' WHEN 2 THEN '180+2' WHEN 3 THEN '300+5' WHEN 4 THEN '900+10' WHEN 5 THEN '1800+30' ELSE '-' END AS TimeControl,
  CASE WHEN k % 89 = 0 THEN 'Something new' WHEN k % 3 = 0 THEN 'Time forfeit' ELSE 'Normal' END AS Termination,
  CASE k % 6 WHEN 0 THEN '1. Nf3 d5 2. d4 Nf6 3. c4 e6 1-0'
    WHEN 1 THEN '1. d4 {{ [%clk 0:03:00] }} d5 {{ [%clk 0:03:00] }} 2. Nf3 {{ [%clk 0:02:58] }} Nf6 1/2-1/2'
    WHEN 2 THEN '1. e4 {{ [%eval 0.2] }} 1... e5 {{ [%eval 0.3] }} 2. Qh5?! Nc6 0-1'
    WHEN 3 THEN '1. e4 c5 2. Nf3 d6 $1 3. d4! cxd4 *' WHEN 4 THEN '*' ELSE '1. d4 Nf6 2. c4 e6 3. Nf3 d5 1-0' END AS movetext,
  substr(d, 1, 7) AS month, f AS _source_file, 'ingest-1' AS _run_id
FROM (
  SELECT o_orderkey AS k, o_custkey AS w, (o_custkey * 7 + 3) % 1500 AS b, CAST(o_orderdate AS STRING) AS d, o_orderstatus AS s, o_orderpriority AS p, f
  FROM (SELECT *, 'a.pgn.zst' AS f FROM {orders} UNION ALL SELECT *, 'b.pgn.zst' AS f FROM {orders} WHERE o_orderkey % 97 = 0) o) t
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """A table that is read in fewer splits than there are cores, such as one small file, dealt to all; others as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def raw_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_SQL, orders=_spread(_table(spark, sf_dir, "orders")))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.curate_games(raw_games(spark, sf_dir), "ingest-1", RUN)


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.player_sides(games(spark, sf_dir), RUN, "run-3")


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = written(games(spark, sf_dir), "curated")  # both inputs of the summary are read from it
    return aggregates.monthly_summary(g, curate.player_sides(g, RUN, "run-3"))


def openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.opening_counts(games(spark, sf_dir))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.rating_distribution(players(spark, sf_dir))


def explorer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games with their first steps, written once, as several passes read them."""
    return written(sequences.game_rows(raw_games(spark, sf_dir), games(spark, sf_dir)), "explorer-rows")


def position_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.next_steps(explorer_rows(spark, sf_dir))


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date(F.col("l_shipdate").cast("timestamp_ntz"))
    return _table(spark, sf_dir, "lineitem").select(F.date_format(day, "yyyy-MM").alias("month"), day.alias("usage_date"), F.col("l_linestatus").alias("resource_group"), F.col("l_returnflag").alias("service_name"), F.lit("line").alias("resource_type"), F.col("l_extendedprice").alias("cost"), F.lit("USD").alias("currency"))


_NO_CLOCK = ["_built_at"]


def _moment(df: DataFrame) -> DataFrame:
    return df.withColumn("played_at", F.date_format("played_at", "yyyy-MM-dd HH:mm:ss")).drop(*_NO_CLOCK)


#: month counts of landed and told rows, some altered by arithmetic
def _landed(spark, sf_dir):
    return landing.rows_by_month(raw_games(spark, sf_dir)).where(F.substring("month", 6, 2) != "02")


def _told(spark, sf_dir):
    rows = landing.rows_by_month(raw_games(spark, sf_dir)).where(F.substring("month", 6, 2) != "03")
    return rows.select("month", (F.col("rows") + F.when(F.substring("month", 6, 2) == "04", 1).otherwise(0)).alias("games"), F.concat(F.lit("sum-"), "month").alias("sha256"))


def _landed_vs_manifest(spark, sf_dir):
    return landing.landed_vs_manifest(_landed(spark, sf_dir), _told(spark, sf_dir))


def _ingest_plan(spark, sf_dir):
    listed = landing.rows_by_month(raw_games(spark, sf_dir)).select("month", F.when(F.substring("month", 6, 2) == "05", F.lit("other")).otherwise(F.concat(F.lit("sum-"), "month")).alias("sha256"))
    return landing.ingest_plan(listed, _told(spark, sf_dir).select("month", "sha256")).select("month", "status")


def _pending(spark, sf_dir):
    months = landing.rows_by_month(raw_games(spark, sf_dir))
    source = months.select("month", F.concat(F.lit("r"), F.substring("month", 6, 2)).alias("run_id"))
    target = months.where(F.substring("month", 6, 2) != "07").select("month", F.when(F.substring("month", 6, 2) == "08", F.lit("old")).otherwise(F.concat(F.lit("r"), F.substring("month", 6, 2))).alias("source_run_id"))
    return publish.pending_months(source, target)


def _dq(kind: str, spark, sf_dir):
    """Checks of a layer by month, against what the layer below it, or the manifest, tells of each month."""
    month, told = F.col("month"), F.col("told")
    raw = raw_games(spark, sf_dir)
    if kind == "raw":
        rows, below, rule = raw, _told(spark, sf_dir).select(month, F.col("games").alias("told")), checks.raw_audit
    elif kind == "curated":
        rows, below, rule = games(spark, sf_dir), landing.rows_by_month(raw).select(month, F.col("rows").alias("told")), checks.curated_audit
    else:
        rows, below, rule = players(spark, sf_dir), landing.rows_by_month(games(spark, sf_dir)).select(month, F.col("rows").alias("told")), checks.player_games_audit
    m, c = rule(month, told)
    return checks.audit(rows.join(F.broadcast(below), "month", "left"), m | {"told": F.max("told")}, c, ["month"]).drop("detail")  # a row a month


def _dq_gold(spark, sf_dir):
    g = written(games(spark, sf_dir), "curated")
    p = curate.player_sides(g, RUN, "run-3")
    unique = aggregates.once(g).groupBy("month").agg(F.count("*").alias("told"))
    parts = []
    for name, rows, rule in (("monthly_summary", aggregates.monthly_summary(g, p), checks.summary_audit), ("openings", aggregates.opening_counts(g), checks.openings_audit), ("rating_distribution", aggregates.rating_distribution(p), checks.ratings_audit)):
        m, c = rule(F.col("told"))
        parts.append(checks.audit(rows.join(F.broadcast(unique), "month"), m | {"told": F.max("told")}, c, ["month"]).withColumn("table_name", F.lit(name)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("detail")


def _dq_costs(spark, sf_dir):
    m, c = checks.cost_audit(F.col("month"))
    return checks.audit(costs(spark, sf_dir), m, c, ["month"]).drop("detail")


def _explorer_pairs(spark, sf_dir):
    rows = sequences.steps(sequences.game_rows(raw_games(spark, sf_dir), games(spark, sf_dir)))
    return rows.groupBy("month", "prefix", "move").agg(F.count("*").alias("games"))


def _event_steps(spark, sf_dir):
    rows = sequences.event_sequences(_table(spark, sf_dir, "events"))
    return rows.select("user_id", "month", "chunk", F.array_join("steps", " ").alias("steps"), F.size("steps").alias("n"))


def _pgn_round_trip(spark, sf_dir):
    """Every derived game printed as PGN and parsed again."""
    raw = raw_games(spark, sf_dir)
    text = raw.select("month", "_source_file", pgn.as_pgn(raw).alias("value"))
    parsed = pgn.parse_games(text)
    return parsed.select("Site", "Event", "White", "Black", "Result", "UTCDate", "UTCTime", "WhiteElo", "BlackElo", "WhiteTitle", "TimeControl", "movetext", "month", "_source_file")


def _unknown_tags(spark, sf_dir):
    raw = raw_games(spark, sf_dir)
    extra = F.concat(F.lit('[Shape "'), F.col("ECO"), F.lit('"]\n['), F.substring("ECO", 1, 1), F.lit('x "1"]\n'))
    text = raw.select(F.concat(extra, pgn.as_pgn(raw)).alias("value"))
    return pgn.unknown_tags(pgn.parse_games(text))


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable] = {
        "curated_games": lambda s, d: _moment(games(s, d)),
        "duplicate_flags": lambda s, d: games(s, d).where("is_duplicate").select("game_id", "_source_file"),
        "player_games": lambda s, d: _moment(players(s, d)),
        "monthly_summary": summary,
        "openings": openings,
        "rating_distribution": ratings,
        "months": lambda s, d: serve.months(summary(s, d)),
        "summary_range": lambda s, d: serve.summary_range(summary(s, d), FROM, TO, ["blitz", "bullet", "all"]),
        "ratings_of_month": lambda s, d: serve.ratings_of(ratings(s, d), FROM),
        "top_openings": lambda s, d: serve.top_openings(openings(s, d), FROM, TO, limit=20),
        "top_openings_filtered": lambda s, d: serve.top_openings(openings(s, d), FROM, TO, "blitz", 1800, 10),
        "opening_totals": lambda s, d: serve.opening_totals(openings(s, d), FROM, TO),
        "opening_highlights": lambda s, d: serve.opening_highlights(serve.opening_totals(openings(s, d), FROM, TO)),
        "openings_by_share": lambda s, d: serve.openings_by_share(serve.opening_totals(openings(s, d), FROM, TO)).select("eco", "opening", "games", "rank", "share"),
        "speed_shares": lambda s, d: serve.speed_shares(summary(s, d)),
        "month_kpis": lambda s, d: serve.month_kpis(summary(s, d)),
        "month_gaps": lambda s, d: serve.month_gaps(summary(s, d).where(~F.substring("month", 6, 2).isin("03", "08"))),
        "median_bucket": lambda s, d: serve.median_bucket(ratings(s, d)),
        "results_by_speed": lambda s, d: serve.results_by_speed(summary(s, d), FROM, TO),
        "white_win_percentage": lambda s, d: serve.white_win_percentage(summary(s, d)),
        "select_months": lambda s, d: serve.select_months(summary(s, d), "1995,1996-11:1997-02,1998:1998"),
        "resolve_range": lambda s, d: serve.resolve_range(summary(s, d), "1997-05", "nonsense", 6),
        "explorer_pairs": _explorer_pairs,
        "position_moves": position_moves,
        "explorer_lookup": lambda s, d: serve_explorer(s, d),
        "event_sequences": _event_steps,
        "pgn_round_trip": _pgn_round_trip,
        "unknown_tags": _unknown_tags,
        "landed_vs_manifest": _landed_vs_manifest,
        "ingest_plan": _ingest_plan,
        "pending_months": _pending,
        "dq_raw": partial(_dq, "raw"),
        "dq_curated": partial(_dq, "curated"),
        "dq_player_games": partial(_dq, "players"),
        "dq_gold": _dq_gold,
        "dq_costs": _dq_costs,
        "daily_cost": lambda s, d: serve.daily_cost(costs(s, d), FROM).withColumn("usage_date", F.col("usage_date").cast("string")).withColumn("cost", F.col("cost").cast("double")),
        "cost_month_totals": lambda s, d: serve.cost_months(costs(s, d)).withColumn("cost", F.col("cost").cast("double")),
        "player_record": lambda s, d: serve.player_record(players(s, d), "Player10"),
        "head_to_head": lambda s, d: serve.head_to_head(players(s, d), "player10", "player73"),
        "bot_leaderboard": lambda s, d: serve.bot_leaderboard(players(s, d), 20),
        "white_score_by_rating": lambda s, d: serve.score_by_rating(games(s, d), 100),
        "point_lookup": lambda s, d: _moment(serve.get_game(games(s, d), "00000097")).drop("_run_id", "_source_run_id"),
    }
    from . import queries_store

    return q | queries_store.queries()


def serve_explorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.explore(position_moves(spark, sf_dir), "w Nf3,d4 Nf6,d5", FROM, TO)


queries = _queries

# -- DuckDB twins ----------------------------------------------------------------------------------------------------

_SPEED = """CASE WHEN TimeControl = '-' THEN 'correspondence' WHEN est < 30 THEN 'ultrabullet' WHEN est < 180 THEN 'bullet' WHEN est < 480 THEN 'blitz' WHEN est < 1500 THEN 'rapid' WHEN est IS NOT NULL THEN 'classical' END"""
_GAMES = f"""
raw AS ({RAW_SQL.format(orders="orders")}),
clocked AS (
  SELECT *, CASE WHEN regexp_matches(TimeControl, '^[0-9]+\\+[0-9]+$') THEN TRY_CAST(split_part(TimeControl, '+', 1) AS INTEGER) END AS base_seconds,
    CASE WHEN regexp_matches(TimeControl, '^[0-9]+\\+[0-9]+$') THEN TRY_CAST(split_part(TimeControl, '+', 2) AS INTEGER) END AS increment_seconds, base_seconds + 40 * increment_seconds AS est,
    nullif(regexp_extract(Site, '^https?://[^/]+/([A-Za-z0-9]{{8}})$', 1), '') AS game_id FROM raw),
games AS (
  SELECT game_id, month, strftime(try_strptime(UTCDate || ' ' || UTCTime, '%Y.%m.%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS played_at, Event AS event,
    nullif(regexp_extract(Event, '/tournament/([A-Za-z0-9]+)', 1), '') AS tournament_id, nullif(regexp_extract(Event, '/swiss/([A-Za-z0-9]+)', 1), '') AS swiss_id,
    White AS white, Black AS black, TRY_CAST(WhiteElo AS INTEGER) AS white_elo, TRY_CAST(BlackElo AS INTEGER) AS black_elo,
    TRY_CAST(replace(WhiteRatingDiff, '+', '') AS INTEGER) AS white_rating_diff, TRY_CAST(replace(BlackRatingDiff, '+', '') AS INTEGER) AS black_rating_diff,
    WhiteTitle AS white_title, BlackTitle AS black_title, coalesce(WhiteTitle = 'BOT', false) AS white_is_bot, coalesce(BlackTitle = 'BOT', false) AS black_is_bot,
    CASE Result WHEN '1-0' THEN 'white' WHEN '0-1' THEN 'black' WHEN '1/2-1/2' THEN 'draw' END AS result, Termination AS termination, ECO AS eco, Opening AS opening,
    TimeControl AS time_control, base_seconds, increment_seconds, {_SPEED} AS speed, _source_file,
    game_id IS NOT NULL AND row_number() OVER (PARTITION BY game_id ORDER BY _source_file) > 1 AS is_duplicate,
    'ingest-1' AS _source_run_id, 'run-2' AS _run_id, movetext FROM clocked)"""


def _side(own: str, other: str, color: str, win: str) -> str:
    return f"""SELECT {own} AS player, lower({own}) AS player_id, '{color}' AS color, {other} AS opponent, lower({other}) AS opponent_id, {own}_elo AS rating, {other}_elo AS opponent_rating,
    {own}_rating_diff AS rating_diff, {own}_title AS title, {other}_title AS opponent_title, {own}_is_bot AS is_bot, {other}_is_bot AS opponent_is_bot,
    CASE WHEN result = 'draw' THEN 'draw' WHEN result = '{win}' THEN 'win' WHEN result IS NOT NULL THEN 'loss' END AS outcome,
    game_id, month, played_at, speed, base_seconds, increment_seconds, eco, opening, termination, tournament_id, swiss_id, is_duplicate,
    CASE WHEN result = 'draw' THEN 0.5::DOUBLE WHEN result = '{win}' THEN 1.0::DOUBLE WHEN result IS NOT NULL THEN 0.0::DOUBLE END AS score, 'run-2' AS _source_run_id, 'run-3' AS _run_id FROM games"""


_PLAYERS = _GAMES + f", players AS ({_side('white', 'black', 'white', 'white')} UNION ALL {_side('black', 'white', 'black', 'black')})"
_RESULTS = "count(*) AS games, count(*) FILTER (result = 'white') AS white_wins, count(*) FILTER (result = 'draw') AS draws, count(*) FILTER (result = 'black') AS black_wins, count(*) FILTER (result IS NULL) AS unfinished"
_SUMMARY = (
    _PLAYERS
    + f""", g AS (SELECT month, CASE WHEN grouping(speed) = 1 THEN 'all' ELSE speed END AS speed, {_RESULTS}, count(*) FILTER (white_is_bot OR black_is_bot) AS bot_games, avg((white_elo + black_elo) / 2) AS avg_rating
  FROM games WHERE NOT is_duplicate GROUP BY GROUPING SETS ((month, speed), (month))),
p AS (SELECT month, CASE WHEN grouping(speed) = 1 THEN 'all' ELSE speed END AS speed, count(DISTINCT player_id) AS players FROM players WHERE NOT is_duplicate GROUP BY GROUPING SETS ((month, speed), (month))),
summary AS (SELECT g.month, g.speed, games, coalesce(players, 0) AS players, white_wins, draws, black_wins, unfinished, bot_games, avg_rating FROM g LEFT JOIN p ON g.month = p.month AND g.speed IS NOT DISTINCT FROM p.speed)"""
)
_OPENINGS = _GAMES + f", openings AS (SELECT month, speed, eco, opening, CAST(floor((white_elo + black_elo) / 2 / 200) * 200 AS INTEGER) AS rating_band, {_RESULTS} FROM games WHERE NOT is_duplicate GROUP BY ALL)"
_RATINGS = _PLAYERS + ", ratings AS (SELECT month, speed, CAST(floor(rating / 50) * 50 AS INTEGER) AS rating_bucket, count(*) AS player_games, count(DISTINCT player_id) AS players FROM players WHERE NOT is_duplicate GROUP BY ALL)"
_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("games", "white_wins", "draws", "black_wins", "unfinished"))
_TOTALS = _OPENINGS + f", totals AS (SELECT eco, opening, {_SUMS} FROM openings WHERE month BETWEEN '{FROM}' AND '{TO}' GROUP BY eco, opening)"
_KNOWN = "('" + "', '".join(C.SPEED_ORDER) + "')"
_STEPS = (
    _GAMES
    + """, texts AS (SELECT game_id, _source_file, min(movetext) AS movetext FROM games WHERE game_id IS NOT NULL GROUP BY ALL),
bare AS (
  SELECT game_id, month, speed, result, (white_elo + black_elo) / 2 AS rating,
    list_slice(list_filter(string_split_regex(trim(regexp_replace(regexp_replace(t.movetext, '\\{[^}]*\\}', ' ', 'g'), '\\d+\\.+|\\$\\d+|[?!]+', ' ', 'g')), '\\s+'), lambda m: m NOT IN ('', '1-0', '0-1', '1/2-1/2', '*')), 1, 16) AS steps
  FROM games JOIN texts t USING (game_id, _source_file) WHERE NOT is_duplicate),
steps AS (
  SELECT game_id, month, speed, result, rating, CASE WHEN rating >= 2400 THEN 2400 WHEN rating >= 2000 THEN 2000 WHEN rating >= 1600 THEN 1600 WHEN rating >= 1200 THEN 1200 WHEN rating >= 0 THEN 0 END AS rating_band,
    coalesce(array_to_string(list_slice(steps, 1, n - 1), ' '), '') AS prefix, steps[n] AS move, n FROM (SELECT *, unnest(generate_series(1, len(steps))) AS n FROM bare))"""
)
_POSITIONS = (
    _STEPS
    + """, kept AS (SELECT month, prefix, move FROM steps GROUP BY ALL HAVING count(*) >= 5),
named AS (
  SELECT s.*, CASE WHEN n % 2 = 1 THEN 'w' ELSE 'b' END || ' ' ||
    coalesce(array_to_string(list_sort(list_filter(string_split(prefix, ' '), lambda m, i: i % 2 = 1 AND m <> '')), ','), '') || ' ' ||
    coalesce(array_to_string(list_sort(list_filter(string_split(prefix, ' '), lambda m, i: i % 2 = 0 AND m <> '')), ','), '') AS position
  FROM steps s SEMI JOIN kept USING (month, prefix, move)),
position_moves AS (
  SELECT month, position, move, speed, rating_band, count(*) AS games, count(*) FILTER (result = 'white') AS white_wins, count(*) FILTER (result = 'draw') AS draws, count(*) FILTER (result = 'black') AS black_wins,
    count(rating) AS rated_games, coalesce(sum(rating), 0.0) AS rating_sum, arg_max(game_id, {'r': rating, 'g': game_id}) FILTER (rating IS NOT NULL) AS example_game_id, max(rating) AS example_rating
  FROM named GROUP BY ALL)"""
)
_LANDED = (
    _GAMES
    + """, counts AS (SELECT month, count(*) AS rows FROM raw GROUP BY month),
landed AS (SELECT * FROM counts WHERE substr(month, 6, 2) <> '02'),
told AS (SELECT month, rows + CASE WHEN substr(month, 6, 2) = '04' THEN 1 ELSE 0 END AS games, 'sum-' || month AS sha256 FROM counts WHERE substr(month, 6, 2) <> '03')"""
)
_COSTS = "costs AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, strftime(l_shipdate, '%Y-%m-%d') AS usage_date, l_returnflag AS service_name, l_extendedprice AS cost, 'USD' AS currency FROM lineitem)"


def _checks(ctes: str, source: str, rules: list[tuple[str, str, str, str, bool]], by: str = "month", more: str = "") -> str:
    """One row a rule and month: (name, observed, expected, passed, blocking) over the grouped rows of source."""
    return f"WITH {ctes} " + " UNION ALL ".join(
        f"SELECT {by}, '{n}' AS check_name, {p} AS passed, CAST({o} AS BIGINT) AS observed, CAST({e} AS BIGINT) AS expected, {str(b).lower()} AS blocking{more} FROM {source} GROUP BY {by}" for n, o, e, p, b in rules
    )


def _zero(name: str, condition: str, blocking: bool = True) -> tuple[str, str, str, str, bool]:
    n = f"count(*) FILTER ({condition})"
    return name, n, "0", f"{n} = 0", blocking


def _expected(name: str, observed: str, expected: str) -> tuple[str, str, str, str, bool]:
    return name, observed, f"coalesce({expected}, 0)", f"{observed} = coalesce({expected}, 0)", True


_NOT_EMPTY = ("not_empty", "count(*)", "NULL", "count(*) > 0", True)
_OUT = lambda c: f"({c} IS NOT NULL AND {c} NOT BETWEEN 400 AND 4000)"
_TERMS = "('" + "', '".join(C.TERMINATIONS) + "')"


def _dq_gold_sql() -> str:
    ctes = _SUMMARY + ", " + _OPENINGS[len(_GAMES) + 2 :] + ", " + _RATINGS[len(_PLAYERS) + 2 :] + ", uniq AS (SELECT month, count(*) AS told FROM games WHERE NOT is_duplicate GROUP BY month)"
    part = lambda table, rules: " UNION ALL ".join(
        f"SELECT month, '{n}' AS check_name, {p} AS passed, CAST({o} AS BIGINT) AS observed, CAST({e} AS BIGINT) AS expected, true AS blocking, '{name}' AS table_name FROM {table} JOIN uniq USING (month) GROUP BY month"
        for name in [{"summary": "monthly_summary", "openings": "openings", "ratings": "rating_distribution"}[table]]
        for n, o, e, p in rules
    )
    eq = lambda n, o, e: (n, o, e, f"{o} = {e}")
    empty = ("not_empty", "count(*)", "NULL", "count(*) > 0")
    return f"WITH {ctes} " + " UNION ALL ".join(
        [
            part("summary", [eq("total_matches_curated", "sum(games) FILTER (speed = 'all')", "max(told)"), eq("speeds_add_up", "sum(games) FILTER (speed IS DISTINCT FROM 'all')", "max(told)"), empty]),
            part("openings", [eq("games_add_up", "sum(games)", "max(told)"), empty]),
            part("ratings", [eq("player_games_add_up", "sum(player_games)", "2 * max(told)"), empty]),
        ]
    )


def oracle_of_curated() -> str:
    """The checks of typed games, by month."""
    return _checks(
        f"{_GAMES}, below AS (SELECT month, count(*) AS told FROM raw GROUP BY month), src AS (SELECT games.*, told FROM games JOIN below USING (month))",
        "src",
        [
            _expected("row_count_matches_raw", "count(*)", "max(told)"),
            _zero("game_id_present", "game_id IS NULL"),
            _zero("time_control_parseable", "speed IS NULL"),
            _zero("played_at_present", "played_at IS NULL"),
            ("month_column_consistent", "0", "0", "true", True),
            _NOT_EMPTY,
            _zero("game_id_unique", "is_duplicate", False),
            _zero("rating_in_range", f"{_OUT('white_elo')} OR {_OUT('black_elo')}", False),
            _zero("result_decided", "result IS NULL", False),
            _zero("termination_known", f"termination IS NULL OR termination NOT IN {_TERMS}", False),
            _zero("played_at_in_month", "played_at IS NOT NULL AND substr(played_at, 1, 7) <> month", False),
        ],
    )


def oracle_sql() -> dict[str, str]:
    share = lambda c: f"{c} * 1.0 / games"
    best = lambda name, v: f"(SELECT '{name}' AS highlight, eco, opening FROM totals ORDER BY {v} DESC, games DESC, eco, opening LIMIT 1)"
    from . import queries_store

    made = queries_store.oracle_sql() | {
        "curated_games": f"WITH {_GAMES} SELECT * EXCLUDE (movetext) FROM games",
        "duplicate_flags": f"WITH {_GAMES} SELECT game_id, _source_file FROM games WHERE is_duplicate",
        "player_games": f"WITH {_PLAYERS} SELECT * FROM players",
        "monthly_summary": f"WITH {_SUMMARY} SELECT * FROM summary",
        "openings": f"WITH {_OPENINGS} SELECT * FROM openings",
        "rating_distribution": f"WITH {_RATINGS} SELECT * FROM ratings",
        "months": f"WITH {_GAMES} SELECT DISTINCT month FROM games WHERE NOT is_duplicate",
        "summary_range": f"WITH {_SUMMARY} SELECT * FROM summary WHERE month BETWEEN '{FROM}' AND '{TO}' AND speed IN ('blitz', 'bullet', 'all')",
        "ratings_of_month": f"WITH {_RATINGS} SELECT * FROM ratings WHERE month = '{FROM}'",
        "top_openings": f"WITH {_TOTALS} SELECT *, CAST(sum(games) OVER () AS BIGINT) AS total_games FROM totals ORDER BY games DESC, eco NULLS LAST, opening NULLS LAST LIMIT 20",
        "top_openings_filtered": f"WITH {_OPENINGS}, totals AS (SELECT eco, opening, {_SUMS} FROM openings WHERE month BETWEEN '{FROM}' AND '{TO}' AND speed = 'blitz' AND rating_band = 1800 GROUP BY eco, opening) SELECT *, CAST(sum(games) OVER () AS BIGINT) AS total_games FROM totals ORDER BY games DESC, eco NULLS LAST, opening NULLS LAST LIMIT 10",
        "opening_totals": f"WITH {_TOTALS} SELECT * FROM totals",
        "opening_highlights": f"WITH {_TOTALS} {best('most_played', 'games')} UNION ALL {best('best_for_white', share('white_wins'))} UNION ALL {best('most_drawish', share('draws'))}",
        "openings_by_share": f"WITH {_TOTALS} SELECT eco, opening, games, CAST(row_number() OVER (ORDER BY games DESC, eco NULLS LAST, opening NULLS LAST) AS INTEGER) AS rank, {share('white_wins')} AS share FROM totals",
        "speed_shares": f"WITH {_SUMMARY} SELECT month, speed, games, CASE WHEN sum(games) OVER (PARTITION BY month) > 0 THEN games / sum(games) OVER (PARTITION BY month) ELSE 0 END AS share FROM summary WHERE speed IN {_KNOWN}",
        "month_kpis": f"WITH {_SUMMARY} SELECT month, games, players, avg_rating, CASE WHEN games > 0 THEN bot_games / games ELSE 0 END AS bot_share, CASE WHEN lag(games) OVER w > 0 THEN games / lag(games) OVER w - 1 END AS games_change, lag(month) OVER w AS previous_month FROM summary WHERE speed = 'all' WINDOW w AS (ORDER BY month)",
        "month_gaps": f"WITH {_GAMES}, m AS (SELECT DISTINCT month FROM games WHERE NOT is_duplicate AND substr(month, 6, 2) NOT IN ('03', '08')), n AS (SELECT month, lead(month) OVER (ORDER BY month) AS next_month FROM m) SELECT * FROM n WHERE next_month <> strftime(CAST(month || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m')",
        "median_bucket": f"WITH {_RATINGS}, c AS (SELECT month, speed, rating_bucket, sum(player_games) OVER (PARTITION BY month, speed ORDER BY rating_bucket) AS so_far, sum(player_games) OVER (PARTITION BY month, speed) AS total FROM ratings WHERE rating_bucket IS NOT NULL) SELECT month, speed, min(rating_bucket) AS median_bucket FROM c WHERE so_far * 2 >= total GROUP BY month, speed",
        "results_by_speed": f"WITH {_SUMMARY} SELECT speed, {_SUMS} FROM summary WHERE month BETWEEN '{FROM}' AND '{TO}' AND speed IS NOT NULL GROUP BY speed",
        "white_win_percentage": f"WITH {_SUMMARY} SELECT month, round(100.0 * white_wins::DOUBLE / games, 1) AS white_win_pct FROM summary WHERE speed = 'all'",
        "select_months": f"WITH {_GAMES} SELECT DISTINCT month FROM games WHERE NOT is_duplicate AND (month LIKE '1995-%' OR month BETWEEN '1996-11' AND '1997-02' OR month LIKE '1998-%')",
        "resolve_range": f"WITH {_GAMES}, m AS (SELECT DISTINCT month FROM games WHERE NOT is_duplicate), l AS (SELECT max(month) AS b, coalesce((SELECT month FROM m WHERE month = '1997-05'), (SELECT min(month) FROM (SELECT month FROM m ORDER BY month DESC LIMIT 6))) AS a FROM m) SELECT least(a, b) AS from_month, greatest(a, b) AS to_month FROM l",
        "explorer_pairs": f"WITH {_STEPS} SELECT month, prefix, move, count(*) AS games FROM steps GROUP BY ALL",
        "position_moves": f"WITH {_POSITIONS} SELECT * FROM position_moves",
        "explorer_lookup": f"WITH {_POSITIONS}, x AS (SELECT move, CAST(sum(games) AS BIGINT) AS games, CAST(sum(white_wins) AS BIGINT) AS white_wins, CAST(sum(draws) AS BIGINT) AS draws, CAST(sum(black_wins) AS BIGINT) AS black_wins, sum(rated_games) AS r, sum(rating_sum) AS rs, arg_max(example_game_id, {{'r': example_rating, 'g': example_game_id}}) FILTER (example_rating IS NOT NULL) AS example_game_id FROM position_moves WHERE position = 'w Nf3,d4 Nf6,d5' AND month BETWEEN '{FROM}' AND '{TO}' GROUP BY move) SELECT move, games, white_wins, draws, black_wins, games - white_wins - draws - black_wins AS unfinished, CASE WHEN r > 0 THEN rs / r END AS avg_rating, games / sum(games) OVER () AS share, example_game_id FROM x",
        "event_sequences": "WITH e AS (SELECT *, strftime(ts, '%Y-%m') AS month, row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m') ORDER BY ts, event_id) - 1 AS n FROM events) SELECT user_id, month, CAST(n // 16 AS BIGINT) AS chunk, string_agg(event_type, ' ' ORDER BY n) AS steps, CAST(count(*) AS INTEGER) AS n FROM e GROUP BY user_id, month, n // 16",
        "pgn_round_trip": f"WITH {_GAMES} SELECT Site, Event, White, Black, Result, UTCDate, UTCTime, WhiteElo, BlackElo, WhiteTitle, TimeControl, movetext, month, _source_file FROM raw",
        "unknown_tags": f"WITH {_GAMES}, t AS (SELECT 'Shape' AS tag FROM raw UNION ALL SELECT substr(ECO, 1, 1) || 'x' FROM raw) SELECT tag, count(*) AS games FROM t GROUP BY tag",
        "landed_vs_manifest": f"WITH {_LANDED} SELECT month, told.games AS expected, landed.rows AS landed, told.games IS NOT DISTINCT FROM landed.rows AS matches FROM told FULL JOIN landed USING (month)",
        "ingest_plan": f"WITH {_LANDED} SELECT c.month, CASE WHEN t.month IS NULL THEN 'pending' WHEN substr(c.month, 6, 2) = '05' THEN 'changed' ELSE 'done' END AS status FROM counts c LEFT JOIN told t USING (month)",
        "pending_months": f"WITH {_LANDED} SELECT month FROM counts WHERE substr(month, 6, 2) IN ('07', '08')",
        "dq_raw": _checks(f"{_LANDED}, src AS (SELECT raw.*, games AS told FROM raw LEFT JOIN told USING (month))", "src", [_expected("row_count_matches_manifest", "count(*)", "max(told)"), _zero("site_present", "Site IS NULL OR Site = ''"), _zero("result_valid", "Result IS NULL OR Result NOT IN ('1-0', '0-1', '1/2-1/2', '*')"), ("month_column_consistent", "0", "0", "true", True), _NOT_EMPTY]),
        "dq_curated": oracle_of_curated(),
        "dq_player_games": _checks(
            f"{_PLAYERS}, below AS (SELECT month, count(*) AS told FROM games GROUP BY month), src AS (SELECT players.*, told FROM players JOIN below USING (month))",
            "src",
            [
                _expected("two_rows_per_game", "count(*)", "2 * max(told)"),
                _expected("one_white_row_per_game", "count(*) FILTER (color = 'white')", "max(told)"),
                _expected("one_black_row_per_game", "count(*) FILTER (color = 'black')", "max(told)"),
                _zero("player_present", "player_id IS NULL OR player_id = ''"),
                ("month_column_consistent", "0", "0", "true", True),
                _NOT_EMPTY,
                _zero("outcome_decided", "outcome IS NULL", False),
            ],
        ),
        "dq_gold": _dq_gold_sql(),
        "dq_costs": _checks(
            _COSTS,
            "costs",
            [
                _zero("usage_date_in_month", "substr(usage_date, 1, 7) <> month"),
                ("single_currency", "count(DISTINCT currency)", "1", "count(DISTINCT currency) <= 1", True),
                ("not_empty", "count(*)", "NULL", "count(*) > 0", False),
                _zero("no_negative_costs", "cost < 0", False),
            ],
        ),
        "daily_cost": f"WITH {_COSTS} SELECT usage_date, service_name, CAST(sum(CAST(cost AS DECIMAL(18,4))) AS DOUBLE) AS cost, max(currency) AS currency FROM costs WHERE month >= '{FROM}' GROUP BY ALL",
        "cost_month_totals": f"WITH {_COSTS} SELECT month, CAST(round(sum(CAST(cost AS DECIMAL(18,4))), 2) AS DOUBLE) AS cost, 'USD' AS currency FROM costs GROUP BY month",
        "player_record": f"WITH {_PLAYERS} SELECT month, count(*) AS games, sum(score) AS points FROM players WHERE NOT is_duplicate AND player_id = 'player10' GROUP BY month",
        "head_to_head": f"WITH {_PLAYERS} SELECT player_id, opponent_id, count(*) AS games, count(*) FILTER (outcome = 'win') AS wins, count(*) FILTER (outcome = 'draw') AS draws, count(*) FILTER (outcome = 'loss') AS losses, sum(score) AS points FROM players WHERE NOT is_duplicate AND player_id = 'player10' AND opponent_id = 'player73' GROUP BY ALL",
        "bot_leaderboard": f"WITH {_PLAYERS} SELECT player_id, count(*) AS games, sum(score) AS points FROM players WHERE NOT is_duplicate AND is_bot GROUP BY player_id ORDER BY games DESC, player_id LIMIT 20",
        "white_score_by_rating": f"WITH {_GAMES} SELECT CAST(floor(white_elo / 100) * 100 AS INTEGER) AS rating_bucket, count(*) AS games, avg(CASE result WHEN 'white' THEN 1.0 WHEN 'draw' THEN 0.5 WHEN 'black' THEN 0.0 END) AS white_score FROM games WHERE NOT is_duplicate AND event LIKE 'Rated%' AND white_elo IS NOT NULL GROUP BY 1 HAVING count(*) >= 100",
        "point_lookup": f"WITH {_GAMES} SELECT * EXCLUDE (movetext, _run_id, _source_run_id) FROM games WHERE game_id = '00000097' AND NOT is_duplicate LIMIT 1",
    }
    return made | {"refreshed_layers": queries_store.refreshed_sql(made)}
