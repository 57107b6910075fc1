"""The next-step explorer: which step follows which state, merged over the orders that lead to it.

A state is what a prefix of steps has reached. The built-in state, in Catalyst alone, is the side to move with the sorted
steps of either side; it merges transpositions, but unlike a board it is blind to captures and move order that change
legality. Two things replace it. ``state_fn`` (a function from a pandas Series of prefixes to a Series of states) is evaluated
once for each distinct prefix; a :class:`Replay` derives a prefix's state from its parent's and one step, a join for each
length, so that no prefix is replayed from its start. A null state means that the prefix could not be replayed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..plans.scratch import written

MAX_STEPS = 16
MIN_SUPPORT = 5
#: Lengths that are counted together before the sequences without support are left out of the next ones.
STRIDE = 4
COMMENT = r"\{[^}]*\}"
DECORATION = r"\d+\.+|\$\d+|[?!]+"


def moves(movetext: Column, limit: int = MAX_STEPS) -> Column:
    """The first moves of a movetext without comments, move numbers, annotations and result; null stays null."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(movetext, COMMENT, " "), DECORATION, " "))
    return F.slice(F.filter(F.split(bare, r"\s+"), lambda m: (m != "") & ~m.isin(*C.RAW_RESULTS)), 1, limit)


GAME = ["game_id", "_source_file"]


def game_texts(raw: DataFrame) -> DataFrame:
    """The movetext of each game id and source file."""
    text = raw.select(C.game_id(F.col("Site")).alias("game_id"), "_source_file", "movetext")
    # copies within a file would meet each other; any of their texts will do
    return text.where(F.col("game_id").isNotNull()).groupBy(*GAME).agg(F.min("movetext").alias("movetext"))


def counted_games(games: DataFrame) -> DataFrame:
    """What the explorer takes from the games that count."""
    rating = C.mean_rating(F.col("white_elo"), F.col("black_elo"))
    return games.where(~F.col("is_duplicate") & F.col("game_id").isNotNull()).select(*GAME, "month", "speed", "result", rating.alias("rating"))


def rows_of(counted: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows for :func:`next_steps` of :func:`counted_games` and :func:`game_texts`, by id and source file. Where both are
    tables bucketed and sorted by these (:mod:`monthmill.plans.bucketed`), hint "merge" on one has them joined as they lie."""
    joined = counted.join(texts, GAME)
    return joined.select("game_id", "month", "speed", "result", "rating", C.explorer_band(F.col("rating")).alias("rating_band"), moves(F.col("movetext")).alias("steps"))


def game_rows(raw: DataFrame, games: DataFrame) -> DataFrame:
    """Rows for :func:`next_steps`: the movetext of raw joined to the games that count, by id and source file."""
    return rows_of(counted_games(games), game_texts(raw))


def steps(rows: DataFrame, first: int | Column = 1, last: Column | None = None) -> DataFrame:
    """One row for each step: its prefix joined by spaces, a hash of it, and the step; of all lengths, or of some."""
    first = first if isinstance(first, Column) else F.lit(first)
    last = F.size("steps") if last is None else F.least(last, F.size("steps"))
    at = rows.where(last >= first).withColumn("n", F.explode(F.sequence(first, F.greatest(last, first))))
    prefix = F.array_join(F.slice("steps", F.lit(1), F.col("n") - 1), " ")
    return at.withColumn("prefix", prefix).withColumn("move", F.element_at("steps", F.col("n"))).withColumn("prefix_hash", F.xxhash64("prefix")).drop("steps")


def built_in_state(prefix: Column) -> Column:
    """'w' or 'b' to move, and the sorted moves of each side."""
    made = F.filter(F.split(prefix, " "), lambda m: m != "")
    side = lambda parity: F.array_join(F.array_sort(F.transform(F.filter(F.transform(made, lambda m, i: F.struct(i.alias("i"), m.alias("m"))), lambda s: s["i"] % 2 == parity), lambda s: s["m"])), ",")
    return F.concat_ws(" ", F.when(F.size(made) % 2 == 0, "w").otherwise("b"), side(0), side(1))


def board_key(fen: Column) -> Column:
    """Placement, side to move and castling rights of a FEN."""
    return F.array_join(F.slice(F.split(F.trim(fen), r"\s+"), 1, 3), " ")


def support(pairs: DataFrame, min_support: int = MIN_SUPPORT) -> DataFrame:
    """(month, prefix_hash, move) played often enough, counted on hashes before anything wide moves; a row counts once, or as
    its ``games`` tell."""
    keys = ["month", "prefix_hash", "move", *(["n"] if "n" in pairs.columns else [])]  # equal prefixes are of equal length
    played = F.sum("games") if "games" in pairs.columns else F.count("*")
    return pairs.groupBy(*keys).agg(played.alias("count")).where(F.col("count") >= min_support).drop("count")


def kept_steps(rows: DataFrame, min_support: int = MIN_SUPPORT, stride: int = STRIDE, longest: int = MAX_STEPS) -> DataFrame:
    """The steps whose pair of a prefix and a step has support in its month, as :func:`steps` gives them.

    No pair has more support than its prefix's own last pair. So lengths are counted ``stride`` at a time, and beyond the
    first only in sequences whose pair at the last length counted has support; steps that cannot have it are never made. The
    tables of supported pairs are written, and joined back to the sequences at each stride's end; where they are small Spark
    broadcasts them, by their written size. rows should be a table, as each stride reads it.
    """
    weight = ["games"] if "games" in rows.columns else []
    narrow, found = rows.select("month", "steps", *weight), []
    reached = rows.withColumn("mm_last", F.lit(stride))
    for done in range(0, longest, stride):
        pairs = steps(narrow, done + 1, F.lit(done + stride)).select("month", "prefix_hash", "move", "n", *weight)
        table = written(support(pairs, min_support), "support")
        found.append(table.drop("n"))
        at = done + stride
        ends = table.where(F.col("n") == at)
        if at >= longest or ends.isEmpty():
            break
        ends = ends.select(F.col("month").alias("mm_month"), F.col("prefix_hash").alias("mm_hash"), F.col("move").alias("mm_move"))
        on = lambda df, at=at, ends=ends: [df["month"].eqNullSafe(ends["mm_month"]), F.xxhash64(F.array_join(F.slice(df["steps"], 1, at - 1), " ")) == ends["mm_hash"], F.get(df["steps"], F.lit(at - 1)) == ends["mm_move"]]
        narrow = narrow.join(ends, on(narrow), "left_semi")
        flagged = ends.withColumn("mm_on", F.lit(True))
        reached = reached.join(flagged, [reached["mm_last"] == at, *on(reached)], "left").withColumn("mm_last", F.when(F.col("mm_on"), at + stride).otherwise(F.col("mm_last"))).drop("mm_month", "mm_hash", "mm_move", "mm_on")
    all_pairs = reduce(DataFrame.unionByName, found)
    return steps(reached, 1, F.col("mm_last")).drop("mm_last", "n").join(all_pairs, ["month", "prefix_hash", "move"], "left_semi")


@dataclass(frozen=True)
class Replay:
    """A state machine: the state of the empty prefix, and the next state of (state, step). ``step`` is made of columns, or is a
    pandas UDF of two columns; a null state stays null. ``name`` turns a state into what positions are called."""

    start: Column
    step: Callable[[Column, Column], Column]
    name: Callable[[Column], Column] = lambda state: state


def prefix_states(prefixes: DataFrame, replay: Replay, longest: int = MAX_STEPS) -> DataFrame:
    """prefix and position of the given prefixes (one column, all of whose own prefixes are among them, as those with support
    have them), each state derived from that of the prefix a step shorter: one join a length, on tables of distinct prefixes."""
    made = F.filter(F.split("prefix", " "), lambda m: m != "")
    at = written(prefixes.distinct().withColumn("mm_n", F.size(made)).withColumn("mm_up", F.array_join(F.slice(made, 1, F.greatest(F.size(made) - 1, F.lit(0))), " ")).withColumn("mm_step", F.try_element_at(made, F.lit(-1))), "prefixes")
    level = written(at.sparkSession.range(1).select(F.lit("").alias("prefix"), replay.start.alias("state")), "states")
    levels = [level]
    for n in range(1, longest):
        own = at.where(F.col("mm_n") == n)
        above = level.select(F.col("prefix").alias("mm_up"), F.col("state").alias("mm_state"))
        level = written(own.join(above, "mm_up").select("prefix", F.when(F.col("mm_state").isNotNull(), replay.step(F.col("mm_state"), F.col("mm_step"))).alias("state")), "states")
        if level.isEmpty():
            break
        levels.append(level)
    states = reduce(DataFrame.unionByName, levels).select("prefix", replay.name(F.col("state")).alias("position"))
    return at.select("prefix").join(states, "prefix", "left")


def captures_state() -> Replay:
    """States that know captures, without a rules engine: which piece moved to which square for either side, and whose turn it
    is. A step that takes ('x') removes what the other side had moved to its square; castling moves nothing that is tracked."""
    side = "array<string>"
    none = F.array().cast(side)

    def step(state: Column, move: Column) -> Column:
        square = F.regexp_extract(move, r"([a-h][1-8])(?:=[QRBN])?[+#]?$", 1)
        piece = F.coalesce(F.nullif(F.regexp_extract(move, r"^([KQRBN])", 1), F.lit("")), F.lit("P"))
        own, other = F.when(state["white"], state["whites"]).otherwise(state["blacks"]), F.when(state["white"], state["blacks"]).otherwise(state["whites"])
        # a piece that moves on leaves its square where the notation tells it apart; one of its kind on the new square is replaced
        mine = F.when(square == "", own).otherwise(F.array_sort(F.array_append(F.filter(own, lambda p: ~p.endswith(square)), F.concat(piece, square))))
        theirs = F.when(move.contains("x"), F.filter(other, lambda p: ~p.endswith(square))).otherwise(other)
        return F.struct((~state["white"]).alias("white"), F.when(state["white"], mine).otherwise(theirs).alias("whites"), F.when(state["white"], theirs).otherwise(mine).alias("blacks"))

    start = F.struct(F.lit(True).alias("white"), none.alias("whites"), none.alias("blacks"))
    return Replay(start, step, lambda s: F.concat_ws(" ", F.when(s["white"], "w").otherwise("b"), F.array_join(s["whites"], ","), F.array_join(s["blacks"], ",")))


def best_example() -> Column:
    """Id of the highest-rated game, ties to the larger id; null where none is rated."""
    return F.max(F.when(F.col("rating").isNotNull(), F.struct("rating", "game_id")))


def equal_sequences(rows: DataFrame) -> DataFrame:
    """rows, those with the same steps, month, speed and band as one with their counts (``games`` and so on), written.

    The best example of a group is a struct, for which Spark sorts what it groups; so games are grouped here once, before each
    becomes as many rows as it has steps, and what is sorted after that are different sequences."""
    r = F.col("result")
    merged = rows.groupBy("month", "speed", "rating_band", "steps").agg(
        F.count("*").alias("games"), F.count_if(r == "white").alias("white_wins"), F.count_if(r == "draw").alias("draws"), F.count_if(r == "black").alias("black_wins"), F.count("rating").alias("rated_games"), F.sum("rating").alias("rating_sum"), best_example().alias("best")
    )
    return written(merged, "sequences")


def _placed(rows: DataFrame, state: Callable | Replay | None) -> DataFrame:
    """rows with the position of their prefix; a function of prefixes sees each distinct one once."""
    if state is None:
        return rows.withColumn("position", built_in_state(F.col("prefix")))
    prefixes = rows.select("prefix").distinct()
    positions = prefix_states(prefixes, state) if isinstance(state, Replay) else prefixes.withColumn("position", F.pandas_udf(state, "string")("prefix"))
    return rows.join(positions, "prefix")


def next_steps(rows: DataFrame, state_fn: Callable | Replay | None = None, min_support: int = MIN_SUPPORT, kept: DataFrame | None = None) -> DataFrame:
    """By month, position, move, speed and band: games, results, rated games, the sum of their ratings, the best example.

    Pairs of a prefix and a move below ``min_support`` in a month are dropped before prefixes are merged; ``kept``: the steps
    of :func:`equal_sequences` that have it, where they are known.
    """
    kept = kept_steps(equal_sequences(rows), min_support) if kept is None else kept
    sums = [F.sum(c).alias(c) for c in ("games", "white_wins", "draws", "black_wins", "rated_games")]
    cells = kept.groupBy("month", "prefix", "move", "speed", "rating_band").agg(*sums, F.sum("rating_sum").alias("rating_sum"), F.max("best").alias("best"))
    if isinstance(state_fn, Replay):
        cells = written(cells, "cells")
    merged = _placed(cells, state_fn).where(F.col("position").isNotNull()).groupBy("month", "position", "move", "speed", "rating_band").agg(
        *sums, F.coalesce(F.sum("rating_sum"), F.lit(0.0)).alias("rating_sum"), F.max("best").alias("best")
    )
    return merged.select("*", F.col("best.game_id").alias("example_game_id"), F.col("best.rating").alias("example_rating")).drop("best")


def pair_counts(rows: DataFrame, state_fn: Callable | Replay | None = None, min_support: int = MIN_SUPPORT, kept: DataFrame | None = None) -> DataFrame:
    """By month, how many distinct pairs of a prefix and a move have support, and of how many the prefix has no state."""
    pairs = (kept_steps(equal_sequences(rows), min_support) if kept is None else kept).select("month", "prefix", "move").distinct()
    return _placed(pairs, state_fn).groupBy("month").agg(F.count("*").alias("pairs"), F.count_if(F.col("position").isNull()).alias("unplaced"))


def explore(position_moves: DataFrame, position: str, from_month: str | None = None, to_month: str | None = None, speeds: list[str] | None = None, bands: list[int] | None = None) -> DataFrame:
    """Moves from a position over a selection: counts, mean rating, share of the games, best example; most played first."""
    rows = position_moves.where(F.col("position") == position)
    if from_month:
        rows = rows.where(F.col("month") >= from_month)
    if to_month:
        rows = rows.where(F.col("month") <= to_month)
    if speeds:
        rows = rows.where(F.col("speed").isin(*speeds))
    if bands:
        rows = rows.where(F.col("rating_band").isin(*bands))
    example = F.max(F.when(F.col("example_rating").isNotNull(), F.struct(F.col("example_rating"), F.col("example_game_id"))))
    sums = rows.groupBy("move").agg(*[F.sum(c).alias(c) for c in ("games", "white_wins", "draws", "black_wins", "rated_games", "rating_sum")], example.alias("best"))
    out = sums.withColumn("total", F.sum("games").over(Window.partitionBy()))  # over the position's moves, a few dozen
    return out.select(
        "move",
        "games",
        "white_wins",
        "draws",
        "black_wins",
        (F.col("games") - F.col("white_wins") - F.col("draws") - F.col("black_wins")).alias("unfinished"),
        F.try_divide("rating_sum", F.nullif("rated_games", F.lit(0))).alias("avg_rating"),
        (F.col("games") / F.col("total")).alias("share"),
        F.col("best.example_game_id").alias("example_game_id"),
    ).orderBy(F.desc("games"), "move")


def numbered(made: Column) -> Column:
    """'1. e4 c5 2. Nf3' of an array of moves."""
    return F.array_join(F.transform(made, lambda m, i: F.when(i % 2 == 0, F.concat((F.floor(i / 2) + 1).cast("string"), F.lit(". "), m)).otherwise(m)), " ")


def event_sequences(events: DataFrame, limit: int = MAX_STEPS) -> DataFrame:
    """Users' events as sequences for :func:`next_steps`: each month's in order of time and id, in chunks of ``limit``.

    A chunk is (user, month, number div limit); its events are gathered, at most ``limit`` of them, never a whole history.
    """
    placed = events.withColumn("month", F.date_format("ts", "yyyy-MM"))
    n = F.row_number().over(Window.partitionBy("user_id", "month").orderBy("ts", "event_id")) - 1
    chunk = placed.withColumn("n", n).withColumn("chunk", F.floor(F.col("n") / limit))
    rows = chunk.groupBy("user_id", "month", "chunk").agg(F.sort_array(F.collect_list(F.struct("n", "event_type"))).alias("s"))
    return rows.select("user_id", "month", "chunk", F.transform("s", lambda e: e["event_type"]).alias("steps"))
