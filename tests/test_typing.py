import random

import pytest
from pyspark.sql import functions as F

from monthmill.functions import columns as C
from monthmill.operators import curate, sequences

CLOCKS = {
    "60+0": (60, 0, "bullet"), "180+2": (180, 2, "blitz"), "300+5": (300, 5, "rapid"), "900+10": (900, 10, "rapid"), "1800+30": (1800, 30, "classical"), "15+0": (15, 0, "ultrabullet"), "29+0": (29, 0, "ultrabullet"), "30+0": (30, 0, "bullet"),
    "179+0": (179, 0, "bullet"), "479+0": (479, 0, "blitz"), "480+0": (480, 0, "rapid"), "1500+0": (1500, 0, "classical"), "0+1": (0, 1, "bullet"), "-": (None, None, "correspondence"), "abc": (None, None, None), "60": (None, None, None), None: (None, None, None),
    "99999999999+0": (None, 0, None),
}


def test_clocks(spark):
    df = spark.createDataFrame([(c,) for c in CLOCKS], "c string")
    got = df.select("c", C.base_seconds(F.col("c")), C.increment_seconds(F.col("c")), C.speed_of(F.col("c"))).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == CLOCKS


def test_tolerant_columns(spark):
    r = spark.range(1).select(
        *[C.tolerant_int(F.lit(x)) for x in ("+12", "-7", "?", "99999999999", "")],
        C.game_id(F.lit("https://games.example/abcd1234")),
        C.game_id(F.lit("https://games.example/short")),
        C.event_ref(F.lit("Rated https://games.example/tournament/Xy12"), "tournament"),
        C.event_ref(F.lit("Rated game"), "swiss"),
        C.result_name(F.lit("*")),
        C.moment(F.lit("2013.01.31"), F.lit("23:59:59")).cast("string"),
        C.moment(F.lit("????.??.??"), F.lit("x")),
        C.is_bot(F.lit(None)),
        *[C.explorer_band(F.lit(x)) for x in (0.0, 1199.5, 1200.0, 2400.0, None)],
    ).first()
    assert list(r) == [12, -7, None, None, None, "abcd1234", None, "Xy12", None, None, "2013-01-31 23:59:59", None, False, 0, 0, 1200, 2400, None]


RAW = "Site string, Event string, White string, Black string, Result string, UTCDate string, UTCTime string, WhiteElo string, BlackElo string, WhiteRatingDiff string, BlackRatingDiff string, WhiteTitle string, BlackTitle string, ECO string, Opening string, TimeControl string, Termination string, month string, _source_file string, movetext string"


def raw_row(n, **over):
    base = dict(Site=f"https://games.example/{n:08d}", Event="Rated game", White=f"Ann{n}", Black="bob", Result="1-0", UTCDate="2013.01.05", UTCTime="10:00:00", WhiteElo="1500", BlackElo="1600", WhiteRatingDiff="+3", BlackRatingDiff="-3", WhiteTitle=None, BlackTitle=None, ECO="A00", Opening="X", TimeControl="180+2", Termination="Normal", month="2013-01", _source_file="a", movetext="1. e4 e5 1-0")
    return tuple((base | over).values())


def test_duplicates_and_sides(spark):
    raw = spark.createDataFrame([raw_row(1), raw_row(1, _source_file="b"), raw_row(1), raw_row(2, Site="bad"), raw_row(2, Site="bad"), raw_row(3, Result="*", WhiteTitle="BOT")], RAW)
    games = curate.curate_games(raw, "s", "r")
    got = sorted((r.game_id or "", r._source_file, r.is_duplicate) for r in games.collect())
    assert got == [("", "a", False), ("", "a", False), ("00000001", "a", False), ("00000001", "a", True), ("00000001", "b", True), ("00000003", "a", False)]
    sides = curate.player_sides(games, "s", "r")
    assert sides.count() == 12
    bot = sides.where("game_id = '00000003'").orderBy("color").collect()
    assert [(r.color, r.is_bot, r.outcome, r.score) for r in bot] == [("black", False, None, None), ("white", True, None, None)]
    assert sides.where("outcome = 'win'").agg(F.sum("score")).first()[0] == 5.0


def test_moves(spark):
    texts = ["1. e4 { [%eval 0.2] } 1... e5 2. Qh5?! Nc6 0-1", "*", None, "", "1. d4 $1 d5!! 1/2-1/2"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(sequences.moves(F.col("t"))).collect()]
    assert got == [["e4", "e5", "Qh5", "Nc6"], [], None, [], ["d4", "d5"]]
    assert spark.range(1).select(sequences.numbered(F.array(F.lit("e4"), F.lit("c5"), F.lit("Nf3")))).first()[0] == "1. e4 c5 2. Nf3"
    assert spark.range(1).select(sequences.board_key(F.lit("a/b w KQkq e3 0 1"))).first()[0] == "a/b w KQkq"


def test_transpositions_merge(spark):
    rows = []
    for i in range(6):
        rows.append(raw_row(i, movetext="1. Nf3 d5 2. d4 Nf6 1-0", White="w", WhiteElo="2500" if i == 0 else "1500"))
        rows.append(raw_row(100 + i, movetext="1. d4 { x } d5 2. Nf3 Nf6 1/2-1/2", Result="0-1", WhiteElo="?" if i == 0 else "1700"))
    rows += [raw_row(200 + i, movetext="1. e4 c5 1-0") for i in range(3)]
    raw = spark.createDataFrame(rows, RAW)
    games = curate.curate_games(raw, "s", "r")
    out = sequences.next_steps(sequences.game_rows(raw, games))
    after = out.where("position = 'b Nf3,d4 d5' and move = 'Nf6'").agg(F.sum("games"), F.sum("white_wins"), F.sum("black_wins"), F.sum("rated_games")).first()
    assert tuple(after) == (12, 6, 6, 11)
    assert out.where("move = 'e4'").isEmpty()
    looked = sequences.explore(out, "b Nf3,d4 d5").collect()
    assert looked[0].move == "Nf6" and looked[0].example_game_id == "00000000" and looked[0].share == 1.0
    by_udf = sequences.next_steps(sequences.game_rows(raw, games), state_fn=lambda s: s.where(s != "Nf3", None))
    assert by_udf.where("position = 'Nf3'").isEmpty() and by_udf.where("position = 'd4'").count() > 0


@pytest.mark.parametrize("plies", [1, 16])
def test_steps_count(spark, plies):
    df = spark.createDataFrame([("g", ["m"] * plies), ("e", []), ("n", None)], "game_id string, steps array<string>")
    assert sequences.steps(df).count() == plies


def random_rows(spark, games=400):
    rng = random.Random(2)
    rows = []
    for i in range(games):
        n = rng.randrange(0, 17)
        made = [rng.choice(["e4", "d4"]) if k < 3 else rng.choice("abcdefgh") + str(k) for k in range(n)]
        rows.append((f"g{i}", rng.choice(["2020-01", "2020-02"]), "blitz", rng.choice(["white", "draw", None]), float(i) if i % 5 else None, 0, made))
    return spark.createDataFrame(rows, "game_id string, month string, speed string, result string, rating double, rating_band int, steps array<string>")


@pytest.mark.parametrize("stride", [1, 3, 4, 16])
def test_level_wise_support_keeps_what_one_pass_does(spark, stride):
    rows = random_rows(spark)
    pairs = sequences.steps(rows)
    plain = pairs.join(sequences.support(pairs, 5), ["month", "prefix_hash", "move"], "left_semi")
    kept = sequences.kept_steps(rows, 5, stride)
    order = ["month", "game_id", "prefix", "move"]
    assert sorted(map(tuple, kept.select(order).collect())) == sorted(map(tuple, plain.select(order).collect()))


def test_equal_sequences_are_grouped_before_their_steps_are_made(spark, monkeypatch):
    """A thousand games of few sequences become steps as those few, and every figure is as if each game had been."""
    rows = random_rows(spark, 60).crossJoin(spark.range(20)).withColumn("game_id", F.concat("game_id", F.lit("-"), "id")).drop("id").where("month = '2020-01'")
    pairs = sequences.steps(rows)
    kept = pairs.join(sequences.support(pairs, 5), ["month", "prefix_hash", "move"], "left_semi").withColumn("position", sequences.built_in_state(F.col("prefix")))
    r = F.col("result")
    cells = kept.groupBy("month", "position", "move", "speed", "rating_band").agg(
        F.count("*"), F.count_if(r == "white"), F.count_if(r == "draw"), F.count_if(r == "black"), F.count("rating"), F.coalesce(F.sum("rating"), F.lit(0.0)), sequences.best_example()
    )
    made, steps = [], sequences.steps
    monkeypatch.setattr(sequences, "steps", lambda rows, *a: made.append(rows.count()) or steps(rows, *a))
    got = sequences.next_steps(rows)
    order = lambda df: sorted(map(str, df.collect()))
    assert order(got) == order(cells.toDF(*got.columns[:-2], "best").select("*", "best.game_id", "best.rating").drop("best").toDF(*got.columns))
    assert max(made) * 10 <= rows.count()


def test_steps_without_support_are_never_made(spark, monkeypatch):
    """The support passes make at most a third of all steps."""
    rows, made = random_rows(spark, 1000).where("size(steps) > 12"), []
    plain = sequences.support
    monkeypatch.setattr(sequences, "support", lambda pairs, least: made.append(pairs.count()) or plain(pairs, least))
    sequences.kept_steps(rows, 5, 2)
    assert sum(made) * 3 <= sequences.steps(rows).count()


def test_replay_derives_states_from_parents(spark):
    replay = sequences.captures_state()
    lines = ["", "e4", "e4 d5", "e4 d5 exd5", "e4 d5 exd5 Qxd5", "e4 d5 exd5 Qxd5 O-O", "d4 d5 e8=Q+"]
    got = {r.prefix: r.position for r in sequences.prefix_states(spark.createDataFrame([(x,) for x in lines], "prefix string"), replay).collect()}
    assert got == {"": "w  ", "e4": "b Pe4 ", "e4 d5": "w Pe4 Pd5", "e4 d5 exd5": "b Pd5,Pe4 ", "e4 d5 exd5 Qxd5": "w Pe4 Qd5", "e4 d5 exd5 Qxd5 O-O": "b Pe4 Qd5", "d4 d5 e8=Q+": None}
    calls = F.pandas_udf(lambda state, step: (state + step).where(step != "bad", None), "string")
    got = {r.prefix: r.position for r in sequences.prefix_states(spark.createDataFrame([("",), ("a",), ("a bad",), ("a bad c",), ("a b",)], "prefix string"), sequences.Replay(F.lit(">"), calls)).collect()}
    assert got == {"": ">", "a": ">a", "a b": ">ab", "a bad": None, "a bad c": None}
