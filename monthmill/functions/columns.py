"""Column expressions that type raw header text; all stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The vocabulary of game records.
RAW_RESULTS = ["1-0", "0-1", "1/2-1/2", "*"]
RESULT_NAMES = {"1-0": "white", "0-1": "black", "1/2-1/2": "draw"}
TERMINATIONS = ["Normal", "Time forfeit", "Abandoned", "Unterminated", "Insufficient material", "Rules infraction"]
SPEED_ORDER = ["ultrabullet", "bullet", "blitz", "rapid", "classical", "correspondence"]
#: Seconds (base + 40 * increment) below which a game has the speed; beyond the last it is classical.
SPEED_LIMITS = {"ultrabullet": 30, "bullet": 180, "blitz": 480, "rapid": 1500}
MOVES_PER_GAME = 40
LEAST_RATING, MOST_RATING = 400, 4000
EXPLORER_BANDS = [0, 1200, 1600, 2000, 2400]

GAME_ID = r"^https?://[^/]+/([A-Za-z0-9]{8})$"
CLOCK = r"^([0-9]+)\+([0-9]+)$"


def matched(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of a pattern; null where there is no match or the group is empty."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def game_id(site: Column) -> Column:
    return matched(site, GAME_ID)


def event_ref(event: Column, kind: str) -> Column:
    """The id in an event's link, ``.../tournament/ID`` or ``.../swiss/ID``."""
    return matched(event, rf"/{kind}/([A-Za-z0-9]+)")


def tolerant_int(text: Column) -> Column:
    """'+12' is 12; '?', blanks and what overflows are null."""
    return text.try_cast("int")


def moment(day: Column, time: Column) -> Column:
    return F.try_to_timestamp(F.concat_ws(" ", day, time), F.lit("yyyy.MM.dd HH:mm:ss"))


def either(values: dict, key: Column, otherwise: Column | None = None) -> Column:
    """The value for a key; null, or ``otherwise``, for other keys."""
    return F.coalesce(reduce(lambda c, kv: c.when(key == kv[0], F.lit(kv[1])), list(values.items())[1:], F.when(key == next(iter(values)), F.lit(values[next(iter(values))]))), otherwise if otherwise is not None else F.lit(None))


def result_name(raw: Column) -> Column:
    return either(RESULT_NAMES, raw)


def base_seconds(clock: Column) -> Column:
    return F.when(clock.rlike(CLOCK), F.regexp_extract(clock, CLOCK, 1).try_cast("int"))


def increment_seconds(clock: Column) -> Column:
    return F.when(clock.rlike(CLOCK), F.regexp_extract(clock, CLOCK, 2).try_cast("int"))


def speed_of(clock: Column) -> Column:
    """Speed class of 'base+increment'; '-' is correspondence; what cannot be read is null."""
    estimate = base_seconds(clock).cast("long") + MOVES_PER_GAME * increment_seconds(clock).cast("long")
    by_limit = reduce(lambda c, kv: c.when(estimate < kv[1], F.lit(kv[0])), SPEED_LIMITS.items(), F.when(clock == "-", F.lit("correspondence")))
    return by_limit.when(estimate.isNotNull(), F.lit("classical"))


def is_bot(title: Column) -> Column:
    return F.coalesce(title == "BOT", F.lit(False))


def mean_rating(white: Column, black: Column) -> Column:
    return (white + black) / 2


def band(value: Column, width: int) -> Column:
    """Lower bound of the band of this width; null where the value is."""
    return (F.floor(value / width) * width).cast("int")


def explorer_band(rating: Column) -> Column:
    return reduce(lambda c, low: c.when(rating >= low, F.lit(low)), EXPLORER_BANDS[-2::-1], F.when(rating >= EXPLORER_BANDS[-1], F.lit(EXPLORER_BANDS[-1]))).cast("int")


def speed_rank(speed: Column) -> Column:
    """Place of a speed in display order: all first, then fast to slow, unknown last."""
    return either({"all": 0} | {s: i + 1 for i, s in enumerate(SPEED_ORDER)}, speed, F.lit(len(SPEED_ORDER) + 1))
