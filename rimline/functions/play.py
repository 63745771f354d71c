"""Play-by-play fields: clock, event type, actor and team. All are built-in expressions."""

from functools import reduce

from pyspark.sql import Column, functions as F

from rimline.constants import (
    EVENT_TYPES,
    MADE_CODE,
    MISSED_CODE,
    OTHER_EVENT,
    PLAYER_TYPES,
    TEAM_TYPES,
)


def clock_seconds(clock: Column) -> Column:
    """'MM:SS' as seconds left in the period; anything else gives NULL."""
    parts = F.split(clock, ":")
    return F.get(parts, 0).try_cast("bigint") * 60 + F.get(parts, 1).try_cast("bigint")


def event_type(code: Column) -> Column:
    """Name of an event code; unknown and missing codes are OTHER."""
    branches = reduce(
        lambda chain, item: chain.when(code == item[0], item[1]),
        EVENT_TYPES.items(),
        F,
    )
    return branches.otherwise(OTHER_EVENT)


def shot_made_flag(code: Column) -> Column:
    """True for a made, false for a missed field goal, NULL for all else."""
    return F.when(code == MADE_CODE, True).when(code == MISSED_CODE, False)


def is_player(person_type: Column) -> Column:
    return person_type.isin(*PLAYER_TYPES)


def is_team(person_type: Column) -> Column:
    return person_type.isin(*TEAM_TYPES)


def is_shot_by_player(code: Column, person_type: Column) -> Column:
    """A field-goal attempt with a real shooter."""
    return code.isin(MADE_CODE, MISSED_CODE) & is_player(person_type)


def player_key(person_type: Column, player_id: Column) -> Column:
    """The player id where the slot holds a real player; 0 means nobody."""
    return F.when(is_player(person_type), F.nullif(player_id, F.lit(0)))


def whole_id(value: Column) -> Column:
    """A floating id as BIGINT, rounded half away from zero; NaN and overflow give NULL."""
    return F.round(value).try_cast("bigint")


def team_key(person_type: Column, player_id: Column, player_team_id: Column) -> Column:
    """The player's team for player rows, the id in the player slot for team rows."""
    return F.when(is_player(person_type), whole_id(player_team_id)).when(is_team(person_type), player_id)


def contains_ignoring_case(text: Column, part: str) -> Column:
    return F.contains(F.lower(text), F.lit(part.lower()))
