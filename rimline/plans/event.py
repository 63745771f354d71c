"""Play-by-play rows to the event spine and its participants. Both are narrow: no shuffle."""

from pyspark.sql import DataFrame, functions as F

from rimline.functions import keys, play
from rimline.operators.participants import real_participants, unpivot_players


def with_season(pbp: DataFrame) -> DataFrame:
    """Replace the raw id by the canonical key and add the season start year found in it."""
    keyed = pbp.select(
        keys.canonical_game_id(F.col("GAME_ID")).alias("game_id"),
        *[c for c in pbp.columns if c.upper() not in ("GAME_ID", "SEASON")],
    )
    return keyed.withColumn("season_start_year", keys.season_start_year(F.col("game_id")))


def event(pbp: DataFrame) -> DataFrame:
    """One conformed row per play-by-play row."""
    code, person = F.col("EVENTMSGTYPE"), F.col("PERSON1TYPE")
    return with_season(pbp).select(
        "season_start_year",
        keys.season_label(F.col("season_start_year")).alias("season"),
        "game_id",
        F.col("EVENTNUM").alias("event_id"),
        F.col("PERIOD").alias("period"),
        play.clock_seconds(F.col("PCTIMESTRING")).alias("event_clock_seconds"),
        F.col("PCTIMESTRING").alias("clock_display"),
        play.event_type(code).alias("event_type"),
        code.alias("event_type_code"),
        F.col("EVENTMSGACTIONTYPE").alias("event_action_type"),
        play.shot_made_flag(code).alias("shot_made_flag"),
        F.coalesce("HOMEDESCRIPTION", "VISITORDESCRIPTION", "NEUTRALDESCRIPTION").alias("description"),
        play.player_key(person, F.col("PLAYER1_ID")).alias("event_player_id"),
        F.when(play.is_player(person), F.col("PLAYER1_NAME")).alias("event_player_name"),
        play.team_key(person, F.col("PLAYER1_ID"), F.col("PLAYER1_TEAM_ID")).alias("event_team_id"),
    )


def event_participant(pbp: DataFrame) -> DataFrame:
    """One row per real player directly involved in an event."""
    slots = unpivot_players(with_season(pbp), ["season_start_year", "game_id", "EVENTNUM as event_id"])
    return real_participants(slots)
