"""The event-grain mart: every event, shots with their location and geometry."""

from pyspark.sql import DataFrame, functions as F

from rimline.functions.court import hoop_distance, is_three
from rimline.operators.trajectory import LOCATION

EVENT_COLUMNS = (
    "season_start_year",
    "season",
    "game_id",
    "event_id",
    "period",
    "event_clock_seconds",
    "clock_display",
    "event_type",
    "event_action_type",
    "shot_made_flag",
    "description",
    "event_player_id",
    "event_player_name",
    "event_team_id",
)


def events_with_location(event: DataFrame, shot_location: DataFrame) -> DataFrame:
    located = shot_location.select("game_id", "event_id", "shot_player_id", *LOCATION)
    joined = event.select(*EVENT_COLUMNS).join(located, ["game_id", "event_id"], "left")
    measured = joined.select(
        *EVENT_COLUMNS,
        "shot_player_id",
        *LOCATION,
        F.col("shooter_x").isNotNull().alias("has_shot_location"),
        hoop_distance(F.col("shooter_x"), F.col("shooter_y")).alias("shot_distance"),
    )
    return measured.withColumn("is_three", is_three(F.col("shot_distance"), F.col("shooter_y")))
