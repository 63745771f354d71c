"""Teams, players, rosters and games from the event headers of tracking documents."""

from pyspark.sql import DataFrame, functions as F

from rimline.functions.keys import year_of_label
from rimline.operators.ranking import first_per_key


def first_headers(events: DataFrame) -> DataFrame:
    """The header of each game's first event; rosters repeat in every event of a game."""
    headers = events.select("season", "game_id", "gamedate", "event_pos", "home", "visitor")
    return first_per_key(headers, ["game_id"], [F.col("event_pos")]).drop("event_pos")


def games_without_events(manifest: DataFrame, events: DataFrame) -> DataFrame:
    """Manifest games whose tracking document lists no event."""
    return manifest.select("game_id").join(events.select("game_id").distinct(), "game_id", "left_anti")


def team_rows(headers: DataFrame) -> DataFrame:
    """Two rows per header: home and visitor."""
    side = lambda name: F.struct(
        F.col(f"{name}.teamid").alias("team_id"),
        F.col(f"{name}.abbreviation").alias("abbreviation"),
        F.col(f"{name}.name").alias("full_name"),
    )
    return headers.select("season", "game_id", F.inline(F.array(side("home"), side("visitor"))))


def player_rows(headers: DataFrame) -> DataFrame:
    """One row per listed player of either side; no team, as a player's team changes over time."""
    none = F.array().cast("array<struct<playerid: bigint, firstname: string, lastname: string, position: string>>")
    both = F.concat(F.coalesce("home.players", none), F.coalesce("visitor.players", none))
    return headers.select("season", "game_id", F.inline(both)).select(
        "season",
        "game_id",
        F.col("playerid").alias("player_id"),
        F.col("firstname").alias("first_name"),
        F.col("lastname").alias("last_name"),
        "position",
    )


def roster_rows(headers: DataFrame) -> DataFrame:
    """``(season_id, team_id, player_id)``, each player with the side that lists them."""
    side = lambda name: F.struct(
        F.col(f"{name}.teamid").alias("team_id"), F.col(f"{name}.players").alias("players")
    )
    sides = headers.select("season", "game_id", F.inline(F.array(side("home"), side("visitor"))))
    return sides.select(
        "season",
        "game_id",
        year_of_label(F.col("season")).alias("season_id"),
        "team_id",
        F.explode("players.playerid").alias("player_id"),
    )


def game_rows(headers: DataFrame) -> DataFrame:
    """One row per header; the visitor is the away team. A date that cannot be read is NULL."""
    return headers.select(
        "season",
        "game_id",
        year_of_label(F.col("season")).alias("season_id"),
        F.col("home.teamid").alias("home_team_id"),
        F.col("visitor.teamid").alias("away_team_id"),
        F.try_to_date("gamedate").alias("game_date"),
    )
