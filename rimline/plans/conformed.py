"""Conformed dimensions from per-game slices.

Each dimension keeps one row per key. Where slices disagree the order below decides; the last
order columns make it total, so the result never depends on how rows are spread.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from rimline.constants import SEASONS
from rimline.operators.ranking import first_per_key
from rimline.schemas import DIM_SEASON


def _ordered(*names: str) -> list:
    return [F.col(name).asc_nulls_first() for name in names]


def dim_player(slices: DataFrame) -> DataFrame:
    rows = slices.select("player_id", "first_name", "last_name", "position")
    return first_per_key(rows, ["player_id"], _ordered("last_name", "first_name", "position"))


def dim_team(slices: DataFrame) -> DataFrame:
    rows = slices.select("team_id", "abbreviation", "full_name")
    kept = first_per_key(rows, ["team_id"], _ordered("abbreviation", "full_name"))
    return kept.withColumn("conference", F.lit(None).cast("string"))


def dim_game(slices: DataFrame) -> DataFrame:
    rows = slices.select("game_id", "season_id", "home_team_id", "away_team_id", "game_date")
    order = _ordered("game_date", "season_id", "home_team_id", "away_team_id")
    return first_per_key(rows, ["game_id"], order).withColumn("arena", F.lit(None).cast("string"))


def dim_season(spark: SparkSession, seasons=SEASONS) -> DataFrame:
    """Season calendar from literal rows ``(id, label, start, end)``."""
    rows = ", ".join(f"({i}, '{label}', DATE '{start}', DATE '{end}')" for i, label, start, end in seasons)
    names = ", ".join(field.split()[0] for field in DIM_SEASON.split(", "))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})")
