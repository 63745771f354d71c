"""Serving queries on the mart.

Queries take one game, or ``game_id=None`` for all games at once; results carry ``game_id``.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from rimline.functions.court import fold_x, fold_y
from rimline.functions.keys import game_label, season_start_year

RESULTS = ("All", "Made", "Missed")
SHOT_TYPES = ("All", "2PT", "3PT")


def _of_game(gold: DataFrame, game_id: str | None) -> DataFrame:
    """One game's rows; the season in its id skips the directories of all other seasons."""
    if game_id is None:
        return gold
    # Folded to a literal, so it prunes directories; an id without a season finds its rows by the id alone.
    in_season = F.col("season_start_year") == season_start_year(F.lit(game_id)) if game_id[3:5].isdigit() else F.lit(True)
    return gold.where(in_season & (F.col("game_id") == game_id))


# The order of each list; ``place`` columns number rows by the same.
GAME_ORDER = ("game_date", "game_id")
PLAYER_ORDER = ("-located_shots", "event_player_name")
SHOT_ORDER = ("period", "-event_clock_seconds", "event_id")


def _order(names: tuple[str, ...]) -> list[Column]:
    """Columns of an order; a minus means descending."""
    return [F.desc(n[1:]) if n.startswith("-") else F.asc(n) for n in names]


def _numbered(df: DataFrame, within: str, order) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(within).orderBy(*_order(order))).cast("bigint"))


def _labelled_games(gold: DataFrame, dim_game: DataFrame, dim_team: DataFrame) -> DataFrame:
    """The mart shrinks to one row per game before it meets the dimensions."""
    located = gold.where("has_shot_location").select("game_id").distinct()
    team = dim_team.select("team_id", "abbreviation")
    home = team.select(F.col("team_id").alias("home_team_id"), F.col("abbreviation").alias("home"))
    away = team.select(F.col("team_id").alias("away_team_id"), F.col("abbreviation").alias("away"))
    met = located.join(dim_game, "game_id").join(home, "home_team_id").join(away, "away_team_id")
    return met.withColumn("label", game_label(F.col("away"), F.col("home"), F.col("game_date")))


def list_games(gold: DataFrame, dim_game: DataFrame, dim_team: DataFrame) -> DataFrame:
    """Games with a located shot, oldest first, labelled 'AWAY @ HOME · DATE'."""
    return _labelled_games(gold, dim_game, dim_team).orderBy(*_order(GAME_ORDER)).select("game_id", "label")


def games_in_order(gold: DataFrame, dim_game: DataFrame, dim_team: DataFrame) -> DataFrame:
    """The listed games with their place in their season."""
    games = _numbered(_labelled_games(gold, dim_game, dim_team), "season_id", GAME_ORDER)
    return games.select("game_id", "label", "season_id", "place")


def _actors(gold: DataFrame, game_id: str | None) -> DataFrame:
    acted = _of_game(gold, game_id).where("event_player_name IS NOT NULL")
    return acted.groupBy("game_id", "event_player_name").agg(F.count_if("has_shot_location").alias("located_shots"))


def list_players(gold: DataFrame, game_id: str | None = None) -> DataFrame:
    """Everyone who acted in a game, most located shots first; grouped by name."""
    return _actors(gold, game_id).orderBy("game_id", *_order(PLAYER_ORDER))


def players_in_order(gold: DataFrame, game_id: str | None = None) -> DataFrame:
    """The listed players with their place in their game."""
    return _numbered(_actors(gold, game_id), "game_id", PLAYER_ORDER)


def get_shots(gold: DataFrame, game_id: str | None = None) -> DataFrame:
    """Located shots in playing order."""
    shots = _of_game(gold, game_id).where("has_shot_location")
    return shots.orderBy("game_id", *_order(SHOT_ORDER)).select(
        "game_id",
        "event_player_name",
        "shooter_x",
        "shooter_y",
        "shot_made_flag",
        "is_three",
        "shot_distance",
        "description",
        "period",
        "clock_display",
    )


def shots_in_order(gold: DataFrame, game_id: str | None = None) -> DataFrame:
    """The mart's located shots with their place in their game."""
    return _numbered(_of_game(gold, game_id).where("has_shot_location"), "game_id", SHOT_ORDER)


def _matches(result: str, shot_type: str) -> Column:
    made, three = F.col("shot_made_flag"), F.col("is_three")
    by_result = {"All": F.lit(True), "Made": made, "Missed": ~made}[result]
    by_type = {"All": F.lit(True), "2PT": ~three, "3PT": three}[shot_type]
    return by_result & by_type


def view_shots(
    shots: DataFrame, player: str | None = None, result: str = "All", shot_type: str = "All"
) -> DataFrame:
    """Shots under a result and a shot-type filter, of one player or of everyone."""
    chosen = shots if player is None else shots.where(F.col("event_player_name") == player)
    return chosen.where(_matches(result, shot_type))


def view_counts(shots: DataFrame) -> DataFrame:
    """'Shown of total' of every view, for every player of every game, in one pass.

    The nine counts of a player are aggregated together and become rows after the shuffle.
    """
    views = [(result, shot_type) for result in RESULTS for shot_type in SHOT_TYPES]
    counted = shots.groupBy("game_id", "event_player_name").agg(
        F.count("*").alias("total"),
        *[F.count_if(_matches(*view)).alias(f"v{i}") for i, view in enumerate(views)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(result).alias("result"), F.lit(shot_type).alias("shot_type"), F.col(f"v{i}").alias("shown")
            )
            for i, (result, shot_type) in enumerate(views)
        ]
    )
    return counted.select("game_id", "event_player_name", F.inline(rows), "total")


def shooting_line(shots: DataFrame, keys: tuple[str, ...] = ("game_id", "event_player_name")) -> DataFrame:
    """Attempts, makes and percentages per player, as numbers and as text; halves round to even."""
    made = F.col("shot_made_flag")
    three = F.col("is_three")
    totals = shots.groupBy(*keys).agg(
        F.count("*").alias("attempts"),
        F.count_if(made).alias("makes"),
        F.count_if(three).alias("three_attempts"),
        F.count_if(three & made).alias("three_makes"),
    )
    return with_percentages(totals)


def _percent(part: str, whole: str) -> Column:
    share = 100 * F.col(part) / F.nullif(F.col(whole), F.lit(0))
    return F.bround(share).cast("bigint")


def with_percentages(totals: DataFrame) -> DataFrame:
    """Add percentages and the text line; no attempts give NULL percentages, never a division by zero."""
    rated = totals.withColumns(
        {"fg_pct": _percent("makes", "attempts"), "three_pct": _percent("three_makes", "three_attempts")}
    )
    field_goals = F.format_string("%d/%d FG (%d%%)", "makes", "attempts", "fg_pct")
    threes = F.when(F.col("three_attempts") == 0, "0/0 3PT").otherwise(
        F.format_string("%d/%d 3PT (%d%%)", "three_makes", "three_attempts", "three_pct")
    )
    text = F.when(F.col("attempts") == 0, "0 located shots in this game").otherwise(
        F.concat(field_goals, F.lit(" · "), threes)
    )
    return rated.withColumn("line", text)


def roster_lines(gold: DataFrame, game_id: str | None = None) -> DataFrame:
    """The shooting line of everyone who acted, those without a located shot included."""
    acted = _of_game(gold, game_id).where("event_player_name IS NOT NULL")
    located = F.col("has_shot_location")
    made, three = located & F.col("shot_made_flag"), located & F.col("is_three")
    totals = acted.groupBy("game_id", "event_player_name").agg(
        F.count_if(located).alias("attempts"),
        F.count_if(made).alias("makes"),
        F.count_if(three).alias("three_attempts"),
        F.count_if(three & made).alias("three_makes"),
    )
    return with_percentages(totals)


def fold_shots(shots: DataFrame) -> DataFrame:
    """Add ``plot_x`` and ``plot_y`` with the far half turned onto the near one."""
    x, y = F.col("shooter_x"), F.col("shooter_y")
    return shots.withColumns({"plot_x": fold_x(x), "plot_y": fold_y(x, y)})
