"""The mart's geometry, the serving queries and the quality checks."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rimline import schemas
from rimline.functions import court
from rimline.operators import quality
from rimline.plans import gold, serving


def located(spark, *places):
    df = spark.createDataFrame(list(places), "x double, y double")
    measured = df.withColumn("d", court.hoop_distance(F.col("x"), F.col("y")))
    return [tuple(r) for r in measured.select("d", court.is_three(F.col("d"), F.col("y"))).collect()]


def test_three_point_class(spark):
    found = located(
        spark,
        (5.25, 47.0),  # corner line, exactly 22 ft
        (5.25, 46.9),  # inside the line, below the arc
        (29.0, 25.0),  # exactly on the arc
        (28.9, 25.0),
        (65.0, 25.0),  # arc of the other hoop
        (47.0, 25.0),
        (None, None),
    )
    assert [f[1] for f in found] == [True, False, True, False, True, True, None]
    assert found[0][0] == 22.0 and found[2][0] == 23.75 and found[5][0] == 41.75 and found[6][0] is None


def test_fold(spark):
    df = spark.createDataFrame([(10.0, 5.0), (47.0, 5.0), (47.5, 5.0), (94.0, 50.0)], "shooter_x double, shooter_y double")
    folded = serving.fold_shots(df).select("plot_x", "plot_y").collect()
    assert [tuple(r) for r in folded] == [(10.0, 5.0), (47.0, 5.0), (46.5, 45.0), (0.0, 0.0)]


EVENT_ROWS = [
    # game, event, period, clock, made, text, player
    ("g1", 1, 1, 700, True, "A 3pt Shot", "Ann"),
    ("g1", 2, 1, 650, False, "A Layup", "Ann"),
    ("g1", 3, 2, 700, True, "B 3PT Shot", "Bob"),
    ("g1", 4, 1, 710, None, "rebound", "Cat"),
    ("g1", 5, 1, 705, None, "timeout", None),
    ("g2", 1, 1, 600, False, None, "Ann"),
]
SHOT_ROWS = [
    ("g1", 1, 11, True, 5.25, 48.0, 5.0, 48.0, 699.0),
    ("g1", 2, 11, False, 6.25, 25.0, 6.0, 25.0, 649.0),
    ("g1", 3, 12, True, 88.75, 35.0, 88.0, 35.0, 699.0),
    ("g2", 1, 11, False, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def mart(spark):
    names = "game_id string, event_id long, period int, event_clock_seconds long, shot_made_flag boolean, description string, event_player_name string"
    given = spark.createDataFrame(EVENT_ROWS, names)
    fixed = {
        name: F.lit(None).cast(kind).alias(name)
        for name, kind in (field.split(" ") for field in schemas.EVENT.split(", "))
        if name not in given.columns
    }
    shots = spark.createDataFrame(SHOT_ROWS, "game_id string, " + schemas.SHOT_LOCATION.split(", season")[0])
    return gold.events_with_location(given.select("*", *fixed.values()), shots).cache()


def test_mart_keeps_every_event(mart):
    assert rows(mart, "game_id", "event_id", "has_shot_location", "shot_distance", "is_three") == [
        ("g1", 1, True, 23.0, True),
        ("g1", 2, True, 1.0, False),
        ("g1", 3, True, 10.0, False),
        ("g1", 4, False, None, None),
        ("g1", 5, False, None, None),
        ("g2", 1, False, None, None),
    ]
    assert sorted(mart.columns) == sorted(f.split(" ")[0] for f in schemas.EVENTS_WITH_LOCATION.split(", "))


def test_list_players_order(mart):
    found = serving.list_players(mart, "g1").collect()
    assert [(r.event_player_name, r.located_shots) for r in found] == [("Ann", 2), ("Bob", 1), ("Cat", 0)]
    assert serving.list_players(mart).count() == 4


def test_get_shots_order(mart):
    found = serving.get_shots(mart, "g1").collect()
    assert [(r.period, r.event_player_name, r.is_three) for r in found] == [(1, "Ann", True), (1, "Ann", False), (2, "Bob", False)]
    assert serving.get_shots(mart, "g2").count() == 0


def test_views(mart):
    shots = serving.get_shots(mart, "g1")
    size = lambda *args: serving.view_shots(shots, *args).count()
    assert [size("Ann"), size("Ann", "Made"), size("Ann", "Missed", "3PT"), size("Ann", "All", "2PT"), size(None, "Made")] == [2, 1, 0, 1, 2]
    counts = {(r.event_player_name, r.result, r.shot_type): (r.shown, r.total) for r in serving.view_counts(shots).collect()}
    assert len(counts) == 18
    assert counts["Ann", "Missed", "2PT"] == (1, 2) and counts["Bob", "All", "3PT"] == (0, 1)


def test_shooting_lines(mart):
    lines = {(r.game_id, r.event_player_name): r.line for r in serving.roster_lines(mart).collect()}
    assert lines == {
        ("g1", "Ann"): "1/2 FG (50%) · 1/1 3PT (100%)",
        ("g1", "Bob"): "1/1 FG (100%) · 0/0 3PT",
        ("g1", "Cat"): "0 located shots in this game",
        ("g2", "Ann"): "0 located shots in this game",
    }
    assert {r.line for r in serving.shooting_line(serving.get_shots(mart)).collect()} < set(lines.values())


def test_percent_halves_round_to_even(spark):
    totals = spark.createDataFrame([(8, 1, 8, 3), (0, 0, 0, 0)], "attempts long, makes long, three_attempts long, three_makes long")
    found = serving.with_percentages(totals).collect()
    assert [(r.fg_pct, r.three_pct) for r in found] == [(12, 38), (None, None)]


def test_list_games(spark, mart):
    games = spark.createDataFrame([("g1", 1, 2, "2015-12-25"), ("g2", 1, 2, "2014-01-01")], "game_id string, home_team_id long, away_team_id long, d string")
    games = games.withColumn("game_date", F.to_date("d")).drop("d")
    teams = spark.createDataFrame([(1, "GSW"), (2, "CLE")], "team_id long, abbreviation string")
    assert [tuple(r) for r in serving.list_games(mart, games, teams).collect()] == [("g1", "CLE @ GSW · 2015-12-25")]
    more = mart.unionByName(mart.where("game_id = 'g1'").withColumn("game_id", F.lit("g2")))
    assert [r.game_id for r in serving.list_games(more, games, teams).collect()] == ["g2", "g1"]


def test_quality(mart):
    assert rows(quality.coverage_by_game(mart)) == [("g1", 3, 3), ("g2", 0, 1)]
    assert rows(quality.geometry_sanity(mart)) == [(round(34 / 3, 6), round(1 / 3, 6), 3)]
    assert rows(quality.three_agreement(mart)) == [(False, False, 1), (True, False, 1), (True, True, 1)]
    keys = quality.key_uniqueness({"mart": (mart.unionByName(mart.limit(1)), ["game_id", "event_id"])})
    assert rows(keys) == [("mart", 7, 6)]


def test_located_rate_is_floored(spark):
    shots = spark.createDataFrame([("g", 1.0), ("g", 1.0), ("g", None)], "game_id string, shooter_x double")
    assert rows(quality.located_rate(shots)) == [("g", 3, 2, 66)]


def test_orphans_and_ids(spark):
    facts = spark.createDataFrame([(1,), (2,), (2,), (None,)], "player_id long")
    dim = spark.createDataFrame([(1,)], "player_id long")
    assert rows(quality.orphans(facts, dim, "player_id")) == [(2,)]
    ids = spark.createDataFrame([(21500438,), (12345678901,)], "GAME_ID long")
    assert rows(quality.overlong_ids(ids)) == [("12345678901",)]
