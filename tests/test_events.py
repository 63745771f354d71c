"""Play-by-play conform and its column functions."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rimline.functions import keys, play
from rimline.plans import event as events
from rimline.schemas import PBP_TYPES

SCHEMA = ", ".join(f"{name} {kind}" for name, kind in PBP_TYPES.items())


def pbp(spark, *changes):
    base = dict.fromkeys(PBP_TYPES)
    base.update(GAME_ID=21500438, EVENTNUM=1, EVENTMSGTYPE=1, PERIOD=1, PCTIMESTRING="11:42")
    return spark.createDataFrame([tuple({**base, **change}.values()) for change in changes], SCHEMA)


def values(spark, kind, items, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_clock(spark):
    texts = ["11:42", "0:05", "12:00", None, "", "720", "n/a", "x:30", "7:yy", "1:02:03"]
    assert values(spark, "string", texts, play.clock_seconds) == [702, 5, 720, None, None, None, None, None, None, 62]


def test_game_id_and_season(spark):
    ids = [21500438, 29900001, 24900001, 25000001, 20000001]
    padded = values(spark, "long", ids, keys.canonical_game_id)
    assert padded == ["0021500438", "0029900001", "0024900001", "0025000001", "0020000001"]
    years = values(spark, "string", [*padded, "0020x00001", None], keys.season_start_year)
    assert years == [2015, 1999, 2049, 1950, 2000, None, None]
    assert values(spark, "int", [2015, 1999, 2008, None], keys.season_label) == ["2015-16", "1999-00", "2008-09", None]
    assert values(spark, "string", ["2015-16", "1999-00"], keys.year_of_label) == [2015, 1999]


def test_event_types(spark):
    names = values(spark, "int", [1, 2, 3, 10, 13, 14, 17, 18, 19, None], play.event_type)
    assert names == [
        "MADE_SHOT", "MISSED_SHOT", "FREE_THROW", "JUMP_BALL", "PERIOD_END", "OTHER", "OTHER", "INSTANT_REPLAY", "OTHER", "OTHER",
    ]
    assert values(spark, "int", [1, 2, 3, None], play.shot_made_flag) == [True, False, None, None]


def test_whole_ids(spark):
    found = values(spark, "double", [1610612744.0, float("nan"), None, 1.5, float("inf"), 1e30], play.whole_id)
    assert found == [1610612744, None, None, 2, None, None]


def test_stint_key_is_fixed(spark):
    df = spark.range(1).select(keys.stint_key(F.lit(2015), F.lit(1610612744), F.lit(201939)).alias("k"))
    import hashlib

    assert df.first().k == int(hashlib.md5(b"2015|1610612744|201939").hexdigest()[:15], 16)


@pytest.mark.parametrize(
    ("person", "player", "team", "expected"),
    [
        (4.0, 201939, 1610612744.0, (201939, "N", 1610612744)),
        (5.0, 0, float("nan"), (None, "N", None)),
        (2.0, 1610612739, None, (None, None, 1610612739)),
        (3.0, 1610612739, 5.0, (None, None, 1610612739)),
        (0.0, 7, 5.0, (None, None, None)),
        (1.0, 7, 5.0, (None, None, None)),
        (None, 7, 5.0, (None, None, None)),
    ],
)
def test_actor(spark, person, player, team, expected):
    row = pbp(spark, {"PERSON1TYPE": person, "PLAYER1_ID": player, "PLAYER1_NAME": "N", "PLAYER1_TEAM_ID": team})
    assert rows(events.event(row), "event_player_id", "event_player_name", "event_team_id") == [expected]


def test_event_columns_and_description(spark):
    raw = pbp(
        spark,
        {"HOMEDESCRIPTION": "h", "VISITORDESCRIPTION": "v", "NEUTRALDESCRIPTION": "n"},
        {"EVENTNUM": 2, "VISITORDESCRIPTION": "v", "NEUTRALDESCRIPTION": "n", "EVENTMSGTYPE": 18},
        {"EVENTNUM": 3, "NEUTRALDESCRIPTION": "n", "EVENTMSGACTIONTYPE": 9, "EVENTMSGTYPE": 99},
    )
    found = rows(
        events.event(raw),
        "event_id", "season_start_year", "season", "game_id", "description", "event_type", "event_type_code", "event_action_type",
    )
    assert found == [
        (1, 2015, "2015-16", "0021500438", "h", "MADE_SHOT", 1, None),
        (2, 2015, "2015-16", "0021500438", "v", "INSTANT_REPLAY", 18, None),
        (3, 2015, "2015-16", "0021500438", "n", "OTHER", 99, 9),
    ]


def test_repeated_rows_are_kept(spark):
    assert events.event(pbp(spark, {}, {})).count() == 2


def test_participants(spark):
    raw = pbp(
        spark,
        {
            "PERSON1TYPE": 4.0, "PLAYER1_ID": 11, "PLAYER1_NAME": "A", "PLAYER1_TEAM_ID": 100.0,
            "PERSON2TYPE": 5.0, "PLAYER2_ID": 12, "PLAYER2_NAME": "B", "PLAYER2_TEAM_ID": float("nan"),
            "PERSON3TYPE": 3.0, "PLAYER3_ID": 100,
        },
        {"EVENTNUM": 2, "PERSON1TYPE": 2.0, "PLAYER1_ID": 100, "PERSON2TYPE": 0.0, "PLAYER2_ID": 0},
    )
    bridge = events.event_participant(raw)
    assert rows(bridge, "event_id", "participant_slot", "player_id", "player_name", "team_id", "role") == [
        (1, 1, 11, "A", 100, None),
        (1, 2, 12, "B", None, None),
    ]
    assert dict(bridge.dtypes)["participant_slot"] == "int"
    assert dict(bridge.dtypes)["role"] == "string"
