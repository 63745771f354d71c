"""Schemas of every source and table, as Spark DDL.

Keys found in directory names (``season``, ``game_id``) are declared as STRING, so
partition discovery keeps the leading zeros and prunes directories on them.
"""

MANIFEST = "game_id STRING, tracking_filename STRING, game_date STRING, away STRING, home STRING, season STRING"

_PLAYER = "STRUCT<playerid: BIGINT, firstname: STRING, lastname: STRING, position: STRING>"
_SIDE = f"STRUCT<teamid: BIGINT, abbreviation: STRING, name: STRING, players: ARRAY<{_PLAYER}>>"

# A moment mixes scalars with one array, so its elements are read as VARIANT and decoded by position.
# Reading them as text instead is some ten times slower on a full document.
RAW_MOMENTS = "ARRAY<ARRAY<VARIANT>>"
TRACKING_DOCUMENT = (
    "gamedate STRING, "
    f"events ARRAY<STRUCT<eventId: STRING, home: {_SIDE}, visitor: {_SIDE}, moments: {RAW_MOMENTS}>>, "
    "season STRING, game_id STRING"
)

POSITION = "STRUCT<team_id: BIGINT, player_id: BIGINT, x: DOUBLE, y: DOUBLE, z: DOUBLE>"
MOMENT_STRUCT = (
    "STRUCT<period: INT, moment_id: BIGINT, game_clock: DOUBLE, shot_clock: DOUBLE, "
    f"positions: ARRAY<{POSITION}>>"
)
# The tracking documents, landed once at event grain with typed moments.
TRACKING_EVENT = (
    f"gamedate STRING, event_pos BIGINT, event_id BIGINT, home {_SIDE}, visitor {_SIDE}, "
    f"moments ARRAY<{MOMENT_STRUCT}>, malformed_moments BIGINT, season STRING, game_id STRING"
)

# The play-by-play columns that are used; the files hold more and those pass through as text.
PBP_TYPES = {
    "GAME_ID": "BIGINT",
    "EVENTNUM": "BIGINT",
    "EVENTMSGTYPE": "INT",
    "EVENTMSGACTIONTYPE": "INT",
    "PERIOD": "INT",
    "PCTIMESTRING": "STRING",
    "HOMEDESCRIPTION": "STRING",
    "NEUTRALDESCRIPTION": "STRING",
    "VISITORDESCRIPTION": "STRING",
    **{
        name: kind
        for n in (1, 2, 3)
        for name, kind in (
            (f"PERSON{n}TYPE", "DOUBLE"),
            (f"PLAYER{n}_ID", "BIGINT"),
            (f"PLAYER{n}_NAME", "STRING"),
            (f"PLAYER{n}_TEAM_ID", "DOUBLE"),
        )
    },
}
PBP_LANDED = ", ".join(
    [f"{name} {kind}" for name, kind in PBP_TYPES.items() if name != "GAME_ID"] + ["season STRING", "game_id STRING"]
)
# Rows of season files that were not landed: the columns whose text does not fit, the file, and the row as JSON text.
QUARANTINE = "faults ARRAY<STRING>, source_file STRING, source_text STRING, season STRING, game_id STRING"

MOMENT = (
    "moment_id BIGINT, period INT, game_clock DOUBLE, shot_clock DOUBLE, "
    "ball_x DOUBLE, ball_y DOUBLE, ball_z DOUBLE, season STRING, game_id STRING"
)
PLAYER_LOCATION = (
    "moment_id BIGINT, team_id BIGINT, player_id BIGINT, player_x DOUBLE, player_y DOUBLE, "
    "season STRING, game_id STRING"
)
SHOT_LOCATION = (
    "event_id BIGINT, shot_player_id BIGINT, shot_made_flag BOOLEAN, shooter_x DOUBLE, shooter_y DOUBLE, "
    "ball_x DOUBLE, ball_y DOUBLE, release_game_clock DOUBLE, season STRING, game_id STRING"
)
DIM_PLAYER_RAW = (
    "player_id BIGINT, first_name STRING, last_name STRING, position STRING, season STRING, game_id STRING"
)
DIM_TEAM_RAW = "team_id BIGINT, abbreviation STRING, full_name STRING, season STRING, game_id STRING"
DIM_GAME_RAW = (
    "season_id INT, home_team_id BIGINT, away_team_id BIGINT, game_date DATE, season STRING, game_id STRING"
)
ROSTER_RAW = "season_id INT, team_id BIGINT, player_id BIGINT, season STRING, game_id STRING"

EVENT = (
    "season STRING, game_id STRING, event_id BIGINT, period INT, event_clock_seconds BIGINT, "
    "clock_display STRING, event_type STRING, event_type_code INT, event_action_type INT, "
    "shot_made_flag BOOLEAN, description STRING, event_player_id BIGINT, event_player_name STRING, "
    "event_team_id BIGINT, season_start_year INT"
)
EVENT_PARTICIPANT = (
    "game_id STRING, event_id BIGINT, participant_slot INT, player_id BIGINT, player_name STRING, "
    "team_id BIGINT, role STRING, season_start_year INT"
)
DIM_PLAYER = "player_id BIGINT, first_name STRING, last_name STRING, position STRING"
DIM_TEAM = "team_id BIGINT, abbreviation STRING, full_name STRING, conference STRING"
DIM_GAME = (
    "game_id STRING, season_id INT, home_team_id BIGINT, away_team_id BIGINT, game_date DATE, arena STRING"
)
DIM_SEASON = "season_id INT, season_label STRING, start_date DATE, end_date DATE"
PLAYER_TEAM_SEASON = (
    "player_team_season_id BIGINT, player_id BIGINT, team_id BIGINT, season_id INT, "
    "valid_from DATE, valid_to DATE, is_current BOOLEAN"
)
EVENTS_WITH_LOCATION = (
    "season STRING, game_id STRING, event_id BIGINT, period INT, event_clock_seconds BIGINT, "
    "clock_display STRING, event_type STRING, event_action_type INT, shot_made_flag BOOLEAN, "
    "description STRING, event_player_id BIGINT, event_player_name STRING, event_team_id BIGINT, "
    "shot_player_id BIGINT, shooter_x DOUBLE, shooter_y DOUBLE, ball_x DOUBLE, ball_y DOUBLE, "
    "release_game_clock DOUBLE, has_shot_location BOOLEAN, shot_distance DOUBLE, is_three BOOLEAN, "
    "season_start_year INT"
)
