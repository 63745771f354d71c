"""The registered queries. Each runs library operators over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rimline.functions import keys, play
from rimline.operators import headers, manifest, moments, participants, quality, scd2, trajectory
from rimline.plans import conformed, event, gold, serving
from rimline.sources import files
from testbed import derive

HOME_SIDE = "BUILDING"
BATCH_SEASON = 1999

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# Tables that several queries start from.


def _event(spark, sf_dir):
    return event.event(derive.pbp_raw(spark, sf_dir))


def _moment_rows(spark, sf_dir):
    return moments.moment_rows(derive.tracking_events(spark, sf_dir))


def _moment(spark, sf_dir):
    return moments.moment_table(moments.dedup_moments(_moment_rows(spark, sf_dir)))


def _player_location(spark, sf_dir):
    return moments.player_locations(derive.tracking_events(spark, sf_dir))


def _windows(spark, sf_dir):
    return trajectory.rim_windows(derive.tracking_events(spark, sf_dir))


def _shot_location(spark, sf_dir):
    shots = derive.shots(spark, sf_dir)
    windows = trajectory.shot_windows(derive.tracking_events(spark, sf_dir), shots)
    return trajectory.locate_shots(shots, trajectory.rim_windows(windows))


def _gold(spark, sf_dir):
    return gold.events_with_location(_event(spark, sf_dir), _shot_location(spark, sf_dir))


def _home_manifest(spark, sf_dir):
    return derive.manifest(spark, sf_dir).where(F.col("home") == HOME_SIDE)


def _first_headers(spark, sf_dir):
    return headers.first_headers(derive.headers(spark, sf_dir))


def _dim_player(spark, sf_dir):
    return conformed.dim_player(headers.player_rows(derive.headers(spark, sf_dir)))


def _dim_game(spark, sf_dir):
    return conformed.dim_game(headers.game_rows(derive.headers(spark, sf_dir)))


def _dim_team(spark, sf_dir):
    return conformed.dim_team(derive.dim_team_slices(spark, sf_dir))


def _calendar(spark):
    return conformed.dim_season(spark, derive.season_rows())


def _stints(spark, sf_dir):
    return scd2.open_stints(derive.roster(spark, sf_dir), derive.seasons(spark, sf_dir))


def _loaded(spark, sf_dir):
    return _stints(spark, sf_dir).where(F.col("season_id") < BATCH_SEASON)


def _batch(spark, sf_dir):
    return _stints(spark, sf_dir).where(F.col("season_id") >= BATCH_SEASON)


# Manifest and landing.


@query
def manifest_subset(spark, sf_dir):
    return manifest.manifest_subset(derive.manifest(spark, sf_dir), derive.requested_games(spark, sf_dir))


@query
def manifest_missing(spark, sf_dir):
    return manifest.missing_games(derive.requested_games(spark, sf_dir), derive.manifest(spark, sf_dir))


@query
def pbp_scope_to_manifest(spark, sf_dir):
    return manifest.pbp_of_games(derive.pbp_raw(spark, sf_dir), _home_manifest(spark, sf_dir))


@query
def pbp_games_without_rows(spark, sf_dir):
    return manifest.games_without_rows(_home_manifest(spark, sf_dir), derive.pbp_raw(spark, sf_dir))


@query
def overlong_ids(spark, sf_dir):
    """Game and event number run together, as a faulty feed might send them."""
    pbp = derive.pbp_raw(spark, sf_dir)
    joined = F.concat(F.col("GAME_ID").cast("string"), F.col("EVENTNUM").cast("string")).cast("bigint")
    return quality.overlong_ids(pbp.select(joined.alias("GAME_ID")))


@query
def pbp_typed(spark, sf_dir):
    """Text fields typed: whole numbers in any form, empty text, and text that does not fit."""
    typed = files.typed_pbp(derive.pbp_text(spark, sf_dir))
    return typed.select(
        "GAME_ID", "EVENTNUM", "EVENTMSGTYPE", "PERIOD", "PERSON1TYPE", "PCTIMESTRING", "PLAYER2_ID", "mistyped"
    )


# Play-by-play conform.


@query
def event_conform(spark, sf_dir):
    return _event(spark, sf_dir)


@query
def season_derivation(spark, sf_dir):
    seasoned = event.with_season(derive.pbp_raw(spark, sf_dir))
    label = keys.season_label(F.col("season_start_year"))
    return seasoned.select(
        "game_id",
        F.col("EVENTNUM").alias("event_id"),
        "season_start_year",
        label.alias("season"),
        keys.year_of_label(label).alias("label_year"),
    )


@query
def clock_seconds(spark, sf_dir):
    return derive.pbp_raw(spark, sf_dir).select(
        F.col("EVENTNUM").alias("event_id"),
        F.col("PCTIMESTRING").alias("clock_display"),
        play.clock_seconds(F.col("PCTIMESTRING")).alias("event_clock_seconds"),
    )


@query
def event_type_decode(spark, sf_dir):
    code = F.col("EVENTMSGTYPE")
    return derive.pbp_raw(spark, sf_dir).select(
        F.col("EVENTNUM").alias("event_id"),
        code.alias("event_type_code"),
        play.event_type(code).alias("event_type"),
        play.shot_made_flag(code).alias("shot_made_flag"),
    )


@query
def actor_conform(spark, sf_dir):
    person = F.col("PERSON1TYPE")
    return derive.pbp_raw(spark, sf_dir).select(
        F.col("EVENTNUM").alias("event_id"),
        play.player_key(person, F.col("PLAYER1_ID")).alias("event_player_id"),
        play.team_key(person, F.col("PLAYER1_ID"), F.col("PLAYER1_TEAM_ID")).alias("event_team_id"),
    )


@query
def participant_slots(spark, sf_dir):
    slots = participants.unpivot_players(event.with_season(derive.pbp_raw(spark, sf_dir)), ["game_id", "EVENTNUM"])
    return slots.select(
        "game_id", F.col("EVENTNUM").alias("event_id"), "participant_slot", "player_id", "player_name", "person_type"
    )


@query
def event_participant(spark, sf_dir):
    return event.event_participant(derive.pbp_raw(spark, sf_dir))


# Tracking reshape.


@query
def moment_decode(spark, sf_dir):
    """Variant moments decoded by position, one row per listed moment."""
    decoded = moments.moment_rows(moments.decode_events(derive.raw_tracking_events(spark, sf_dir)))
    return decoded.select(
        "game_id",
        "event_pos",
        F.col("moment_pos").cast("bigint").alias("moment_pos"),
        "moment_id",
        "period",
        "game_clock",
        "shot_clock",
        F.col("ball.x").alias("ball_x"),
        F.col("ball.y").alias("ball_y"),
        F.col("ball.z").alias("ball_z"),
        F.size("positions").alias("positions"),
    )


@query
def malformed_moments(spark, sf_dir):
    return moments.malformed_counts(moments.decode_events(derive.raw_tracking_events(spark, sf_dir)))


@query
def dropped_null_ts(spark, sf_dir):
    return moments.null_timestamp_counts(derive.tracking_events(spark, sf_dir))


@query
def moment_dedup(spark, sf_dir):
    return _moment(spark, sf_dir)


@query
def player_location(spark, sf_dir):
    return _player_location(spark, sf_dir)


@query
def moment_players(spark, sf_dir):
    return moments.moment_players(_moment(spark, sf_dir), _player_location(spark, sf_dir))


@query
def event_window_last_wins(spark, sf_dir):
    last = moments.last_listing(derive.tracking_events(spark, sf_dir))
    listed = F.coalesce("moments", F.array().cast(last.schema["moments"].dataType))
    return last.select(
        "game_id",
        "event_id",
        "event_pos",
        F.size(listed).alias("n_moments"),
        F.get(listed, 0)["game_clock"].alias("first_clock"),
    )


# Headers.


@query
def team_rows(spark, sf_dir):
    return headers.team_rows(_first_headers(spark, sf_dir))


@query
def player_rows(spark, sf_dir):
    return headers.player_rows(_first_headers(spark, sf_dir))


@query
def roster_rows(spark, sf_dir):
    return headers.roster_rows(_first_headers(spark, sf_dir))


@query
def game_rows(spark, sf_dir):
    return headers.game_rows(_first_headers(spark, sf_dir))


@query
def games_without_events(spark, sf_dir):
    return headers.games_without_events(derive.manifest(spark, sf_dir), derive.headers(spark, sf_dir))


# Trajectory.


@query
def rim_frame(spark, sf_dir):
    return _windows(spark, sf_dir).select(
        "game_id",
        "event_id",
        F.col("rim.dist").alias("rim_dist"),
        F.col("rim.idx").cast("bigint").alias("rim_idx"),
        F.col("rim.clock").alias("rim_clock"),
    )


@query
def release_frame(spark, sf_dir):
    matched = derive.shots(spark, sf_dir).join(_windows(spark, sf_dir), ["game_id", "event_id"])
    released = matched.withColumn("r", trajectory.release_frame(F.col("candidates"), F.col("shot_player_id")))
    return released.select(
        "game_id",
        "event_id",
        F.col("r.dist").alias("release_dist"),
        F.col("r.idx").cast("bigint").alias("release_idx"),
        F.col("r.release_game_clock").alias("release_game_clock"),
    )


@query
def shot_location(spark, sf_dir):
    return _shot_location(spark, sf_dir)


@query
def gold_events(spark, sf_dir):
    return _gold(spark, sf_dir)


@query
def fold_shots(spark, sf_dir):
    folded = serving.fold_shots(_gold(spark, sf_dir).where("has_shot_location"))
    return folded.select("game_id", "event_id", "shooter_x", "shooter_y", "plot_x", "plot_y")


# Dimensions and roster history.


@query
def dim_player(spark, sf_dir):
    return _dim_player(spark, sf_dir)


@query
def dim_team(spark, sf_dir):
    return conformed.dim_team(headers.team_rows(derive.headers(spark, sf_dir)))


@query
def dim_game(spark, sf_dir):
    return _dim_game(spark, sf_dir)


@query
def dim_season(spark, sf_dir):
    """Calendar rows of the known seasons that have a roster."""
    return _calendar(spark).join(derive.roster(spark, sf_dir).select("season_id").distinct(), "season_id", "left_semi")


@query
def roster_season_orphans(spark, sf_dir):
    """Seasons of roster rows that the literal calendar lacks."""
    orphans = scd2.season_orphans(derive.roster(spark, sf_dir), _calendar(spark))
    return orphans.groupBy("season_id").agg(F.count("*").alias("n"))


@query
def player_team_season(spark, sf_dir):
    return _stints(spark, sf_dir)


@query
def scd2_expire(spark, sf_dir):
    return scd2.expired(_loaded(spark, sf_dir), _batch(spark, sf_dir))


@query
def scd2_insert(spark, sf_dir):
    """A batch that re-sends the whole history: only the new seasons are inserted."""
    return scd2.inserted(_loaded(spark, sf_dir), _stints(spark, sf_dir))


@query
def scd2_apply(spark, sf_dir):
    return scd2.apply_batch(_loaded(spark, sf_dir), _batch(spark, sf_dir))


@query
def scd2_inverted(spark, sf_dir):
    """Re-sending the history moves players inside their own seasons, so some stints end too early."""
    return scd2.inverted_stints(scd2.apply_batch(_loaded(spark, sf_dir), _stints(spark, sf_dir)))


# Serving, for all games at once.


@query
def list_games(spark, sf_dir):
    return serving.list_games(_gold(spark, sf_dir), _dim_game(spark, sf_dir), _dim_team(spark, sf_dir))


@query
def list_players(spark, sf_dir):
    return serving.list_players(_gold(spark, sf_dir))


@query
def get_shots(spark, sf_dir):
    return serving.get_shots(_gold(spark, sf_dir))


@query
def shot_view_filter(spark, sf_dir):
    return serving.view_shots(serving.get_shots(_gold(spark, sf_dir)), result="Made", shot_type="3PT")


@query
def shot_view_counts(spark, sf_dir):
    return serving.view_counts(serving.get_shots(_gold(spark, sf_dir)))


@query
def shooting_line(spark, sf_dir):
    return serving.shooting_line(serving.get_shots(_gold(spark, sf_dir)))


@query
def roster_lines(spark, sf_dir):
    return serving.roster_lines(_gold(spark, sf_dir))


# Serving of one game, and the order of lists as a column.


@query
def list_players_of_game(spark, sf_dir):
    return serving.list_players(_gold(spark, sf_dir), derive.SERVED_GAME)


@query
def get_shots_of_game(spark, sf_dir):
    return serving.get_shots(_gold(spark, sf_dir), derive.SERVED_GAME)


@query
def games_in_order(spark, sf_dir):
    return serving.games_in_order(_gold(spark, sf_dir), _dim_game(spark, sf_dir), _dim_team(spark, sf_dir))


@query
def players_in_order(spark, sf_dir):
    return serving.players_in_order(_gold(spark, sf_dir))


@query
def shots_in_order(spark, sf_dir):
    return serving.shots_in_order(_gold(spark, sf_dir)).select("game_id", "event_id", "place")


# Quality.


@query
def event_type_histogram(spark, sf_dir):
    return quality.event_type_histogram(_event(spark, sf_dir))


@query
def coverage_by_game(spark, sf_dir):
    return quality.coverage_by_game(_gold(spark, sf_dir))


@query
def geometry_sanity(spark, sf_dir):
    return quality.geometry_sanity(_gold(spark, sf_dir))


@query
def three_agreement(spark, sf_dir):
    return quality.three_agreement(_gold(spark, sf_dir))


@query
def located_rate(spark, sf_dir):
    return quality.located_rate(_shot_location(spark, sf_dir))


@query
def key_uniqueness(spark, sf_dir):
    return quality.key_uniqueness(
        {
            "event": (_event(spark, sf_dir), ["game_id", "event_id"]),
            "event_participant": (event.event_participant(derive.pbp_raw(spark, sf_dir)), ["game_id", "event_id", "player_id"]),
            "moment_listing": (_moment_rows(spark, sf_dir).where("moment_id IS NOT NULL"), ["game_id", "moment_id"]),
            "moment": (_moment(spark, sf_dir), ["game_id", "moment_id"]),
            "dim_game": (_dim_game(spark, sf_dir), ["game_id"]),
            "roster": (derive.roster(spark, sf_dir), ["season_id", "team_id", "player_id"]),
        }
    )


@query
def fk_orphans(spark, sf_dir):
    return quality.orphans(_player_location(spark, sf_dir), _dim_player(spark, sf_dir), "player_id")


@query
def tracking_row_counts(spark, sf_dir):
    return quality.row_counts(
        {"moment": _moment(spark, sf_dir), "player_location": _player_location(spark, sf_dir)}
    )


@query
def header_row_counts(spark, sf_dir):
    first = _first_headers(spark, sf_dir)
    return quality.row_counts(
        {
            "dim_player": headers.player_rows(first),
            "dim_team": headers.team_rows(first),
            "roster": headers.roster_rows(first),
        }
    )
