"""Where a shot was released, read off the ball's flight.

A window is one row with its frames in an array, so the search needs no shuffle of frames.
The part that does not depend on the shooter runs first and keeps only the few seconds before
the ball reaches the rim; only these frames are moved to the shots.
"""

from pyspark.sql import Column, DataFrame, functions as F

from rimline.constants import BALL_ID, MADE_CODE, RELEASE_LOOKBACK_S, RIM_Z_HIGH, RIM_Z_LOW
from rimline.functions.court import distance, hoop_distance
from rimline.functions.play import is_shot_by_player
from rimline.operators.moments import last_listing

LOCATION = ("shooter_x", "shooter_y", "ball_x", "ball_y", "release_game_clock")


def _first_position(positions: Column, player_id: Column) -> Column:
    return F.get(F.filter(positions, lambda p: p["player_id"] == player_id), 0)


def ball_frames(moments: Column) -> Column:
    """Frames that show the ball and a clock, numbered in listed order; the others cannot be used."""
    frames = F.transform(
        moments,
        lambda m, i: F.struct(
            i.alias("idx"),
            m["game_clock"].alias("clock"),
            _first_position(m["positions"], F.lit(BALL_ID)).alias("ball"),
            m["positions"].alias("positions"),
        ),
    )
    return F.filter(
        frames,
        lambda f: f["clock"].isNotNull() & f["ball"]["x"].isNotNull() & f["ball"]["y"].isNotNull(),
    )


def rim_frame(frames: Column) -> Column:
    """``(dist, idx, clock)`` of the frame at rim height nearest to a hoop; the first one wins ties.

    NULL when the ball is never at rim height.
    """
    at_rim = F.filter(frames, lambda f: f["ball"]["z"].between(RIM_Z_LOW, RIM_Z_HIGH))
    return F.array_min(
        F.transform(
            at_rim,
            lambda f: F.struct(
                hoop_distance(f["ball"]["x"], f["ball"]["y"]).alias("dist"),
                f["idx"].alias("idx"),
                f["clock"].alias("clock"),
            ),
        )
    )


def frames_before_rim(frames: Column, rim_clock: Column) -> Column:
    """Frames at most the lookback before the rim frame (clocks count down, both ends included).

    They keep what the release search reads: the ball's and the players' place on the floor.
    """
    near = F.filter(frames, lambda f: (f["clock"] - rim_clock).between(0.0, RELEASE_LOOKBACK_S))
    return F.transform(
        near,
        lambda f: F.struct(
            f["idx"].alias("idx"),
            f["clock"].alias("clock"),
            f["ball"]["x"].alias("ball_x"),
            f["ball"]["y"].alias("ball_y"),
            F.transform(
                F.filter(f["positions"], lambda p: p["player_id"] != BALL_ID),
                lambda p: F.struct(p["player_id"].alias("player_id"), p["x"].alias("x"), p["y"].alias("y")),
            ).alias("players"),
        ),
    )


def release_frame(candidates: Column, shooter_id: Column) -> Column:
    """The candidate with the ball nearest to the shooter, first one on ties; NULL without any."""
    seen = F.filter(
        F.transform(
            candidates,
            lambda f: F.struct(f.alias("f"), _first_position(f["players"], shooter_id).alias("p")),
        ),
        lambda s: s["p"]["x"].isNotNull() & s["p"]["y"].isNotNull(),
    )
    return F.array_min(
        F.transform(
            seen,
            lambda s: F.struct(
                distance(s["f"]["ball_x"], s["f"]["ball_y"], s["p"]["x"], s["p"]["y"]).alias("dist"),
                s["f"]["idx"].alias("idx"),
                s["p"]["x"].alias("shooter_x"),
                s["p"]["y"].alias("shooter_y"),
                s["f"]["ball_x"].alias("ball_x"),
                s["f"]["ball_y"].alias("ball_y"),
                s["f"]["clock"].alias("release_game_clock"),
            ),
        )
    )


def shot_windows(events: DataFrame, shots: DataFrame) -> DataFrame:
    """The event windows of shots; most events are none, and their frames need no search.

    Only the shots' keys meet the windows.
    """
    keys = shots.select("game_id", "event_id").distinct()
    return events.join(keys, ["game_id", "event_id"], "left_semi")


def rim_windows(events: DataFrame) -> DataFrame:
    """Event windows -> rim frame and release candidates, the last listing of an event winning."""
    framed = events.select(
        "game_id",
        "event_id",
        "event_pos",
        ball_frames(F.coalesce("moments", F.array().cast(events.schema["moments"].dataType))).alias("frames"),
    )
    rimmed = framed.withColumn("rim", rim_frame(F.col("frames")))
    scoped = rimmed.select(
        "game_id",
        "event_id",
        "event_pos",
        "rim",
        frames_before_rim(F.col("frames"), F.col("rim.clock")).alias("candidates"),
    )
    return last_listing(scoped).drop("event_pos")


def shot_attempts(pbp: DataFrame, game_id: Column, *keep: str) -> DataFrame:
    """Field-goal attempts by a real player; ``keep`` names further columns to carry along."""
    return pbp.where(is_shot_by_player(F.col("EVENTMSGTYPE"), F.col("PERSON1TYPE"))).select(
        game_id.alias("game_id"),
        F.col("EVENTNUM").alias("event_id"),
        F.col("PLAYER1_ID").alias("shot_player_id"),
        (F.col("EVENTMSGTYPE") == MADE_CODE).alias("shot_made_flag"),
        *keep,
    )


def locate_shots(shots: DataFrame, windows: DataFrame) -> DataFrame:
    """Every shot with its release position; shots that cannot be located keep NULLs."""
    matched = shots.join(windows.select("game_id", "event_id", "candidates"), ["game_id", "event_id"], "left")
    released = matched.withColumn("release", release_frame(F.col("candidates"), F.col("shot_player_id")))
    return released.select(*shots.columns, *[f"release.{name}" for name in LOCATION])
