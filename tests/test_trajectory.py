"""Shot location against a plain search over random windows, and the edges of its limits."""

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rimline import schemas
from rimline.operators import trajectory

EVENTS = f"game_id string, event_pos long, event_id long, moments array<{schemas.MOMENT_STRUCT}>"
SHOTS = "game_id string, event_id long, shot_player_id long, shot_made_flag boolean"
SHOOTER = 11


def frame(clock, ball=None, shooter=None, ts=1):
    positions = []
    if shooter is not None:
        positions.append((1, SHOOTER, *shooter, 0.0))
    if ball is not None:
        positions.append((-1, -1, *ball))
    return (1, ts, clock, 24.0, positions)


def search(window):
    """The expected location, found frame by frame."""

    def place(f, player_id):
        return next((p[2:] for p in f[4] if p[1] == player_id), None)

    at_rim = []
    for i, f in enumerate(window):
        ball = place(f, -1)
        if ball and 8.0 <= ball[2] <= 12.0:
            to_hoop = min(math.hypot(ball[0] - hx, ball[1] - 25.0) for hx in (5.25, 88.75))
            at_rim.append((to_hoop, i))
    if not at_rim:
        return None
    rim_clock = window[min(at_rim)[1]][2]
    held = []
    for i, f in enumerate(window):
        ball, shooter = place(f, -1), place(f, SHOOTER)
        if ball and shooter and 0 <= f[2] - rim_clock <= 2.5:
            held.append((math.hypot(ball[0] - shooter[0], ball[1] - shooter[1]), i))
    if not held:
        return None
    f = window[min(held)[1]]
    return place(f, SHOOTER)[:2] + place(f, -1)[:2] + (f[2],)


def locate(spark, windows):
    """Locations by event id; ``windows`` lists ``(event_pos, event_id, moments)``."""
    events = spark.createDataFrame([("g", p, e, w) for p, e, w in windows], EVENTS)
    ids = sorted({e for _, e, _ in windows}) + [999]
    shots = spark.createDataFrame([("g", e, SHOOTER, True) for e in ids], SHOTS)
    located = trajectory.locate_shots(shots, trajectory.rim_windows(events))
    found = {r.event_id: tuple(r[name] for name in trajectory.LOCATION) for r in located.collect()}
    assert sorted(found) == ids
    return {e: None if v[0] is None else v for e, v in found.items()}


def random_window(rng):
    """Coarse coordinates make ties common; balls, shooters and whole windows go missing."""
    window = []
    clock = 600.0
    for _ in range(rng.choice([0, 1, 5, 40])):
        clock -= rng.choice([0.0, 0.25, 0.5])
        ball = None if rng.random() < 0.15 else (float(rng.randrange(0, 95, 5)), float(rng.randrange(0, 51, 5)), float(rng.randrange(5, 14)))
        shooter = None if rng.random() < 0.2 else (float(rng.randrange(0, 95, 5)), float(rng.randrange(0, 51, 5)))
        window.append(frame(clock, ball, shooter))
    return window


def test_matches_plain_search(spark):
    rng = random.Random(5)
    windows = [(i, i, random_window(rng)) for i in range(400)]
    found = locate(spark, windows)
    expected = {i: search(w) for _, i, w in windows}
    located = [i for i, v in expected.items() if v]
    assert len(located) > 150
    for i, want in expected.items():
        assert (found[i] is None) == (want is None), i
        if want:
            assert found[i] == pytest.approx(want), i
    assert found[999] is None


def test_limits_are_inclusive(spark):
    at = lambda z: [frame(10.0, (5.0, 25.0, z), (6.0, 25.0))]
    back = lambda s: [frame(10.0 + s, (30.0, 25.0, 5.0), (30.0, 25.0)), frame(10.0, (5.0, 25.0, 10.0))]
    found = locate(
        spark,
        [(1, 1, at(8.0)), (2, 2, at(12.0)), (3, 3, at(7.99)), (4, 4, at(12.01)), (5, 5, back(2.5)), (6, 6, back(2.51))],
    )
    assert [found[i] is not None for i in range(1, 7)] == [True, True, False, False, True, False]


def test_first_frame_wins_ties(spark):
    window = [
        frame(11.0, (30.0, 25.0, 6.0), (31.0, 25.0)),
        frame(10.5, (40.0, 25.0, 6.0), (41.0, 25.0)),
        frame(10.0, (5.0, 25.0, 10.0)),
        frame(2.0, (5.0, 25.0, 10.0), (5.0, 25.0)),
    ]
    assert locate(spark, [(1, 1, window)])[1] == (31.0, 25.0, 30.0, 25.0, 11.0)


def test_stopped_clock_admits_frames_after_the_rim(spark):
    window = [
        frame(11.0, (30.0, 25.0, 6.0), (33.0, 25.0)),
        frame(10.0, (5.0, 25.0, 10.0), (33.0, 25.0)),
        frame(10.0, (33.0, 26.0, 3.0), (33.0, 25.0)),
    ]
    assert locate(spark, [(1, 1, window)])[1] == (33.0, 25.0, 33.0, 26.0, 10.0)


def test_unknown_clock_height_and_place_are_skipped(spark):
    window = [
        frame(None, (5.0, 25.0, 10.0), (1.0, 1.0)),
        frame(10.5, (5.0, 25.0, None), (2.0, 2.0)),
        frame(10.5, (None, 25.0, 10.0), (3.0, 3.0)),
        frame(10.0, (6.0, 25.0, 10.0), (40.0, 25.0)),
    ]
    assert locate(spark, [(1, 1, window)])[1] == (2.0, 2.0, 5.0, 25.0, 10.5)


def test_last_listing_counts_even_when_empty(spark):
    good = [frame(10.0, (5.0, 25.0, 10.0), (6.0, 25.0))]
    found = locate(spark, [(0, 1, good), (1, 1, None), (2, 2, None), (3, 2, good), (4, 3, [])])
    assert found[1] is None and found[2] is not None and found[3] is None


def test_repeated_shots_are_kept(spark):
    events = spark.createDataFrame([("g", 0, 1, [frame(10.0, (5.0, 25.0, 10.0), (6.0, 25.0))])], EVENTS)
    shots = spark.createDataFrame([("g", 1, SHOOTER, True)] * 2 + [("h", 1, SHOOTER, False)], SHOTS)
    located = trajectory.locate_shots(shots, trajectory.rim_windows(events))
    assert rows(located, "game_id", "shooter_x") == [("g", 6.0), ("g", 6.0), ("h", None)]


def test_shot_attempts(spark):
    pbp = spark.createDataFrame(
        [(1, 1, 4.0, 11), (2, 2, 5.0, 12), (3, 1, 2.0, 13), (4, 3, 4.0, 14), (5, None, 4.0, 15), (6, 1, None, 16)],
        "EVENTNUM long, EVENTMSGTYPE int, PERSON1TYPE double, PLAYER1_ID long",
    )
    shots = trajectory.shot_attempts(pbp, F.lit("g"))
    assert rows(shots) == [("g", 1, 11, True), ("g", 2, 12, False)]
