"""The index of games: what holds after many runs, lost snapshots and broken-off ones, and what a check of a large lake costs."""

import os
import shutil
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rimline.sinks import ledger, tables as sinks

SEASON = "2015-16"


def games(spark, *ids):
    return spark.createDataFrame([(SEASON, g) for g in ids], "season string, game_id string")


def note(spark, root, run, *ids, done=True):
    sinks.note_games(spark, games(spark, *ids), run, root, "silver", ["moment"], done)


def found(spark, root):
    return {r.game_id: (r.run, r.done) for r in ledger.lines(spark, root, "silver", "moment").collect()}


def index(root, *parts):
    return os.path.join(root, "ledger", "silver_moment", *parts)


def names(root, *parts):
    return sorted(os.listdir(index(root, *parts)))


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "lake")


def test_the_latest_line_holds(spark, root):
    assert found(spark, root) == {} and sinks.pending_games(spark, games(spark, "a"), root, "silver", ["moment"]).count() == 1
    note(spark, root, "r1", "a", "b")
    note(spark, root, "r2", "b")
    note(spark, root, None, "a", done=False)
    assert found(spark, root) == {"a": (None, False), "b": ("r2", True)}
    assert rows(sinks.pending_games(spark, games(spark, "a", "b", "c"), root, "silver", ["moment"]), "game_id") == [("a",), ("c",)]


@pytest.fixture()
def compacted(spark, root, monkeypatch):
    """A lake after two snapshots and two more runs, and what its index says."""
    monkeypatch.setattr(ledger, "COMPACT_AFTER", 4)
    expected = {}
    for k in range(10):
        own = [f"g{k}", f"g{k % 3}"]
        note(spark, root, f"r{k}", *own)
        expected |= {g: (f"r{k}", True) for g in own}
    assert len(names(root, "snapshot")) == 2 and len(names(root, "log")) == 6
    assert found(spark, root) == expected
    return expected


def test_log_and_snapshots_stay_small(spark, root, compacted):
    for k in range(10, 24):
        note(spark, root, f"r{k}", "z")
    assert len(names(root, "snapshot")) <= 2 and len(names(root, "log")) <= 8
    assert found(spark, root) == compacted | {"z": ("r23", True)}


def test_a_lost_snapshot_loses_no_line(spark, root, compacted):
    shutil.rmtree(index(root, "snapshot", names(root, "snapshot")[-1]))
    assert found(spark, root) == compacted


def test_a_snapshot_that_was_never_finished_is_not_read(spark, root, compacted):
    newest = index(root, "snapshot", names(root, "snapshot")[-1], "lines")
    os.remove(os.path.join(newest, "_SUCCESS"))
    some = next(f for f in os.listdir(newest) if f.endswith(".parquet"))
    os.remove(os.path.join(newest, some))
    assert found(spark, root) == compacted
    for k in range(10, 20):  # Later snapshots are whole again.
        note(spark, root, f"r{k}", "z")
    assert found(spark, root) == compacted | {"z": ("r19", True)}


def test_a_compaction_that_stops_before_it_deletes_changes_nothing(spark, root, compacted, monkeypatch):
    monkeypatch.setattr(ledger, "delete", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        ledger.compact(spark, root, "silver", "moment")
    assert found(spark, root) == compacted


def test_a_batch_without_its_marker_is_not_read(spark, root):
    note(spark, root, "r1", "a")
    note(spark, root, "r2", "a", "b")
    os.remove(index(root, "log", names(root, "log")[-1], "_SUCCESS"))
    assert found(spark, root) == {"a": ("r1", True)}


def moment_rows(spark, run, *ids):
    return games(spark, *ids).select("season", "game_id", F.lit(run).alias("text"))


def read(spark, root, wanted=None):
    return sinks.read_games(spark, root, "silver", "moment", "text STRING, season STRING, game_id STRING", wanted)


def test_readers_follow_the_index(spark, root):
    path = sinks.dataset_path(root, "silver", "moment")
    assert read(spark, root).count() == 0
    for run, ids in (("r1", ("a", "b")), ("r2", ("b", "c"))):
        sinks.write_games(moment_rows(spark, run, *ids), path, run)
        assert rows(sinks.written_games(spark, path, run), "game_id") == [(g,) for g in ids]
        note(spark, root, run, *ids, *(["empty"] if run == "r2" else []))
    sinks.write_games(moment_rows(spark, "broken", "a", "d"), path, "broken")
    assert rows(read(spark, root), "game_id", "text") == [("a", "r1"), ("b", "r2"), ("c", "r2")]
    one = read(spark, root, games(spark, "c"))
    assert rows(one, "text") == [("r2",)] and all("run=r2" in f for f in one.inputFiles() if "/silver/moment/" in f)
    note(spark, root, None, "a", done=False)
    assert rows(read(spark, root), "game_id") == [("b",), ("c",)]
    assert sinks.sweep(spark, root, "silver", "moment") == ["run=broken", "run=r1"]
    assert rows(read(spark, root), "game_id", "text") == [("b", "r2"), ("c", "r2")]


def test_a_check_of_a_hundred_thousand_games(spark, root):
    """From the index alone: there isn't a single game directory."""
    every = spark.range(100_000).select(F.lit(SEASON).alias("season"), F.format_string("g%06d", "id").alias("game_id"))
    sinks.note_games(spark, every.where("game_id < 'g099990'"), "r1", root, "silver", ["moment", "location"])
    for k in range(5):
        sinks.note_games(spark, games(spark, f"g09999{k}"), f"r2{k}", root, "silver", ["moment"])
    ledger.compact(spark, root, "silver", "location")
    started = time.perf_counter()
    pending = sinks.pending_games(spark, every, root, "silver", ["moment", "location"])
    assert rows(pending, "game_id") == [(f"g09999{k}",) for k in range(10)]
    assert time.perf_counter() - started < 5
