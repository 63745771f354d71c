"""Roster history by buckets of players, against the operators over the whole history."""

import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rimline import schemas
from rimline.operators import scd2
from rimline.plans import conformed, jobs
from rimline.sinks import history, ledger

YEARS = range(2010, 2016)
CALENDAR = tuple((y, str(y), f"{y}-10-27", f"{y + 1}-06-19") for y in YEARS)


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "lake")


def roster(spark, found):
    return spark.createDataFrame(found, "season_id int, team_id long, player_id long")


def stamps(root):
    top = os.path.join(root, "conformed", history.DATASET)
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")}


def test_batches_equal_the_operators_over_everything(spark, root):
    rng = random.Random(7)
    seasons = conformed.dim_season(spark, CALENDAR)
    whole = spark.createDataFrame([], schemas.PLAYER_TEAM_SEASON)
    for year in YEARS:
        found = [(year, rng.randrange(4), p) for p in range(60) if rng.random() < 0.5]
        found += [(year, 9, 3), (year, 8, 3)] if year != 2012 else []
        batch = roster(spark, found)
        for _ in range(2 if year == 2012 else 1):  # A repeated batch changes nothing more.
            jobs.advance_history(spark, root, batch, CALENDAR)
        whole = scd2.apply_batch(whole, scd2.open_stints(batch, seasons))
        whole = spark.createDataFrame(whole.collect(), schemas.PLAYER_TEAM_SEASON)
        assert rows(history.read_history(spark, root)) == rows(whole)
    assert whole.where("NOT is_current").count() > 50


def test_only_the_batch_s_buckets_are_read_and_written(spark, root):
    jobs.advance_history(spark, root, roster(spark, [(2010, p % 3, p) for p in range(300)]), CALENDAR)
    jobs.advance_history(spark, root, roster(spark, [(2011, (p + 1) % 3, p) for p in range(0, 300, 2)]), CALENDAR)
    before = stamps(root)
    touched = jobs.advance_history(spark, root, roster(spark, [(2012, 2, 10)]), CALENDAR)
    assert len(touched) == 1
    after = stamps(root)
    assert before.items() <= after.items()
    new = set(after) - set(before)
    assert new and all(f"bucket={touched[0]}/" in path for path in new)
    lines = {(r.season, r.game_id): r.run for r in ledger.lines(spark, root, history.LAYER, history.DATASET).collect()}
    assert sum(run == max(lines.values()) for run in lines.values()) == 2  # The one bucket, and what was closed.
    read = history.read_history(spark, root, touched)
    text = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "bucket#" in text.split("PartitionFilters: ")[1].split("]")[0]
    expected = history.read_history(spark, root).where(history.player_bucket(F.col("player_id")) == touched[0])
    assert rows(read) == rows(expected)


def test_a_batch_that_breaks_off_leaves_the_history_as_it_was(spark, root, monkeypatch):
    jobs.advance_history(spark, root, roster(spark, [(2010, 1, p) for p in range(20)]), CALENDAR)
    before = rows(history.read_history(spark, root))
    monkeypatch.setattr(ledger, "add", lambda *_, **__: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        jobs.advance_history(spark, root, roster(spark, [(2011, 2, p) for p in range(20)]), CALENDAR)
    assert rows(history.read_history(spark, root)) == before
    monkeypatch.undo()
    jobs.advance_history(spark, root, roster(spark, [(2011, 2, p) for p in range(20)]), CALENDAR)
    assert history.read_history(spark, root).where("is_current").count() == 20


def test_nothing_and_unknown_seasons(spark, root):
    assert history.read_history(spark, root).count() == 0
    assert jobs.advance_history(spark, root, roster(spark, []), CALENDAR) == []
    with pytest.raises(jobs.UnknownSeasons, match="2099"):
        jobs.advance_history(spark, root, roster(spark, [(2099, 1, 7)]), CALENDAR)
