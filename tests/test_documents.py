"""Documents read by ranges of their bytes, against a read of the whole document."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rimline.operators import moments
from rimline.operators.decode import Windows, number, whole
from rimline.sources import documents, files
from test_dimensions import side
from test_moments import frame

SEASON = "2015-16"


def event(k, rng):
    people = [(41, 900 + p, rng.random() * 94, rng.random() * 50) for p in range(rng.randrange(0, 11))]
    windows = [frame(7_000 + 40 * i, 60.0 - i / 4, *people, shot=rng.choice([None, 9.5])) for i in range(rng.randrange(0, 40))]
    windows += rng.choice([[], [[3, 1, 2.0]], [[3, None, 1.0, None, None, [[1, 2, 3.0]]]], [None], [frame(None, 2.0)]])
    found = {"eventId": str(k), "visitor": side(41, "CLE", 21), "home": side(42, "GSW", 11, 12), "moments": windows}
    return {**found, "moments": None} if k % 17 == 3 else {n: v for n, v in found.items() if n != "moments" or k % 19 != 5}


def write(root, game, text):
    folder = root / f"season={SEASON}" / f"game_id={game}"
    folder.mkdir(parents=True)
    (folder / f"{game}.json").write_text(text)


def read(spark, root, *ids):
    games = spark.createDataFrame([(SEASON, g) for g in ids], "season string, game_id string")
    return documents.read_events(spark, str(root), [f"{root}/season={SEASON}"], games)


def whole_read(spark, root):
    return moments.decode_events(moments.raw_event_rows(files.read_tracking_documents(spark, str(root))))


@pytest.fixture()
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def same(a, b):
    columns = ["season", "game_id", "gamedate", "event_pos", "event_id", "home", "visitor", "moments", "malformed_moments"]
    a, b = a.select(columns), b.select(columns)
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_one_document_by_many_tasks(spark, tmp_path, small_ranges, monkeypatch, broadcast):
    rng = random.Random(3)
    for game, spacing in (("0021500001", {"separators": (",", ":")}), ("0021500002", {}), ("0021500003", {"indent": 1})):
        write(tmp_path, game, json.dumps({"gameid": game, "gamedate": "2015-12-25", "events": [event(k, rng) for k in range(60)]}, **spacing))
    if not broadcast:
        monkeypatch.setattr(documents, "MOST_RANGES", 0)
        monkeypatch.setattr(documents, "MOST_GAMES", 0)
    events, others = read(spark, tmp_path, "0021500001", "0021500002", "0021500003")
    found = documents.records(spark, str(tmp_path), [f"{tmp_path}/season={SEASON}"])
    assert found.select("document", "start").distinct().count() > 12
    same(events, whole_read(spark, tmp_path))
    assert others.count() == 0
    events, others = read(spark, tmp_path, "0021500002", "0021500009")
    same(events, whole_read(spark, tmp_path).where(F.col("game_id") == "0021500002"))
    assert [r.game_id for r in others.collect()] == ["0021500009"]


def test_documents_of_other_shapes_are_named(spark, tmp_path, small_ranges):
    rng = random.Random(5)
    good = [event(k, rng) for k in range(20)]
    turned = [dict(reversed(e.items())) for e in good]
    write(tmp_path, "0021500001", json.dumps({"gamedate": "2015-12-25", "events": good}))
    write(tmp_path, "0021500002", json.dumps({"gamedate": "2015-12-25", "events": turned}))
    write(tmp_path, "0021500003", json.dumps({"events": good, "gamedate": "2015-12-25"}))
    write(tmp_path, "0021500004", json.dumps({"gamedate": "2015-12-25", "events": []}))
    write(tmp_path, "0021500005", json.dumps({"gamedate": "2015-12-25", "events": [*good[:3], turned[4]]}))
    write(tmp_path, "0021500006", "")
    ids = [f"002150000{k}" for k in range(1, 7)]
    events, others = read(spark, tmp_path, *ids)
    assert sorted(r.game_id for r in others.collect()) == ids[1:]
    same(events, whole_read(spark, tmp_path).where(F.col("game_id") == ids[0]))


def test_values_of_other_kinds():
    assert [whole(v) for v in (3, 3.9, "3", "3.9", " 4 ", None, True, "x", 1e30, [], float("nan"))] == [3, 3, 3, 3, 4, None, None, None, None, None, None]
    assert whole(1 << 40, 32) is None and number("1e3") == 1000.0
    windows = Windows()
    windows.add([["1", 1450000000000.0, "7.5", {}, None, [["1610612744", 11, "x", None, 2.5]]], [1, 2, 3, 4, 5, [[1, 2, 3, 4]]]])
    windows.add(None)
    windows.add("text")
    windows.add([])
    typed, malformed = windows.columns()
    assert malformed.to_pylist() == [1, 0, 0, 0]
    position = {"team_id": 1610612744, "player_id": 11, "x": None, "y": None, "z": 2.5}
    moment = {"period": 1, "moment_id": 1450000000000, "game_clock": 7.5, "shot_clock": None, "positions": [position]}
    assert typed.to_pylist() == [[moment], None, None, []]
