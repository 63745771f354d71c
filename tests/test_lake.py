"""Jobs over a small lake: files in, tables out, and what a second run does."""

import csv
import json
import os
import pathlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rimline import schemas
from rimline.constants import SEASONS
from rimline.operators import manifest as scope
from rimline.plans import jobs, serving
from rimline.sinks import ledger, reports, tables as sinks
from rimline.sources import files
from rimline.streaming.new_games import land_new_documents
from test_dimensions import side
from test_moments import write_document

GAMES = ("0021500438", "0021500622", "0029900007")
SEASON = {"0021500438": "2015-16", "0021500622": "2015-16", "0029900007": "1999-00"}
PBP_COLUMNS = [
    "GAME_ID", "EVENTNUM", "EVENTMSGTYPE", "EVENTMSGACTIONTYPE", "PERIOD", "WCTIMESTRING", "PCTIMESTRING",
    "HOMEDESCRIPTION", "NEUTRALDESCRIPTION", "VISITORDESCRIPTION",
    *[f"{a}{n}{b}" for n in (1, 2, 3) for a, b in (("PERSON", "TYPE"), ("PLAYER", "_ID"), ("PLAYER", "_NAME"), ("PLAYER", "_TEAM_ID"))],
]


def moment(ts, clock, ball, shooter):
    positions = [[-1, -1, *ball], [1610612744, 11, *shooter, 0.0]]
    return [1, ts, clock, 20.0, None, positions]


def game_events(shift):
    flight = [
        moment(1000 + shift, 700.0, (20.0, 25.0, 6.0), (20.5, 25.0)),
        moment(1040 + shift, 699.0, (5.25, 25.0, 10.0), (21.0, 25.0)),
    ]
    header = {"home": side(1610612744, "GSW", 11, 12), "visitor": side(1610612739, "CLE", 21)}
    return [{"eventId": "1", **header, "moments": flight}, {"eventId": "2", **header, "moments": flight[1:]}]


def pbp_row(game, event, code, person=4, player=11, text='"quoted" shot, far'):
    row = dict.fromkeys(PBP_COLUMNS, "")
    row.update(
        GAME_ID=int(game), EVENTNUM=event, EVENTMSGTYPE=code, PERIOD=1, PCTIMESTRING="11:40", WCTIMESTRING="8:01 PM",
        HOMEDESCRIPTION=text, PERSON1TYPE=person, PLAYER1_ID=player, PLAYER1_NAME="Ann", PLAYER1_TEAM_ID="1610612744.0",
    )
    return row


@pytest.fixture
def lake(spark, tmp_path):
    root = tmp_path / "lake"
    for i, game in enumerate(GAMES[:2]):
        write_document(root / "bronze" / "tracking", game, game_events(i), SEASON[game])
    manifest = tmp_path / "games.csv"
    with open(manifest, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(["game_id", "tracking_filename", "game_date", "away", "home", "season"])
        for game in GAMES:
            out.writerow([game, f"{game}.7z", "2015-12-25", "CLE", "GSW", SEASON[game]])
    season = tmp_path / "season"
    season.mkdir()
    for year, games in ((2015, (*GAMES[:2], "0021500999")), (1999, GAMES[2:])):
        with open(season / f"pbp_{year}.csv", "w", newline="") as f:
            out = csv.DictWriter(f, PBP_COLUMNS)
            out.writeheader()
            for game in games:
                out.writerow(pbp_row(game, 1, 1))
                out.writerow(pbp_row(game, 2, 4, person=2, player=1610612744))
    return str(root), str(manifest), str(season)


def run_games(spark, lake, games=None, **options):
    """The per-game jobs; returns the number of dropped moments."""
    root, manifest_path, season = lake
    manifest = files.load_manifest(spark, manifest_path, games)
    jobs.land_pbp(spark, manifest, season, root, **options)
    jobs.land_tracking(spark, manifest, root, **options)
    dropped = jobs.build_tracking(spark, manifest, root, **options)
    jobs.build_shot_locations(spark, manifest, root, **options)
    return dropped


MARTS = ("event", "event_participant", "events_with_location")


def read(spark, root, layer, dataset, schema):
    if dataset in MARTS:
        return sinks.read_mart(spark, root, layer, dataset, schema)
    if layer in ("bronze", "silver"):
        return sinks.read_games(spark, root, layer, dataset, schema)
    return files.read_table(spark, sinks.dataset_path(root, layer, dataset), schema)


def stamps(root, *parts):
    found = {}
    for folder, _, names in os.walk(os.path.join(root, *parts)):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                found[path] = os.stat(path).st_mtime_ns
    return found


def test_manifest(spark, lake):
    _, path, _ = lake
    assert files.load_manifest(spark, path).count() == 3
    assert rows(files.load_manifest(spark, path, [GAMES[1]]), "game_id", "season") == [(GAMES[1], "2015-16")]
    with pytest.raises(files.UnknownGames, match="0021599999"):
        files.load_manifest(spark, path, [GAMES[0], "0021599999"])


def test_season_files(spark, lake):
    _, manifest_path, season = lake
    pbp = files.read_season_pbp(spark, season)
    assert pbp.count() == 8
    types = dict(pbp.dtypes)
    assert (types["GAME_ID"], types["PLAYER1_TEAM_ID"], types["WCTIMESTRING"]) == ("bigint", "double", "string")
    first = pbp.where("EVENTNUM = 1").first()
    assert first.HOMEDESCRIPTION == '"quoted" shot, far' and first.PERSON2TYPE is None
    manifest = files.read_manifest(spark, manifest_path)
    assert scope.pbp_of_games(pbp, manifest).count() == 6
    one = spark.createDataFrame([("0021500001", "2015-16")], "game_id string, season string")
    assert rows(scope.games_without_rows(one, pbp)) == [("0021500001",)]


def test_whole_flow(spark, lake):
    root = lake[0]
    assert run_games(spark, lake, list(GAMES[:2])) == 0
    jobs.build_headers(spark, files.load_manifest(spark, lake[1], list(GAMES[:2])), root)
    jobs.build_events(spark, root)
    jobs.build_dimensions(spark, root, SEASONS)
    jobs.build_gold(spark, root)
    moment_table = read(spark, root, "silver", "tracking_moment", schemas.MOMENT)
    assert rows(moment_table, "season", "game_id", "moment_id", "ball_z") == [
        ("2015-16", GAMES[0], 1000, 6.0),
        ("2015-16", GAMES[0], 1040, 10.0),
        ("2015-16", GAMES[1], 1001, 6.0),
        ("2015-16", GAMES[1], 1041, 10.0),
    ]
    assert read(spark, root, "silver", "player_location", schemas.PLAYER_LOCATION).count() == 4
    shots = read(spark, root, "silver", "shot_location", schemas.SHOT_LOCATION)
    assert rows(shots, "game_id", "event_id", "shooter_x", "release_game_clock") == [
        (GAMES[0], 1, 20.5, 700.0),
        (GAMES[1], 1, 20.5, 700.0),
    ]
    mart = read(spark, root, "gold", "events_with_location", schemas.EVENTS_WITH_LOCATION)
    assert rows(mart, "season_start_year", "game_id", "event_id", "shot_distance", "is_three", "event_team_id") == [
        (2015, GAMES[0], 1, 15.25, False, 1610612744),
        (2015, GAMES[0], 2, None, None, 1610612744),
        (2015, GAMES[1], 1, 15.25, False, 1610612744),
        (2015, GAMES[1], 2, None, None, 1610612744),
    ]
    teams = read(spark, root, "conformed", "dim_team", schemas.DIM_TEAM)
    games = read(spark, root, "conformed", "dim_game", schemas.DIM_GAME)
    assert [r.label for r in serving.list_games(mart, games, teams).collect()] == ["CLE @ GSW · 2015-12-25"] * 2
    stints = read(spark, root, "conformed", "player_team_season", schemas.PLAYER_TEAM_SEASON)
    assert rows(stints, "player_id", "team_id", "is_current") == [
        (11, 1610612744, True),
        (12, 1610612744, True),
        (21, 1610612739, True),
    ]
    assert read(spark, root, "conformed", "dim_player", schemas.DIM_PLAYER).count() == 3
    assert read(spark, root, "silver", "event_participant", schemas.EVENT_PARTICIPANT).count() == 2
    landed = read(spark, root, "bronze", "pbp", schemas.PBP_LANDED)
    assert rows(landed, "game_id", "EVENTNUM") == [(g, e) for g in GAMES[:2] for e in (1, 2)]


def test_second_run_writes_nothing_and_force_only_its_games(spark, lake):
    root = lake[0]
    run_games(spark, lake, list(GAMES[:2]))
    before = {layer: stamps(root, layer) for layer in ("bronze", "silver")}
    run_games(spark, lake, list(GAMES[:2]))
    per_game = lambda layer: {p: t for p, t in stamps(root, layer).items() if "game_id=" in p}
    for layer in ("bronze", "silver"):
        assert per_game(layer) == {p: t for p, t in before[layer].items() if "game_id=" in p}
    run_games(spark, lake, [GAMES[0]], force=True)
    after = per_game("silver")
    kept = {p: t for p, t in before["silver"].items() if f"game_id={GAMES[1]}" in p}
    assert kept.items() <= after.items()
    run_of = {r.game_id: r.run for r in ledger.lines(spark, root, "silver", "tracking_moment").collect()}
    redone = [p for p in after if f"run={run_of[GAMES[0]]}" in p]
    assert run_of[GAMES[0]] > run_of[GAMES[1]] and redone and all(f"game_id={GAMES[0]}" in p for p in redone)
    assert read(spark, root, "silver", "tracking_moment", schemas.MOMENT).count() == 4


def test_missing_output_makes_a_game_pending(spark, lake):
    root, manifest_path, season = lake
    manifest = files.load_manifest(spark, manifest_path, list(GAMES[:2]))
    jobs.land_tracking(spark, manifest, root)
    jobs.build_tracking(spark, files.load_manifest(spark, manifest_path, [GAMES[0]]), root)
    outputs = ["tracking_moment", "player_location"]
    pending = sinks.pending_games(spark, manifest, root, "silver", outputs)
    assert rows(pending, "game_id") == [(GAMES[1],)]
    only_moment = sinks.pending_games(spark, manifest, root, "silver", [*outputs, "shot_location"])
    assert only_moment.count() == 2


def test_game_without_rows_is_not_redone(spark, lake):
    root, manifest_path, season = lake
    manifest = files.load_manifest(spark, manifest_path, [GAMES[0]])
    jobs.land_tracking(spark, manifest, root)
    no_shots = spark.createDataFrame([pbp_row(GAMES[0], 2, 4)]).select(
        *[F.col(c).try_cast(schemas.PBP_TYPES.get(c, "string").lower()).alias(c) for c in PBP_COLUMNS if c != "GAME_ID"],
        F.lit("2015-16").alias("season"),
        F.lit(GAMES[0]).alias("game_id"),
    )
    sinks.write_games(no_shots, sinks.dataset_path(root, "bronze", "pbp"), "first")
    with pytest.raises(jobs.MissingInput, match=GAMES[0]):  # Rows that no ledger line names are of a run that broke off.
        jobs.build_shot_locations(spark, manifest, root)
    sinks.note_games(spark, manifest, "first", root, "bronze", ["pbp"])
    jobs.build_shot_locations(spark, manifest, root)
    assert sinks.pending_games(spark, manifest, root, "silver", ["shot_location"]).count() == 0


def test_rows_are_counted_though_none_is_written(spark, tmp_path):
    for most, left in ((100, 10), (5, 5), (-1, 0)):
        seen, counted = reports.observed(spark.range(10), F.count("*").alias("rows"), F.count(F.when(F.col("id") >= most, 1)).alias("faulty"))
        seen.where(F.col("id") < most).repartition(2, "id").write.parquet(str(tmp_path / f"out{left}"))
        assert counted() == {"rows": 10, "faulty": 10 - left}
        assert spark.read.schema("id long").parquet(str(tmp_path / f"out{left}")).count() == left


def test_excluded_games_have_no_shots(spark, lake):
    root, manifest_path, season = lake
    manifest = files.load_manifest(spark, manifest_path, list(GAMES[:2]))
    jobs.land_pbp(spark, manifest, season, root)
    jobs.land_tracking(spark, manifest, root)
    jobs.build_shot_locations(spark, manifest, root, exclude_games=(GAMES[1],))
    shots = read(spark, root, "silver", "shot_location", schemas.SHOT_LOCATION)
    assert rows(shots, "game_id") == [(GAMES[0],)]


def test_guards_name_every_faulty_game_and_do_the_others(spark, lake, tmp_path):
    root, manifest_path, season = lake
    manifest = files.read_manifest(spark, manifest_path)
    absent = [f"00215{n:05d}" for n in range(1, 39)]
    more = manifest.unionByName(spark.createDataFrame([(g, "f", "d", "a", "h", "2015-16") for g in absent], manifest.schema))
    with pytest.raises(jobs.EmptyGames) as raised:
        jobs.land_pbp(spark, more, season, root)
    assert all(game in str(raised.value) for game in absent)
    landed = read(spark, root, "bronze", "pbp", schemas.PBP_LANDED)
    assert rows(landed.select("game_id").distinct()) == [(g,) for g in GAMES]
    with pytest.raises(jobs.MissingInput, match=GAMES[2]):
        jobs.land_tracking(spark, manifest, root)
    with pytest.raises(jobs.EmptyGames, match=GAMES[2]):
        jobs.build_headers(spark, manifest, root)
    assert read(spark, root, "silver", "dim_game", schemas.DIM_GAME_RAW).count() == 2


def test_late_document_is_picked_up_without_force(spark, lake):
    root, manifest_path, season = lake
    manifest = files.read_manifest(spark, manifest_path)
    jobs.land_pbp(spark, manifest, season, root)
    for job in (jobs.land_tracking, jobs.build_tracking, jobs.build_shot_locations):
        with pytest.raises(jobs.MissingInput, match=GAMES[2]):
            job(spark, manifest, root)
    write_document(tmp(root) / "bronze" / "tracking", GAMES[2], game_events(5), SEASON[GAMES[2]])
    before = stamps(root, "silver")
    for job in (jobs.land_tracking, jobs.build_tracking, jobs.build_shot_locations):
        job(spark, manifest, root)
    table = read(spark, root, "silver", "tracking_moment", schemas.MOMENT)
    assert rows(table.select("game_id").distinct()) == [(g,) for g in GAMES]
    shots = read(spark, root, "silver", "shot_location", schemas.SHOT_LOCATION)
    assert rows(shots, "game_id", "shooter_x") == [(g, 20.5) for g in GAMES]
    assert set(before) <= set(stamps(root, "silver"))


def tmp(root):
    return pathlib.Path(root)


def test_shots_wait_for_windows(spark, lake):
    root, manifest_path, season = lake
    manifest = files.load_manifest(spark, manifest_path, [GAMES[0]])
    jobs.land_pbp(spark, manifest, season, root)
    with pytest.raises(jobs.MissingInput, match=GAMES[0]):
        jobs.build_shot_locations(spark, manifest, root)
    jobs.land_tracking(spark, manifest, root)
    jobs.build_shot_locations(spark, manifest, root)
    shots = read(spark, root, "silver", "shot_location", schemas.SHOT_LOCATION)
    assert rows(shots, "shooter_x") == [(20.5,)]


def test_the_check_for_pending_games_reads_the_ledger_only(spark, lake):
    root, manifest_path, _ = lake
    run_games(spark, lake, list(GAMES[:2]))
    pending = sinks.pending_games(spark, files.read_manifest(spark, manifest_path), root, "silver", ["tracking_moment"])
    read_from = {os.path.dirname(path) for path in pending.inputFiles()} - {"file://" + os.path.dirname(manifest_path)}
    assert read_from and all(path.startswith(f"file://{root}/ledger/silver_tracking_moment/log/") for path in read_from)
    assert rows(pending, "game_id") == [(GAMES[2],)]


def test_excluded_games_lose_the_rows_they_had(spark, lake):
    root, manifest_path, season = lake
    manifest = files.load_manifest(spark, manifest_path, list(GAMES[:2]))
    run_games(spark, lake, list(GAMES[:2]))
    jobs.build_shot_locations(spark, manifest, root, exclude_games=(GAMES[1],))
    shots = lambda: rows(read(spark, root, "silver", "shot_location", schemas.SHOT_LOCATION), "game_id")
    assert shots() == [(GAMES[0],)]
    jobs.build_shot_locations(spark, manifest, root, force=True, exclude_games=(GAMES[1],))
    assert shots() == [(GAMES[0],)]
    jobs.build_shot_locations(spark, manifest, root)
    assert shots() == [(GAMES[0],), (GAMES[1],)]


def test_forced_game_without_rows_keeps_none(spark, lake):
    root, manifest_path, season = lake
    run_games(spark, lake, list(GAMES[:2]))
    write = lambda events: (tmp(root) / "bronze" / "tracking" / f"season={SEASON[GAMES[0]]}" / f"game_id={GAMES[0]}" / f"{GAMES[0]}.json").write_text(
        json.dumps({"gamedate": "2015-12-25", "events": events})
    )
    write([{"eventId": "1", "moments": []}])
    manifest = files.load_manifest(spark, manifest_path, [GAMES[0]])
    jobs.land_tracking(spark, manifest, root, force=True)
    jobs.build_tracking(spark, manifest, root, force=True)
    table = read(spark, root, "silver", "tracking_moment", schemas.MOMENT)
    assert rows(table.select("game_id").distinct()) == [(GAMES[1],)]


def write_season(path, columns, *lines):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(columns)
        out.writerows(lines)


def test_season_files_of_other_shapes(spark, tmp_path):
    write_season(tmp_path / "a.csv", ["GAME_ID", "EVENTNUM", "EVENTMSGTYPE", "PERIOD"], [21500001, 1, 1, 1])
    write_season(tmp_path / "b.csv", ["PERIOD", "EVENTMSGTYPE", "GAME_ID", "EVENTNUM", "NEW"], ["2.0", "2.0", "21400001.0", "7.0", "x"])
    pbp = files.read_season_pbp(spark, str(tmp_path))
    assert rows(pbp, "GAME_ID", "EVENTNUM", "EVENTMSGTYPE", "PERIOD", "NEW", "PLAYER1_ID") == [
        (21400001, 7, 2, 2, "x", None),
        (21500001, 1, 1, 1, None, None),
    ]


def test_season_text_that_does_not_fit_is_raised(spark, tmp_path):
    write_season(tmp_path / "a.csv", ["GAME_ID", "EVENTNUM", "PERIOD"], [21500001, 1, "one"], [21500001, "2.5", ""])
    with pytest.raises(files.MistypedFields, match="2 field"):
        files.read_season_pbp(spark, str(tmp_path))


def test_rosters_of_unknown_seasons_are_raised(spark, tmp_path):
    first = str(tmp_path / "first")
    spark.createDataFrame([], schemas.PLAYER_TEAM_SEASON).write.parquet(first)
    roster = spark.createDataFrame([(2015, 1, 7), (2099, 1, 7)], "season_id int, team_id long, player_id long")
    with pytest.raises(jobs.UnknownSeasons, match="2099"):
        jobs.advance_rosters(spark, first, roster, str(tmp_path / "second"), SEASONS)


def test_stream_lands_each_document_once(spark, lake, tmp_path):
    root, manifest_path, _ = lake
    checkpoint = str(tmp_path / "stream")
    land_new_documents(spark, root, checkpoint).awaitTermination()
    assert read(spark, root, "bronze", "tracking_event", schemas.TRACKING_EVENT).count() == 4
    first = stamps(root, "bronze", "tracking_event")
    write_document(tmp_path / "lake" / "bronze" / "tracking", GAMES[2], game_events(5), SEASON[GAMES[2]])
    land_new_documents(spark, root, checkpoint).awaitTermination()
    second = stamps(root, "bronze", "tracking_event")
    assert read(spark, root, "bronze", "tracking_event", schemas.TRACKING_EVENT).count() == 6
    assert {p: second[p] for p in first} == first
    manifest = files.read_manifest(spark, manifest_path)
    assert sinks.pending_games(spark, manifest, root, "bronze", ["tracking_event"]).count() == 0


def test_roster_snapshots(spark, tmp_path):
    calendar = tuple((y, str(y), f"{y}-10-27", f"{y + 1}-06-19") for y in (2015, 2016))
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    spark.createDataFrame([], schemas.PLAYER_TEAM_SEASON).write.parquet(first)
    roster = lambda *rows: spark.createDataFrame(list(rows), "season_id int, team_id long, player_id long")
    jobs.advance_rosters(spark, first, roster((2015, 1, 7), (2015, 1, 8)), second, calendar)
    third = str(tmp_path / "third")
    jobs.advance_rosters(spark, second, roster((2016, 2, 7)), third, calendar)
    found = files.read_table(spark, third, schemas.PLAYER_TEAM_SEASON)
    assert rows(found, "player_id", "season_id", "team_id", "is_current") == [
        (7, 2015, 1, False),
        (7, 2016, 2, True),
        (8, 2015, 1, True),
    ]
    with pytest.raises(ValueError, match="path of its own"):
        jobs.advance_rosters(spark, third, roster((2016, 2, 7)), third + "/", calendar)


def test_tables_skip_other_directories(spark, lake):
    root, manifest_path, _ = lake
    manifest = files.load_manifest(spark, manifest_path, list(GAMES[:2]))
    jobs.land_tracking(spark, manifest, root)
    events = read(spark, root, "bronze", "tracking_event", schemas.TRACKING_EVENT)
    plan = events.where(F.col("game_id") == GAMES[0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(game_id" in plan


def test_one_new_game_rewrites_one_bucket(spark, lake):
    root, manifest_path, season = lake
    run_games(spark, lake, list(GAMES[:2]))
    assert jobs.build_events(spark, root) == 4 and jobs.build_gold(spark, root) == 2
    before = {layer: stamps(root, layer) for layer in ("silver", "gold")}
    assert jobs.build_events(spark, root) == 0 and jobs.build_gold(spark, root) == 0
    assert stamps(root, "gold") == before["gold"]
    write_document(tmp(root) / "bronze" / "tracking", GAMES[2], game_events(5), SEASON[GAMES[2]])
    run_games(spark, lake)
    assert jobs.build_events(spark, root) == 2 and jobs.build_gold(spark, root) == 1
    new = set(stamps(root, "gold")) - set(before["gold"])
    assert before["gold"].items() <= stamps(root, "gold").items()
    assert new and all("season_start_year=1999" in path for path in new)
    mart = read(spark, root, "gold", "events_with_location", schemas.EVENTS_WITH_LOCATION)
    assert rows(mart, "game_id", "event_id", "has_shot_location") == [(g, e, e == 1) for g in GAMES for e in (1, 2)]
    # A game that loses its shots makes its own bucket stale, and no other.
    manifest = files.load_manifest(spark, manifest_path, [GAMES[0]])
    jobs.build_shot_locations(spark, manifest, root, exclude_games=(GAMES[0],))
    assert jobs.build_events(spark, root) == 0 and jobs.build_gold(spark, root) == 1
    mart = read(spark, root, "gold", "events_with_location", schemas.EVENTS_WITH_LOCATION)
    assert rows(mart.where("has_shot_location"), "game_id") == [(g,) for g in GAMES[1:]]
    one = sinks.read_mart(spark, root, "gold", "events_with_location", schemas.EVENTS_WITH_LOCATION, GAMES[1])
    text = one._jdf.queryExecution().executedPlan().toString()
    assert rows(one, "game_id", "event_id") == [(GAMES[1], 1), (GAMES[1], 2)] and "(bucket#" in text.split("PartitionFilters: ")[1]


def test_one_bad_field_stops_no_game(spark, lake):
    root, manifest_path, season = lake
    manifest = files.load_manifest(spark, manifest_path, list(GAMES[:2]))
    path = os.path.join(season, "pbp_2015.csv")
    text = pathlib.Path(path).read_text()
    bad = pbp_row(GAMES[0], 3, 1) | {"PERIOD": "one", "PLAYER1_ID": "x"}
    lost = pbp_row(GAMES[1], 4, 1) | {"GAME_ID": "21500622a"}
    other = pbp_row("0021500999", 5, 1) | {"PERIOD": "two"}  # Not a game of this run.
    with open(path, "a", newline="") as f:
        csv.DictWriter(f, PBP_COLUMNS).writerows([bad, lost, other])
    assert jobs.land_pbp(spark, manifest, season, root) == 2
    landed = read(spark, root, "bronze", "pbp", schemas.PBP_LANDED)
    assert rows(landed, "game_id", "EVENTNUM") == [(g, e) for g in GAMES[:2] for e in (1, 2)]
    aside = jobs.quarantined_pbp(spark, root)
    assert rows(aside, "game_id", "faults") == [(GAMES[0], ["PERIOD", "PLAYER1_ID"]), ("unknown", ["GAME_ID"])]
    assert all(r.source_file.endswith("pbp_2015.csv") for r in aside.collect())
    said = json.loads(aside.where(F.col("game_id") == GAMES[0]).first().source_text)
    assert (said["PERIOD"], said["EVENTNUM"]) == ("one", "3")
    pathlib.Path(path).write_text(text)  # Mended and landed again, nothing is aside any more.
    assert jobs.land_pbp(spark, manifest, season, root, force=True) == 0
    assert jobs.quarantined_pbp(spark, root).count() == 0
    assert rows(read(spark, root, "bronze", "pbp", schemas.PBP_LANDED), "game_id", "EVENTNUM") == rows(landed, "game_id", "EVENTNUM")


def test_moments_without_a_timestamp_are_counted(spark, lake):
    root, manifest_path, _ = lake
    events = game_events(5)
    events[0]["moments"].append(moment(0, 1.0, (1.0, 2.0, 3.0), (4.0, 5.0)))
    events[0]["moments"][-1][1] = None
    write_document(tmp(root) / "bronze" / "tracking", GAMES[2], events, SEASON[GAMES[2]])
    manifest = files.load_manifest(spark, manifest_path, [GAMES[2]])
    jobs.land_tracking(spark, manifest, root)
    assert jobs.build_tracking(spark, manifest, root) == 1
    assert rows(read(spark, root, "silver", "tracking_moment", schemas.MOMENT), "moment_id") == [(1005,), (1045,)]
    jobs.land_pbp(spark, manifest, lake[2], root)
    jobs.build_shot_locations(spark, manifest, root)
    assert rows(reports.read(spark, root), "job", "game_id", "measure", "value") == [
        ("build_shot_locations", None, "located", 1),
        ("build_shot_locations", None, "shots", 1),
        ("build_tracking", None, "dropped", 1),
        ("build_tracking", None, "player_location", 2),
        ("build_tracking", None, "tracking_moment", 2),
        ("build_tracking", GAMES[2], "dropped", 1),
        ("land_pbp", None, "set_aside", 0),
    ]
