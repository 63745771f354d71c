"""Jobs: read a layer of the lake, write the next.

Per-game jobs handle all pending games in one Spark job. A game is pending until the ledger says
that its outputs are written; ``force`` redoes the given games and leaves all others alone. A
game whose input is not there yet, or is faulty, stays pending: the job does all other games
and then raises an error that names every such game.
"""

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from rimline import schemas
from rimline.operators import headers, manifest as scope, moments, scd2, trajectory
from rimline.plans import conformed, event as events, gold
from rimline.sinks import history, reports, tables as sinks
from rimline.sources import documents, files

SILVER_DIMS = ("dim_player", "dim_team", "dim_game", "roster")


class EmptyGames(ValueError):
    """Manifest games without source rows."""


class MissingInput(EmptyGames):
    """Manifest games whose input has not arrived."""


class UnknownSeasons(ValueError):
    """Roster rows of seasons that the calendar does not have."""


def _raise_for(games: DataFrame, kind: type[ValueError], what: str) -> None:
    """Raise with all of the games. A run that is missing games names them one by one, as the manifest does."""
    found = sorted({row.game_id for row in games.select("game_id").collect()})
    if found:
        raise kind(f"{len(found)} game(s), {what}: {found}")


def _start(spark: SparkSession, games: DataFrame, root: str, layer: str, datasets: list[str], force: bool) -> str:
    """The name of the run. Forced games are without rows from here on, until the run names theirs."""
    if force:
        sinks.note_games(spark, games, None, root, layer, datasets, done=False)
    return sinks.new_run()


#: Where rows lie whose own game id does not fit.
UNKNOWN = ("unknown", "unknown")


def land_pbp(spark: SparkSession, manifest: DataFrame, season_files, root: str, force: bool = False) -> int:
    """Season play-by-play files -> one partition per manifest game, rows and columns unchanged.

    Rows with text that does not fit its column go to a side table, with their file, and all others land: one bad field stops
    no game. Returns how many rows went aside; ``quarantined_pbp`` lists them. Games without rows in the files are
    left pending and raised once the others have landed.
    """
    games = sinks.pending_games(spark, manifest, root, "bronze", ["pbp"], force)
    if games.isEmpty():
        return 0
    season = files.season_rows(spark, season_files)
    run = _start(spark, games, root, "bronze", ["pbp"], force)
    path = sinks.dataset_path(root, "bronze", "pbp")
    faulty = F.col("mistyped") > 0
    # Faulty rows are counted as the good ones are written; the side table is another pass only where there are any.
    about = [c for c in files.ABOUT_ROWS if c != "mistyped"]
    scoped, counted = reports.observed(scope.pbp_of_games(season.drop(*about), games), F.count(F.when(faulty, 1)).alias("faulty"))
    sinks.write_games(scoped.where(~faulty).drop("mistyped"), path, run, ["EVENTNUM"])
    aside = counted()["faulty"]
    without_game = season.where(F.array_contains("faults", "GAME_ID"))
    lost = without_game.count()
    _set_aside(spark, root, run, season if aside else None, without_game if lost else None, games)
    written = sinks.written_games(spark, path, run).select("game_id")
    sinks.note_games(spark, games.join(written, "game_id", "left_semi"), run, root, "bronze", ["pbp"])
    reports.note(spark, root, "land_pbp", run, {"set_aside": aside + lost})
    _raise_for(games.join(written, "game_id", "left_anti"), EmptyGames, "no play-by-play rows for")
    return aside + lost


def _set_aside(spark: SparkSession, root: str, run: str, season: DataFrame | None, without_game: DataFrame | None, games: DataFrame) -> None:
    """Write the run's faulty rows; the games' earlier ones are replaced, and so are those without a game."""
    found = []
    if season is not None:
        found.append(scope.pbp_of_games(season.where("mistyped > 0"), games))
    if without_game is not None:
        found.append(without_game.withColumns({"season": F.lit(UNKNOWN[0]), "game_id": F.lit(UNKNOWN[1])}))
    columns = ["faults", "source_file", "source_text", "season", "game_id"]
    for part in found:
        part.select(columns).write.mode("append").partitionBy("season", "game_id").parquet(f"{sinks.dataset_path(root, 'bronze', 'pbp_quarantine')}/run={run}")
    parts = games.select("season", "game_id").union(spark.createDataFrame([UNKNOWN], "season STRING, game_id STRING"))
    sinks.note_games(spark, parts, run if found else None, root, "bronze", ["pbp_quarantine"], done=bool(found))


def quarantined_pbp(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the latest run of each game that were not landed: the columns at fault, the file and the row's text."""
    return sinks.read_games(spark, root, "bronze", "pbp_quarantine", schemas.QUARANTINE)


def land_tracking(spark: SparkSession, manifest: DataFrame, root: str, force: bool = False) -> None:
    """Tracking documents -> typed event windows, once, for all later jobs.

    A document is read by many tasks, by ranges of its bytes; one of a shape that can't be is read whole, by one task. Games whose document has not arrived stay pending and are raised at the end.
    """
    games = sinks.pending_games(spark, manifest, root, "bronze", ["tracking_event"], force)
    if games.isEmpty():
        return
    source = sinks.dataset_path(root, "bronze", "tracking")
    seasons = sorted(row.season for row in games.select("season").distinct().collect())
    arrived = files.arrived_documents(spark, source, seasons)
    there = games.join(arrived.select("game_id"), "game_id", "left_semi")
    run = _start(spark, there, root, "bronze", ["tracking_event"], force)
    if not there.isEmpty():
        path = sinks.dataset_path(root, "bronze", "tracking_event")
        write = lambda rows, name: sinks.write_games(rows, path, name, gather=False, row_group_bytes=sinks.WINDOW_ROW_GROUP_BYTES)
        folders = files.season_folders(spark, source, seasons)
        events, others = documents.read_events(spark, source, folders, there)
        write(events, run)
        by_ranges = there.join(others, ["season", "game_id"], "left_anti")
        sinks.note_games(spark, by_ranges, run, root, "bronze", ["tracking_event"])
        if not others.isEmpty():
            read = files.read_tracking_documents(spark, source, seasons).join(others, ["season", "game_id"], "left_semi")
            write(moments.decode_events(moments.raw_event_rows(read)), f"{run}-whole")
            sinks.note_games(spark, others, f"{run}-whole", root, "bronze", ["tracking_event"])
    _raise_for(games.join(arrived.select("game_id"), "game_id", "left_anti"), MissingInput, "no tracking document for")


def _landed(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Games that have landed whole, by the ledger."""
    return sinks.finished_games(spark, root, "bronze", dataset).select("game_id")


def _tracking_events(spark: SparkSession, root: str, games: DataFrame) -> DataFrame:
    return sinks.read_games(spark, root, "bronze", "tracking_event", schemas.TRACKING_EVENT, games)


def _landed_pbp(spark: SparkSession, root: str, games: DataFrame | None = None) -> DataFrame:
    return sinks.read_games(spark, root, "bronze", "pbp", schemas.PBP_LANDED, games)


def build_tracking(spark: SparkSession, manifest: DataFrame, root: str, force: bool = False) -> int:
    """Event windows -> ``tracking_moment`` and ``player_location``.

    The two tables are two passes on purpose: the moment pass moves no player positions, and the positions move once,
    straight to the layout in which they are written.
    Returns the number of moments dropped for want of a timestamp; ``malformed_moments`` counts those that
    could not be decoded.
    """
    outputs = ["tracking_moment", "player_location"]
    games = sinks.pending_games(spark, manifest, root, "silver", outputs, force)
    if games.isEmpty():
        return 0
    landed = _landed(spark, root, "tracking_event")
    there = games.join(landed, "game_id", "left_semi")
    waiting = games.join(landed, "game_id", "left_anti")
    dropped = 0
    if not there.isEmpty():
        run = _start(spark, there, root, "silver", outputs, force)
        windows = _tracking_events(spark, root, there)
        # Counted as the rows pass on their way to the first table, so no read of its own is needed.
        null = F.count(F.when(F.col("moment_id").isNull(), 1)).alias("dropped")
        listed, counted = reports.observed(moments.moment_rows(windows).drop("positions"), null)
        kept = moments.dedup_moments(listed)
        path = lambda dataset: sinks.dataset_path(root, "silver", dataset)
        tables = (moments.moment_table(kept), moments.player_locations(windows))
        written = {name: reports.observed(df, F.count("*").alias("rows")) for name, df in zip(outputs, tables)}
        sinks.write_games(written[outputs[0]][0], path(outputs[0]), run, ["moment_id"])
        sinks.write_games(written[outputs[1]][0], path(outputs[1]), run, ["moment_id"], gather=False)
        sinks.note_games(spark, there, run, root, "silver", outputs)
        dropped = counted()["dropped"]
        by_game = {"dropped": moments.null_timestamp_counts(windows)} if dropped else {}
        counts = {"dropped": dropped, **{name: found()["rows"] for name, (_, found) in written.items()}}
        reports.note(spark, root, "build_tracking", run, counts, by_game)
    _raise_for(waiting, MissingInput, "no tracking landed for")
    return dropped


def malformed_moments(spark: SparkSession, manifest: DataFrame, root: str) -> DataFrame:
    """``(game_id, malformed)`` of manifest games with listed moments that could not be decoded."""
    return moments.malformed_counts(_tracking_events(spark, root, manifest))


def build_headers(spark: SparkSession, manifest: DataFrame, root: str, force: bool = False) -> None:
    """Event headers -> per-game slices of players, teams, games and rosters.

    Games whose document lists no event, or has not landed, stay pending and are raised at the end.
    """
    outputs = list(SILVER_DIMS)
    games = sinks.pending_games(spark, manifest, root, "silver", outputs, force)
    if games.isEmpty():
        return
    landed = _tracking_events(spark, root, games)
    # Positions are numbered from 0 at landing, so this filter reaches the file scan.
    first = headers.first_headers(landed.where("event_pos = 0"))
    empty = headers.games_without_events(games, first)
    there = games.join(empty, "game_id", "left_anti")
    run = _start(spark, there, root, "silver", outputs, force)
    slices = {
        "dim_player": headers.player_rows(first),
        "dim_team": headers.team_rows(first),
        "dim_game": headers.game_rows(first),
        "roster": headers.roster_rows(first),
    }
    for dataset in SILVER_DIMS:
        sinks.write_games(slices[dataset], sinks.dataset_path(root, "silver", dataset), run)
    sinks.note_games(spark, there, run, root, "silver", outputs)
    _raise_for(empty, EmptyGames, "tracking document has no events for")


def build_shot_locations(
    spark: SparkSession, manifest: DataFrame, root: str, force: bool = False, exclude_games: tuple[str, ...] = ()
) -> None:
    """Play-by-play shots and event windows -> ``shot_location``.

    Excluded games have no rows afterwards, whatever earlier runs wrote, and stay pending. So do games without
    landed play-by-play or windows, which are raised at the end.
    """
    output = ["shot_location"]
    path = sinks.dataset_path(root, "silver", "shot_location")
    excluded = F.col("game_id").isin(*exclude_games)
    if exclude_games:
        sinks.note_games(spark, manifest.where(excluded), None, root, "silver", output, done=False)
    games = sinks.pending_games(spark, manifest.where(~excluded) if exclude_games else manifest, root, "silver", output, force)
    if games.isEmpty():
        return
    landed = _landed(spark, root, "pbp").join(_landed(spark, root, "tracking_event"), "game_id", "left_semi")
    there = games.join(landed, "game_id", "left_semi")
    waiting = games.join(landed, "game_id", "left_anti")
    if not there.isEmpty():
        run = _start(spark, there, root, "silver", output, force)
        pbp = _landed_pbp(spark, root, there)
        shots = trajectory.shot_attempts(pbp, F.col("game_id"), "season")
        listed = _tracking_events(spark, root, there)
        windows = trajectory.rim_windows(trajectory.shot_windows(listed, shots))
        located, counted = reports.observed(trajectory.locate_shots(shots, windows), F.count("*").alias("shots"), F.count("shooter_x").alias("located"))
        sinks.write_games(located, path, run, ["event_id"])
        reports.note(spark, root, "build_shot_locations", run, counted())
        sinks.note_games(spark, there, run, root, "silver", output)
    _raise_for(waiting, MissingInput, "no play-by-play or no tracking landed for")


def _games_of(spark: SparkSession, root: str, layer: str, dataset: str, parts: DataFrame) -> DataFrame:
    """Finished games of a per-game table that lie in the mart parts."""
    there = sinks.mart_parts(sinks.finished_games(spark, root, layer, dataset))
    named = parts.select("season", F.col("game_id").alias("part"))
    return there.join(named, ["season", "part"], "left_semi").select("game_id")


def _rebuild(spark: SparkSession, root: str, layer: str, dataset: str, sources: list, make, sort_by: list[str]) -> int:
    """Write the mart parts whose sources changed, and no others; how many there were."""
    looked = time.time_ns()  # What lands from here on makes a part stale again.
    parts = sinks.stale_parts(spark, sources, root, layer, dataset)
    # As many rows as seasons times buckets; fixed, so that the job sees one list.
    names = [(r.season, r.game_id) for r in parts.collect()]
    if not names:
        return 0
    parts = spark.createDataFrame(names, "season STRING, game_id STRING")
    run = sinks.new_run()
    rows = make(parts).withColumn("bucket", sinks.game_bucket(F.col("game_id")))
    sinks.write_parts(rows, sinks.dataset_path(root, layer, dataset), run, sinks.MART_KEYS, sort_by)
    sinks.ledger.add(spark, parts, run, root, layer, dataset, True, looked)
    return len(names)


def build_events(spark: SparkSession, root: str) -> int:
    """Landed play-by-play -> ``event`` and ``event_participant``; only the parts with games that changed are written.

    Returns how many parts of the two tables were written.
    """
    sources = [("games", "bronze", "pbp")]

    def of(plan):
        return lambda parts: plan(_landed_pbp(spark, root, _games_of(spark, root, "bronze", "pbp", parts)))

    return sum(
        _rebuild(spark, root, "silver", dataset, sources, of(plan), ["game_id", "event_id"])
        for dataset, plan in (("event", events.event), ("event_participant", events.event_participant))
    )


def _known_seasons(roster: DataFrame, season: DataFrame) -> None:
    """A roster row of a season without calendar would vanish from the join: raise instead."""
    found = sorted(str(row.season_id) for row in scd2.season_orphans(roster, season).select("season_id").distinct().collect())
    if found:
        raise UnknownSeasons(f"roster rows of seasons without calendar: {found}")


def build_dimensions(spark: SparkSession, root: str, seasons) -> None:
    """Per-game slices -> conformed dimensions and the open load of roster stints.

    ``seasons`` is the calendar: start year, label, first and last day. It has to know every season of the rosters.
    """

    def read(dataset: str, schema: str) -> DataFrame:
        return sinks.read_games(spark, root, "silver", dataset, schema)

    def write(df: DataFrame, dataset: str, key: str) -> None:
        sinks.write_clustered(df, sinks.dataset_path(root, "conformed", dataset), [], [key])

    season = conformed.dim_season(spark, seasons)
    roster = read("roster", schemas.ROSTER_RAW)
    _known_seasons(roster, season)
    write(conformed.dim_player(read("dim_player", schemas.DIM_PLAYER_RAW)), "dim_player", "player_id")
    write(conformed.dim_team(read("dim_team", schemas.DIM_TEAM_RAW)), "dim_team", "team_id")
    write(conformed.dim_game(read("dim_game", schemas.DIM_GAME_RAW)), "dim_game", "game_id")
    write(season, "dim_season", "season_id")
    write(scd2.open_stints(roster, season), "player_team_season", "player_id")


def build_gold(spark: SparkSession, root: str) -> int:
    """Events and shot locations -> the mart; only the parts with games that changed are written, by game and period.

    Returns how many parts were written.
    """

    def make(parts: DataFrame) -> DataFrame:
        event = sinks.read_parts(spark, root, "silver", "event", f"{schemas.EVENT}, bucket INT", sinks.MART_KEYS, parts)
        games = _games_of(spark, root, "silver", "shot_location", parts)
        shots = sinks.read_games(spark, root, "silver", "shot_location", schemas.SHOT_LOCATION, games)
        return gold.events_with_location(event, shots)

    sources = [("mart", "silver", "event"), ("games", "silver", "shot_location")]
    return _rebuild(spark, root, "gold", "events_with_location", sources, make, ["game_id", "period", "event_id"])


def advance_history(spark: SparkSession, root: str, roster: DataFrame, seasons) -> list[int]:
    """A batch of roster rows -> the lake's roster history, where only the batch's buckets of players are replaced.

    Returns these buckets. The first batch opens the history.
    """
    season = conformed.dim_season(spark, seasons)
    _known_seasons(roster, season)
    return history.advance(spark, root, scd2.open_stints(roster, season))


def advance_rosters(spark: SparkSession, snapshot: str, roster: DataFrame, target: str, seasons) -> None:
    """Roster snapshot and a batch of roster rows -> the next snapshot, written beside the old one."""
    if snapshot.rstrip("/") == target.rstrip("/"):
        raise ValueError("the next snapshot needs a path of its own")
    current = files.read_table(spark, snapshot, schemas.PLAYER_TEAM_SEASON)
    season = conformed.dim_season(spark, seasons)
    _known_seasons(roster, season)
    batch = scd2.open_stints(roster, season)
    sinks.write_clustered(scd2.apply_batch(current, batch), target, [], ["player_id"])
