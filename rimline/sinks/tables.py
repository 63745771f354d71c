"""Sinks: per-game partitions in a folder per run, full rebuilds, and which games are finished."""

import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rimline.functions.keys import season_start_year
from rimline.sinks import ledger

GAME_KEYS = ["season", "game_id"]
_KEYS_DDL = "season STRING, game_id STRING"
# Event windows are wide rows; small row groups bound the memory of one read batch.
WINDOW_ROW_GROUP_BYTES = 32 * 1024 * 1024


def dataset_path(root: str, layer: str, dataset: str) -> str:
    """Where a table of the lake lies; per-game tables have season and game directories inside."""
    lake = str(root)
    while lake.endswith("/"):
        lake = lake[:-1]
    return f"{lake}/{layer}/{dataset}"


def new_run() -> str:
    """A name for a run's folders, which sorts by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write_games(
    df: DataFrame, path: str, run: str, sort_by: list[str] | None = None, gather: bool = True, row_group_bytes: int | None = None
) -> None:
    """Write the rows of games into the run's folder of a table, a directory per game inside.

    Readers see the games once the ledger names the run; a run that broke off is never read. A repeated run replaces its
    folder. ``gather`` brings the rows of a game together, so a game is a few files rather than one
    per task; Spark splits a game that is too large for one task. Frames that already arrive
    game by game skip it.
    """
    rows = df.hint("rebalance", *GAME_KEYS) if gather else df
    if sort_by:
        rows = rows.sortWithinPartitions(*GAME_KEYS, *sort_by)
    writer = rows.write.mode("overwrite")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.partitionBy(*GAME_KEYS).parquet(f"{path}/run={run}")


def write_clustered(df: DataFrame, path: str, partition_by: list[str], cluster_by: list[str]) -> None:
    """Rebuild a table, files ordered by ``cluster_by`` so that a read of one game opens few of them.

    Ranges split a large game over tasks. The input partition number is the last range
    column, so even many equal rows spread out. The new table is written beside the old one and
    takes its place when it is whole, so a failed rebuild leaves the old table as it was.
    """
    order = [*partition_by, *cluster_by]
    ranged = df.withColumn("_part", F.spark_partition_id()).repartitionByRange(*order, "_part").drop("_part")
    beside = f"{path}__next"
    writer = ranged.sortWithinPartitions(*order).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(beside)
    _take_place(df.sparkSession, beside, path)


#: Buckets of games in a season of a mart.
GAME_BUCKETS = 64
MART_KEYS = ["season_start_year", "bucket"]


def game_bucket(game_id: Column) -> Column:
    return F.pmod(F.xxhash64(game_id), F.lit(GAME_BUCKETS)).cast("int")


def write_parts(df: DataFrame, path: str, run: str, keys: list[str], sort_by: list[str]) -> None:
    """Write the rows of some parts of a table into the run's folder, a part's rows together and ordered."""
    rows = df.hint("rebalance", *keys).sortWithinPartitions(*keys, *sort_by)
    rows.write.mode("overwrite").partitionBy(*keys).parquet(f"{path}/run={run}")


def read_parts(
    spark: SparkSession, root: str, layer: str, dataset: str, schema: str, keys: list[str], wanted: DataFrame | None = None
) -> DataFrame:
    """The rows of a table's parts, of each those of the run that its ledger line names; with ``wanted`` (season, game_id) only theirs.

    ``schema`` holds the keys, which come from directory names. As many names of runs come to the driver as the parts are from.
    """
    path = dataset_path(root, layer, dataset)
    live = ledger.lines(spark, root, layer, dataset).where("done")
    if wanted is not None:
        live = live.join(wanted, GAME_KEYS, "left_semi")
    runs = sorted(row.run for row in live.select("run").distinct().collect())
    if not runs:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(f"{schema}, run STRING").option("basePath", path).option("pathGlobFilter", "*.parquet")
    rows = stored.parquet(*(f"{path}/run={run}" for run in runs))
    kinds = dict(rows.dtypes)
    named = [F.col(own).cast(kinds[key]).alias(key) for own, key in zip(GAME_KEYS, keys)]
    return rows.join(live.select("run", *named), ["run", *keys], "left_semi").select([c for c in rows.columns if c != "run"])


def read_mart(spark: SparkSession, root: str, layer: str, dataset: str, schema: str, game_id: str | None = None) -> DataFrame:
    """A table laid out by season and bucket of games; with ``game_id`` only the one bucket that holds the game is opened."""
    rows = read_parts(spark, root, layer, dataset, f"{schema}, bucket INT", MART_KEYS)
    if game_id is not None:
        game = F.lit(game_id)
        rows = rows.where((F.col("season_start_year") == season_start_year(game)) & (F.col("bucket") == game_bucket(game)))
    return rows.drop("bucket")


def mart_parts(games: DataFrame) -> DataFrame:
    """(season, game_id) names of the mart parts that hold the games, and when their lines are from."""
    start, bucket = season_start_year(F.col("game_id")), game_bucket(F.col("game_id"))
    return games.select(start.cast("string").alias("season"), bucket.cast("string").alias("part"), *[c for c in games.columns if c != "season"])


def stale_parts(spark: SparkSession, sources: list[tuple[str, str, str]], root: str, layer: str, dataset: str) -> DataFrame:
    """(season, game_id) names of the mart parts with games of the sources (kind, layer, dataset) that changed after the part was written.

    Kinds of sources: ``games`` for per-game tables, ``mart`` for tables with the same parts. Reads ledgers only.
    """
    changed = []
    for kind, own_layer, own in sources:
        lines = ledger.lines(spark, root, own_layer, own)
        named = mart_parts(lines).select("season", F.col("part").alias("game_id"), "at") if kind == "games" else lines.select(*GAME_KEYS, "at")
        changed.append(named)
    newest = reduce(lambda a, b: a.union(b), changed).groupBy(*GAME_KEYS).agg(F.max("at").alias("changed"))
    built = ledger.lines(spark, root, layer, dataset).select(*GAME_KEYS, "at")
    return newest.join(built, GAME_KEYS, "left").where("at IS NULL OR changed >= at").select(*GAME_KEYS)


def _take_place(spark: SparkSession, beside: str, path: str) -> None:
    system, new = ledger.file_system(spark, beside)
    _, here = ledger.file_system(spark, path)
    _, old = ledger.file_system(spark, f"{path}__old")
    system.delete(old, True)
    if system.exists(here) and not system.rename(here, old):
        raise OSError(f"cannot move {path} aside")
    if not system.rename(new, here):
        raise OSError(f"cannot move {beside} to {path}")
    system.delete(old, True)


def read_games(
    spark: SparkSession, root: str, layer: str, dataset: str, schema: str, games: DataFrame | None = None
) -> DataFrame:
    """The rows of a per-game table: of each finished game those of the run that its ledger line names.

    With ``games`` only theirs. Only the folders of runs that hold such games are listed, and Spark skips other games'
    directories at run time where the list is short enough to broadcast. The names of these runs come to the driver.
    """
    path = dataset_path(root, layer, dataset)
    live = ledger.lines(spark, root, layer, dataset).where("done").select("run", *GAME_KEYS)
    if games is not None:
        live = live.join(games.select("game_id").distinct(), "game_id", "left_semi")
    runs = sorted(row.run for row in live.select("run").distinct().collect())
    # A run of games without any rows has written no folder of rows.
    if not runs:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(f"{schema}, run STRING").option("basePath", path).option("pathGlobFilter", "*.parquet")
    rows = stored.parquet(*(f"{path}/run={run}" for run in runs))
    return rows.join(live, ["run", *GAME_KEYS], "left_semi").drop("run")


def written_games(spark: SparkSession, path: str, run: str) -> DataFrame:
    """``(season, game_id)`` of the games that have rows in a run's folder."""
    stored = spark.read.schema(f"{_KEYS_DDL}, run STRING").option("basePath", path).option("pathGlobFilter", "*.parquet")
    return stored.parquet(f"{path}/run={run}").select(*GAME_KEYS).distinct()


def note_games(
    spark: SparkSession, games: DataFrame, run: str | None, root: str, layer: str, datasets: list[str], done: bool = True
) -> None:
    """Add a line per game and dataset to the ledger. The latest line of a game holds.

    Written after the rows, so a game is finished only if all its rows are there; games noted as not done have none.
    """
    for dataset in datasets:
        ledger.add(spark, games, run, root, layer, dataset, done)


def finished_games(spark: SparkSession, root: str, layer: str, dataset: str) -> DataFrame:
    """``(season, game_id)`` of games whose rows are all written, games without any rows included."""
    return ledger.lines(spark, root, layer, dataset).where("done").select(*GAME_KEYS)


def sweep(spark: SparkSession, root: str, layer: str, dataset: str) -> list[str]:
    """Delete the folders of runs that no finished game is read from any more, broken-off ones included; their names.

    Not to be called while a job writes the table: a run is named in the ledger after its rows are there.
    """
    path = dataset_path(root, layer, dataset)
    live = ledger.lines(spark, root, layer, dataset).where("done").select("run").distinct()
    used = {f"run={row.run}" for row in live.collect()}
    stale = [name for name in ledger.children(spark, path) if name.startswith("run=") and name not in used]
    for name in stale:
        ledger.delete(spark, f"{path}/{name}")
    return stale


def pending_games(
    spark: SparkSession, manifest: DataFrame, root: str, layer: str, datasets: list[str], force: bool = False
) -> DataFrame:
    """Manifest games that lack at least one of the outputs; with ``force`` all of them.

    Reads the ledger alone, whose files are picked here once, so the list stays as it is while the job notes
    its own games.
    """
    if force:
        return manifest
    complete = [finished_games(spark, root, layer, dataset).select("game_id") for dataset in datasets]
    every = reduce(lambda a, b: a.join(b, "game_id", "left_semi"), complete)
    return manifest.join(every, "game_id", "left_anti")
