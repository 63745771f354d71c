"""The index of a table's parts: which run's folder holds the rows of each part, and which parts are finished.

A part is named by two keys, here ``season`` and ``game_id``: of per-game tables they are just these, of marts a season and a
bucket of games, of the roster history a state and a bucket of players.

A table's index is a log of small batches, one per run, and a snapshot of the latest line of each game, written anew once the log
has grown. Jobs read the newest whole snapshot and what the log holds, and never the table's directory tree, so the check
for pending games costs the same however the tables grow. A batch is folded in whole and stays until the next snapshot after the one
that holds it is written, and that snapshot's predecessor stays as long; so a snapshot that is lost, or was never finished, loses
no line. Lines may be read twice, as the latest of a game holds.
"""

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

LINE = "season STRING, game_id STRING, run STRING, at BIGINT, done BOOLEAN"
#: Batches in the log that bring about a new snapshot.
COMPACT_AFTER = 32


def file_system(spark: SparkSession, path: str):
    """The file system that holds the path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there."""
    system, where = file_system(spark, path)
    if not system.exists(where):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(where))


def delete(spark: SparkSession, path: str) -> None:
    system, where = file_system(spark, path)
    system.delete(where, True)


def index_path(root: str, layer: str, dataset: str) -> str:
    return f"{str(root).rstrip('/')}/ledger/{layer}_{dataset}"


def _name() -> str:
    """Sorts by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _whole(spark: SparkSession, path: str) -> bool:
    system, marker = file_system(spark, f"{path}/_SUCCESS")
    return system.exists(marker)


def _snapshots(spark: SparkSession, index: str) -> list[str]:
    """Paths of the whole snapshots, oldest first. A snapshot's lines are its last write."""
    found = [f"{index}/snapshot/{name}" for name in children(spark, f"{index}/snapshot")]
    return [path for path in found if _whole(spark, f"{path}/lines")]


def _batches(spark: SparkSession, index: str) -> list[str]:
    found = [f"{index}/log/{name}" for name in children(spark, f"{index}/log")]
    return [path for path in found if _whole(spark, path)]


def lines(spark: SparkSession, root: str, layer: str, dataset: str) -> DataFrame:
    """The latest line of each game. The files are picked here, so the rows stay as they are while a job adds its own."""
    index = index_path(root, layer, dataset)
    # The log first: a batch that goes meanwhile is in a snapshot that is there by then.
    log = _batches(spark, index)
    paths = [*(f"{path}/lines" for path in _snapshots(spark, index)[-1:]), *log]
    if not paths:
        return spark.createDataFrame([], LINE)
    return _latest(spark.read.schema(LINE).parquet(*paths))


def _latest(found: DataFrame) -> DataFrame:
    latest = found.groupBy("season", "game_id").agg(F.max(F.struct("at", "done", "run")).alias("last"))
    return latest.select("season", "game_id", "last.run", "last.at", "last.done")


def add(
    spark: SparkSession, games: DataFrame, run: str | None, root: str, layer: str, dataset: str, done: bool, at: int | None = None
) -> None:
    """A line for each game; written after its rows, so a finished game's rows are all there.

    ``at`` is the time that the lines stand for: now, or when a job that depends on other tables looked at them.
    """
    index = index_path(root, layer, dataset)
    own = games.select("season", "game_id").distinct()
    own = own.withColumns({"run": F.lit(run).cast("string"), "at": F.lit(at or time.time_ns()), "done": F.lit(done)})
    own.write.parquet(f"{index}/log/{_name()}")
    if len(_batches(spark, index)) >= COMPACT_AFTER + len(_folded(spark, index)):
        compact(spark, root, layer, dataset)


def _folded(spark: SparkSession, index: str) -> set[str]:
    """Names of batches that the newest snapshot holds and that are still in the log."""
    newest = _snapshots(spark, index)[-1:]
    if not newest:
        return set()
    there = set(children(spark, f"{index}/log"))
    return {row.name for row in spark.read.schema("name STRING").parquet(f"{newest[0]}/batches").collect()} & there


def compact(spark: SparkSession, root: str, layer: str, dataset: str) -> None:
    """Write a snapshot of all lines; then drop what the one before it had folded in, and all older ones."""
    index = index_path(root, layer, dataset)
    log, before, folded = _batches(spark, index), _snapshots(spark, index), _folded(spark, index)
    target = f"{index}/snapshot/{_name()}"
    names = [(path.rpartition("/")[2],) for path in log]
    spark.createDataFrame(names, "name STRING").coalesce(1).write.parquet(f"{target}/batches")
    lines(spark, root, layer, dataset).write.parquet(f"{target}/lines")
    for name in folded:
        delete(spark, f"{index}/log/{name}")
    for path in before[:-1]:
        delete(spark, path)
