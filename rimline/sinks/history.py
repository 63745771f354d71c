"""Roster history in parts: open stints by bucket of players, closed ones by the run that closed them.

A closed stint never changes, so what a batch closes is added beside earlier runs' files, which stay as they are. Open stints of a
bucket are replaced as a whole, and only where the batch has players of that bucket. One batch of ledger lines makes the new state
visible at once, after all rows are written.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimline import schemas
from rimline.operators import scd2
from rimline.sinks import ledger
from rimline.sinks.tables import dataset_path, new_run

#: Buckets of players. A batch of few players touches few of them.
BUCKETS = 256
OPEN, CLOSED = "open", "closed"
LAYER, DATASET = "conformed", "roster_history"
_KEYS = ["is_current", "bucket"]


def player_bucket(player_id: Column) -> Column:
    return F.pmod(F.xxhash64(player_id.cast("bigint")), F.lit(BUCKETS)).cast("int")


def _stored(spark: SparkSession, root: str, runs: list[str]) -> DataFrame:
    path = dataset_path(root, LAYER, DATASET)
    reader = spark.read.schema(f"{schemas.PLAYER_TEAM_SEASON}, bucket INT, run STRING")
    return reader.option("basePath", path).option("pathGlobFilter", "*.parquet").parquet(*(f"{path}/run={run}" for run in runs))


def _parts(spark: SparkSession, root: str) -> tuple[dict[int, str], list[str]]:
    """(run of each bucket's open stints, runs with closed ones): at most a row for each bucket and run comes to the driver."""
    found = ledger.lines(spark, root, LAYER, DATASET).where("done").collect()
    return {int(r.game_id): r.run for r in found if r.season == OPEN}, sorted(r.run for r in found if r.season == CLOSED)


def read_history(spark: SparkSession, root: str, buckets: list[int] | None = None) -> DataFrame:
    """All stints, or those of some buckets of players, whose files alone are opened."""
    current, closing = _parts(spark, root)
    wanted = sorted(current if buckets is None else set(buckets))
    columns = [F.col(c) for c in spark.createDataFrame([], schemas.PLAYER_TEAM_SEASON).columns]
    none = spark.createDataFrame([], schemas.PLAYER_TEAM_SEASON)
    by_run: dict[str, list[int]] = {}
    for bucket in wanted:
        if bucket in current:
            by_run.setdefault(current[bucket], []).append(bucket)
    rows = none
    if by_run:
        held = F.lit(False)
        for run, own in sorted(by_run.items()):
            held = held | ((F.col("run") == run) & F.col("bucket").isin(own))
        rows = rows.unionByName(_stored(spark, root, sorted(by_run)).where(F.col("is_current") & held).select(columns))
    if closing:
        closed = _stored(spark, root, closing).where("NOT is_current")
        rows = rows.unionByName((closed if buckets is None else closed.where(F.col("bucket").isin(wanted))).select(columns))
    return rows


def advance(spark: SparkSession, root: str, batch: DataFrame) -> list[int]:
    """Take a batch of open stints into the history; the buckets that it touches.

    Stints of other buckets are neither read nor written, and closed stints never written again. The rows are those of
    ``scd2.apply_batch`` over the whole history. A batch that is run twice changes nothing more, unless it has a player in two teams.
    """
    bucket = player_bucket(F.col("player_id"))
    touched = sorted(r.bucket for r in batch.select(bucket.alias("bucket")).distinct().collect())
    if not touched:
        return []
    before = read_history(spark, root, touched)
    current = before.where("is_current")
    after = scd2.expire(current, batch).unionByName(scd2.inserted(before, batch))
    run = new_run()
    rows = after.withColumn("bucket", bucket).hint("rebalance", *_KEYS).sortWithinPartitions(*_KEYS, "player_id")
    rows.write.partitionBy(*_KEYS).parquet(f"{dataset_path(root, LAYER, DATASET)}/run={run}")
    lines = [(OPEN, str(b)) for b in touched] + [(CLOSED, run)]
    ledger.add(spark, spark.createDataFrame(lines, "season STRING, game_id STRING"), run, root, LAYER, DATASET, True)
    return touched
