"""What each run of a job counted, kept beside the index: rows written, rows left out, shots located.

Counts are observed on the rows as they are written, so they cost no read of their own unless none was written.
"""

import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

REPORT = "job STRING, run STRING, at BIGINT, game_id STRING, measure STRING, value BIGINT"


def _path(root: str) -> str:
    return f"{str(root).rstrip('/')}/ledger/reports"


def observed(rows: DataFrame, *counts: Column) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The rows, and a function that gives their counts once they have been written.

    Where a shuffle behind the rows turns out empty, Spark leaves out the steps before it, and what they observed is
    lost. The rows may still be many, all filtered out; so they are then counted by a read of their own.
    """
    seen = Observation()

    def found() -> dict[str, int]:
        try:
            return seen.get
        except Py4JJavaError as error:
            if error.java_exception.getClass().getName() != "java.lang.AssertionError":
                raise
        return rows.agg(*counts).first().asDict()

    return rows.observe(seen, *counts), found


def note(spark: SparkSession, root: str, job: str, run: str, counts: dict[str, int], by_game: dict[str, DataFrame] | None = None) -> None:
    """Add a run's counts, and counts by game from frames of (game_id, value)."""
    at = time.time_ns()
    rows = spark.createDataFrame([(job, run, at, None, name, value) for name, value in counts.items()], REPORT)
    for name, frame in (by_game or {}).items():
        own = frame.toDF("game_id", "value").selectExpr(f"'{job}' job", f"'{run}' run", f"{at}L at", "game_id", f"'{name}' measure", "bigint(value) value")
        rows = rows.unionByName(own)
    rows.coalesce(1).write.mode("append").parquet(_path(root))


def read(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REPORT).parquet(_path(root))
