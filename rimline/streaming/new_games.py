"""Newly landed tracking documents as a file stream: each document is picked up once."""

import hashlib

from pyspark.sql import DataFrame, SparkSession

from rimline import schemas
from rimline.operators.moments import decode_events, raw_event_rows
from rimline.sinks.tables import WINDOW_ROW_GROUP_BYTES, dataset_path, note_games, write_games


def land_new_documents(spark: SparkSession, root: str, checkpoint: str, files_per_batch: int = 1000):
    """Start a stream that lands every document not seen yet as event windows, then stops.

    A batch's run is named by the stream and the batch, so one that is repeated after a failure replaces its own
    folder and leaves the same result.
    """
    documents = (
        spark.readStream.schema(schemas.TRACKING_DOCUMENT)
        .option("multiLine", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(dataset_path(root, "bronze", "tracking"))
    )
    target = dataset_path(root, "bronze", "tracking_event")

    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def land(batch: DataFrame, batch_id: int) -> None:
        rows = decode_events(raw_event_rows(batch))
        run = f"stream-{stream}-{batch_id:08d}"
        write_games(rows, target, run, gather=False, row_group_bytes=WINDOW_ROW_GROUP_BYTES)
        # A document is read again for its keys only; documents without events are noted, too.
        note_games(batch.sparkSession, batch.select("season", "game_id"), run, root, "bronze", ["tracking_event"])

    return (
        documents.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(land)
        .start()
    )
