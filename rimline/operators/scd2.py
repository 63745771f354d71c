"""Effective-dated roster history. Each operator maps one snapshot to the next."""

from pyspark.sql import DataFrame, functions as F

from rimline.functions.keys import stint_key
from rimline.operators.ranking import first_per_key

STINT = ["player_id", "team_id", "season_id"]


def open_stints(roster: DataFrame, seasons: DataFrame) -> DataFrame:
    """Distinct stints of a roster as open rows that start with their season."""
    stints = roster.select("season_id", "team_id", "player_id").distinct()
    return stints.join(seasons.select("season_id", "start_date"), "season_id").select(
        stint_key(F.col("season_id"), F.col("team_id"), F.col("player_id")).alias("player_team_season_id"),
        "player_id",
        "team_id",
        "season_id",
        F.col("start_date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def season_orphans(roster: DataFrame, seasons: DataFrame) -> DataFrame:
    """Roster rows whose season the calendar does not have."""
    return roster.join(seasons.select("season_id"), "season_id", "left_anti")


def _change_dates(batch: DataFrame) -> DataFrame:
    """Per player, the two earliest teams of a batch.

    For any team these two answer "when does the batch first show another team", so the join
    below meets one row per player and never multiplies a player's stints.
    """
    starts = batch.groupBy("player_id", "team_id").agg(F.min("valid_from").alias("valid_from"))
    earliest = first_per_key(starts, ["player_id"], [F.col("valid_from"), F.col("team_id")], n=2)
    entry = F.struct("valid_from", "team_id")
    both = earliest.groupBy("player_id").agg(
        F.min(entry).alias("first"), F.max(entry).alias("second"), F.count("*").alias("n")
    )
    return both.select(
        "player_id",
        F.col("first.team_id").alias("first_team_id"),
        F.col("first.valid_from").alias("first_from"),
        F.when(F.col("n") == 2, F.col("second.valid_from")).alias("second_from"),
    )


def expire(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Close current stints whose player shows another team in the batch.

    A closed stint ends the day before the earliest such start.
    """
    changed = current.join(_change_dates(batch), "player_id", "left")
    start = F.when(F.col("first_team_id") != F.col("team_id"), F.col("first_from")).otherwise(F.col("second_from"))
    closing = F.col("is_current") & start.isNotNull()
    columns = {
        "valid_to": F.when(closing, F.date_sub(start, 1)).otherwise(F.col("valid_to")),
        "is_current": F.when(closing, False).otherwise(F.col("is_current")),
    }
    return changed.withColumns(columns).select(*current.columns)


def expired(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Only the stints that the batch closes."""
    return expire(current.where("is_current"), batch).where("NOT is_current")


def inserted(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch stints that the snapshot does not hold yet.

    The snapshot first shrinks to the stints of the batch's players, by a list that Spark broadcasts while it
    is small; only what is left meets the batch.
    """
    players = batch.select("player_id").distinct()
    of_batch = current.select(*STINT).join(players, "player_id", "left_semi")
    return batch.join(of_batch, STINT, "left_anti").select(*current.columns)


def apply_batch(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Next snapshot: expire, then insert. Running a batch twice changes nothing more.

    Closed stints are carried over as they are; only their keys are looked at, for players of the batch.
    """
    is_open = F.col("is_current").eqNullSafe(True)
    return (
        current.where(~is_open)
        .unionByName(expire(current.where(is_open), batch))
        .unionByName(inserted(current, batch))
    )


def inverted_stints(snapshot: DataFrame) -> DataFrame:
    """Stints that end before they start, as a move inside one season gives."""
    return snapshot.where("valid_to < valid_from")
