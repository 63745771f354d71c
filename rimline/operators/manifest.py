"""The game manifest: subsets, missing games and scoping of play-by-play rows."""

from pyspark.sql import DataFrame, functions as F

from rimline.functions.keys import canonical_game_id


def manifest_subset(manifest: DataFrame, requested: DataFrame) -> DataFrame:
    """Manifest rows whose ``game_id`` is requested."""
    return manifest.join(requested, "game_id", "left_semi")


def missing_games(requested: DataFrame, manifest: DataFrame) -> DataFrame:
    """Requested ids that the manifest does not know."""
    return requested.select("game_id").distinct().join(manifest, "game_id", "left_anti")


def pbp_of_games(pbp: DataFrame, manifest: DataFrame) -> DataFrame:
    """Play-by-play rows of manifest games, otherwise unchanged.

    The raw id becomes the canonical ``game_id`` and the manifest's season is added. The
    manifest side is one narrow row per game and Spark broadcasts it as long as it is small.
    """
    games = manifest.groupBy("game_id").agg(F.min("season").alias("season"))
    keyed = pbp.select(
        canonical_game_id(pbp["GAME_ID"]).alias("game_id"),
        *[pbp[c] for c in pbp.columns if c != "GAME_ID"],
    )
    return keyed.join(games, "game_id")


def games_without_rows(manifest: DataFrame, pbp: DataFrame) -> DataFrame:
    """Manifest games with no play-by-play row."""
    present = pbp.select(canonical_game_id(pbp["GAME_ID"]).alias("game_id")).distinct()
    return manifest.select("game_id").join(present, "game_id", "left_anti")
