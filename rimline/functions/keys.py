"""Keys: game ids, seasons, surrogate keys and labels. All are built-in expressions."""

from pyspark.sql import Column, functions as F

from rimline.constants import GAME_ID_LENGTH


def canonical_game_id(game_id: Column) -> Column:
    """Integer or text id as the 10-character zero-padded key."""
    return F.lpad(game_id.cast("string"), GAME_ID_LENGTH, "0")


def season_start_year(game_id: Column) -> Column:
    """Season start year from characters 4-5 of the key; years under 50 are 20xx.

    An id without digits there gives NULL, so one bad row cannot stop a large job.
    """
    yy = F.substring(game_id, 4, 2).try_cast("int")
    return F.when(yy < 50, yy + 2000).otherwise(yy + 1900)


def season_label(start_year: Column) -> Column:
    """2015 -> '2015-16', 1999 -> '1999-00'."""
    following = F.lpad(((start_year + 1) % 100).cast("string"), 2, "0")
    return F.concat(start_year.cast("string"), F.lit("-"), following)


def year_of_label(season: Column) -> Column:
    """'2015-16' -> 2015."""
    return F.substring(season, 1, 4).try_cast("int")


def stint_key(season_id: Column, team_id: Column, player_id: Column) -> Column:
    """Deterministic BIGINT key of a stint: the first 60 bits of an md5 digest."""
    text = F.concat_ws("|", season_id.cast("string"), team_id.cast("string"), player_id.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def game_label(away: Column, home: Column, game_date: Column) -> Column:
    """'AWAY @ HOME · DATE'."""
    return F.concat(away, F.lit(" @ "), home, F.lit(" · "), game_date.cast("string"))
