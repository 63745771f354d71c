"""Tracking documents to event windows, moments and player positions."""

from pyspark.sql import Column, DataFrame, functions as F

from rimline.constants import BALL_ID
from rimline.operators.ranking import first_per_key

MOMENT_SIZE = 6
POSITION_SIZE = 5
# Windows of a game that are written by one task; a game has some 500.
BLOCK_WINDOWS = 128
# Timestamps are milliseconds; those that differ in their last 16 bits alone are of one minute.
MINUTE_BITS = 16


def _position(p: Column) -> Column:
    return F.struct(
        p[0].try_cast("bigint").alias("team_id"),
        p[1].try_cast("bigint").alias("player_id"),
        p[2].alias("x"),
        p[3].alias("y"),
        p[4].alias("z"),
    )


def _shape(positions: Column) -> Column:
    """Variant positions as lists, of which only the lengths are right; NULL where they can't be lists of numbers.

    Lists of nothing but numbers need no parsing for that, which is most of the time of a moment; all others are parsed.
    """
    kind = F.schema_of_variant(positions)
    plain = kind.isin("ARRAY<ARRAY<DOUBLE>>", "ARRAY<ARRAY<BIGINT>>") | kind.startswith("ARRAY<ARRAY<DECIMAL(")
    sizes = lambda lists: F.transform(lists, lambda p: F.size(p))
    return F.when(plain, sizes(positions.try_cast("array<array<variant>>"))).otherwise(sizes(_numbers(positions)))


def _numbers(positions: Column) -> Column:
    # By way of text: casting each variant number takes about twice as long.
    return F.from_json(positions.try_cast("string"), "array<array<double>>")


def _fits(moment: Column) -> Column:
    fits = (F.size(moment) == MOMENT_SIZE) & F.forall(_shape(F.get(moment, 5)), lambda n: n == POSITION_SIZE)
    return F.coalesce(fits, F.lit(False))


def well_formed(moments: Column) -> Column:
    """For each variant moment whether it is of the right length, and all its positions are."""
    return F.transform(moments, _fits)


def typed_moments(moments: Column) -> Column:
    """Well-formed variant moments as typed structs, in document order.

    Element order: period, timestamp, game clock, shot clock, unused, positions.
    """
    return F.transform(
        moments,
        lambda m: F.struct(
            F.get(m, 0).try_cast("int").alias("period"),
            F.get(m, 1).try_cast("bigint").alias("moment_id"),
            F.get(m, 2).try_cast("double").alias("game_clock"),
            F.get(m, 3).try_cast("double").alias("shot_clock"),
            F.transform(_numbers(F.get(m, 5)), _position).alias("positions"),
        ),
    )


def _read_at_once(moments: Column) -> Column:
    """A window's variant moments of the right length as numbers: lists of positions, period and timestamp, and clocks.

    Each is one text for the window, which takes less than half the time of a text for each moment and a cast for each scalar. A list is
    NULL where anything in it is no number of its kind.
    """
    sized = F.filter(moments, lambda m: F.size(m) == MOMENT_SIZE)
    numbers = lambda part, kind: F.from_json(F.to_json(F.transform(sized, part)), f"array<array<{kind}>>")
    return F.struct(
        moments.alias("moments"),
        F.size(sized).alias("n"),
        numbers(lambda m: F.get(m, 5), "array<double>").alias("positions"),
        numbers(lambda m: F.slice(m, 1, 2), "bigint").alias("whole"),
        numbers(lambda m: F.slice(m, 3, 2), "double").alias("clocks"),
    )


def _typed_at_once(read: Column) -> Column:
    """Typed moments of a window that was read whole; NULL where it could not be, or has positions of the wrong length."""
    fits = lambda ps: F.forall(ps, lambda p: F.size(p) == POSITION_SIZE)
    whole = [F.size(read[part]) == read["n"] for part in ("positions", "whole", "clocks")]
    typed = F.transform(
        read["positions"],
        lambda ps, i: F.struct(
            F.get(F.get(read["whole"], i), 0).try_cast("int").alias("period"),
            F.get(F.get(read["whole"], i), 1).alias("moment_id"),
            F.get(F.get(read["clocks"], i), 0).alias("game_clock"),
            F.get(F.get(read["clocks"], i), 1).alias("shot_clock"),
            F.transform(ps, _position).alias("positions"),
        ),
    )
    return F.when(whole[0] & whole[1] & whole[2] & F.forall(read["positions"], fits), typed)


def decode_events(raw_events: DataFrame) -> DataFrame:
    """Event rows with variant ``moments`` -> event rows with typed ones and a count of malformed ones.

    Moments and positions of the wrong length are left out and counted. A window of nothing but numbers is read at once, any other moment by
    moment. Both steps sit in one-row generators, so that a filter on their results, which exploding the moments brings along,
    cannot repeat them. They are exploded as structs, of which Spark works out the fields that are asked for: who wants the
    count alone gets no typed moments made.
    """
    others = [c for c in raw_events.columns if c != "moments"]
    read = raw_events.select(*others, F.explode(F.array(_read_at_once(F.col("moments")))).alias("read"))
    raw = F.col("read")["moments"]
    one_by_one = typed_moments(F.filter(raw, lambda m: _fits(m)))
    # The size of a missing array is NULL or -1, by session mode.
    malformed = F.greatest(F.size(F.filter(well_formed(raw), lambda fits: ~fits)), F.lit(0))
    decoded = F.struct(F.coalesce(_typed_at_once(F.col("read")), one_by_one).alias("moments"), malformed.cast("bigint").alias("malformed_moments"))
    typed = read.select(*others, F.explode(F.array(decoded)).alias("decoded"))
    return typed.select(*others, "decoded.moments", "decoded.malformed_moments")


def raw_event_rows(documents: DataFrame) -> DataFrame:
    """Tracking documents -> one row per listed event, numbered in document order."""
    listed = documents.select("season", "game_id", "gamedate", F.posexplode("events").alias("event_pos", "event"))
    return listed.select(
        "season",
        "game_id",
        "gamedate",
        F.col("event_pos").cast("bigint").alias("event_pos"),
        F.col("event.eventId").try_cast("bigint").alias("event_id"),
        "event.home",
        "event.visitor",
        "event.moments",
    )


def moment_rows(events: DataFrame) -> DataFrame:
    """Event windows -> one row per listed moment.

    The ball is found by id, not by place. It is taken out before any shuffle, so a caller
    that needs only the moments never moves the players.
    """
    listed = events.select("season", "game_id", "event_pos", F.posexplode("moments").alias("moment_pos", "m"))
    return listed.select(
        "season",
        "game_id",
        "event_pos",
        "moment_pos",
        "m.moment_id",
        "m.period",
        "m.game_clock",
        "m.shot_clock",
        F.get(F.filter("m.positions", lambda p: p["player_id"] == BALL_ID), 0).alias("ball"),
        "m.positions",
    )


def null_timestamp_counts(events: DataFrame) -> DataFrame:
    """Moments without a timestamp, per game; ``dedup_moments`` drops them.

    Reads only the timestamps of the windows.
    """
    nulls = F.size(F.filter("moments.moment_id", lambda t: t.isNull()))
    return (
        events.where("moments IS NOT NULL")
        .groupBy("game_id")
        .agg(F.sum(nulls).alias("dropped"))
        .where("dropped > 0")
    )


def dedup_moments(moments: DataFrame) -> DataFrame:
    """One row per ``(game_id, moment_id)``: the first listing in document order.

    Runs before the players are exploded. Overlapping windows of one game mostly sit in one
    input partition, so most copies are gone before the shuffle. The timestamp leads the key: rows are sorted by it, and
    games' ids would begin alike.
    """
    timed = moments.where("moment_id IS NOT NULL")
    return first_per_key(timed, ["moment_id", "game_id"], [F.col("event_pos"), F.col("moment_pos")])


def moment_table(deduped: DataFrame) -> DataFrame:
    return deduped.select(
        "game_id",
        "season",
        "moment_id",
        "period",
        "game_clock",
        "shot_clock",
        F.col("ball.x").alias("ball_x"),
        F.col("ball.y").alias("ball_y"),
        F.col("ball.z").alias("ball_z"),
    )


def _block() -> Column:
    """Windows that lie together in the written table: a game's, in runs of document order."""
    return F.floor(F.col("event_pos") / BLOCK_WINDOWS).alias("block")


def _first_places(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Pieces of windows with equal ``keys`` -> the same pieces with only those moments that no earlier place of theirs lists, too."""
    held = pieces.groupBy(*keys).agg(F.collect_list(F.struct("event_pos", "stamps", "places")).alias("held"))
    entry = lambda p: F.transform(p["stamps"], lambda t, i: F.struct(t.alias("t"), p["event_pos"].alias("w"), F.get(p["places"], i).alias("at")))
    placed = held.select(*keys, F.inline(F.array(F.struct(F.array_sort(F.flatten(F.transform("held", entry))).alias("e")))))
    later = lambda e, i: (i > 0) & (F.get("e", i - 1)["t"] == e["t"])
    first = placed.select(*keys, F.inline(F.array(F.struct(F.filter("e", lambda e, i: ~later(e, i)).alias("e")))))
    listed = first.select(*keys, "e", F.explode(F.array_distinct(F.transform("e", lambda e: e["w"]))).alias("event_pos"))
    mine = listed.select(*keys, "event_pos", F.inline(F.array(F.struct(F.filter("e", lambda e: e["w"] == F.col("event_pos")).alias("e")))))
    return mine.select(*keys, "event_pos", F.col("e.t").alias("stamps"), F.col("e.at").alias("places"))


def _bits(places: Column) -> Column:
    """Places as bits of 64-bit words."""
    word = lambda w: F.aggregate(
        F.filter(places, lambda p: F.shiftright(p, 6) == w), F.lit(0).cast("bigint"), lambda a, p: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), p.bitwiseAND(63)))
    )
    return F.transform(F.sequence(F.lit(0), F.shiftright(F.array_max(places), 6)), word)


def _has_bit(words: Column, place: Column) -> Column:
    return F.call_function("shiftright", F.get(words, F.shiftright(place, 6)), place.bitwiseAND(63)).bitwiseAND(F.lit(1).cast("bigint")) == 1


def survivors(events: DataFrame) -> DataFrame:
    """Which listings ``dedup_moments`` keeps, by block of windows: from each window the places of its moments that are first.

    Only timestamps are read and moved. A window is cut where a minute of some 65 s ends; pieces of one minute meet, each a row that
    lists its timestamps as 16-bit numbers. Those of a block meet first, so that of copies in any number few are left for
    the game's minute.
    """
    of_game = ["season", "game_id"]
    windows = events.where("event_pos IS NOT NULL").select(*of_game, "event_pos", F.col("moments.moment_id").alias("t"))
    minute = lambda t: F.shiftright(t, MINUTE_BITS)
    minutes = F.array_compact(F.array_distinct(F.transform("t", minute)))
    cut = windows.select("*", F.explode(minutes).alias("minute"))
    inside = cut.select(
        *of_game, "event_pos", "minute", _block(), F.col("t"),
        F.filter(F.sequence(F.lit(0), F.size("t") - 1), lambda i: minute(F.get("t", i)) == F.col("minute")).alias("places"),
    )
    # From the middle of the minute, so that the numbers are signed ones of 16 bits.
    middle = F.shiftleft("minute", MINUTE_BITS) + F.lit(1 << MINUTE_BITS - 1)
    pieces = inside.select(*of_game, "event_pos", "minute", "block", F.transform("places", lambda i: (F.get("t", i) - middle).cast("smallint")).alias("stamps"), "places")
    of_block = _first_places(pieces, [*of_game, "minute", "block"])
    first = _first_places(of_block.drop("block"), [*of_game, "minute"])
    kept = first.select(*of_game, _block(), F.struct("event_pos", _bits(F.col("places")).alias("bits")).alias("kept"))
    return kept.groupBy(*of_game, "block").agg(F.collect_list("kept").alias("kept"))


def _not_ball(p: Column) -> Column:
    return ~p["player_id"].eqNullSafe(BALL_ID)


def _people(moments: Column) -> Column:
    """A window's positions but the ball's, each with the place of its moment, field by field: equal or near values lie together."""
    of_moment = F.transform(
        moments,
        lambda m, i: F.transform(
            F.filter(m["positions"], _not_ball), lambda p: F.struct(i.alias("at"), p["team_id"], p["player_id"], p["x"], p["y"])
        ),
    )
    return F.flatten(F.filter(of_moment, lambda positions: positions.isNotNull()))


def player_locations(events: DataFrame) -> DataFrame:
    """Event windows -> one row per player position of each first listing, laid out for the written table.

    ``(game_id, event_pos)`` is a window's key. Windows move once, by game and block, where they meet the survivors, and their
    positions are taken out after that: what leaves the join is already together by game, so it can be written
    as it is. A game of any length is dealt out by its blocks, and copies of a moment are in windows of their own,
    so no group of them meets in one task. A window moves as timestamps and one array for each field of its positions.
    """
    people = events.select("season", "game_id", "event_pos", _block(), "moments.moment_id", F.inline(F.array(F.struct(_people(F.col("moments")).alias("people")))))
    fields = ["at", "team_id", "player_id", "x", "y"]
    windows = people.select("season", "game_id", "event_pos", "block", "moment_id", *[F.col(f"people.{f}").alias(f) for f in fields])
    # Windows pass by the survivors unsorted, as sorting would hold or spill them whole.
    met = windows.join(survivors(events).hint("shuffle_hash"), ["season", "game_id", "block"])
    # A window that lies in several minutes has places from each.
    either = lambda a, b: F.zip_with(a, b, lambda x, y: F.coalesce(x, y).bitwiseOR(F.coalesce(y, x)))
    of_window = F.filter("kept", lambda k: k["event_pos"] == F.col("event_pos"))["bits"]
    mine = met.withColumn("kept", F.aggregate(of_window, F.array().cast("array<bigint>"), either)).where(F.size("kept") > 0)
    # Only places are listed, and the fields looked up there: those that nobody asks for never move.
    nth = F.sequence(F.lit(0), F.size("at") - 1)
    listed = mine.where(F.size("at") > 0).select("season", "game_id", "moment_id", "kept", *fields[1:], F.inline(F.arrays_zip("at", nth.alias("nth"))))
    return listed.where(_has_bit(F.col("kept"), F.col("at"))).select(
        "game_id",
        "season",
        F.get("moment_id", F.col("at")).alias("moment_id"),
        F.get("team_id", F.col("nth")).alias("team_id"),
        F.get("player_id", F.col("nth")).alias("player_id"),
        F.get("x", F.col("nth")).alias("player_x"),
        F.get("y", F.col("nth")).alias("player_y"),
    )


def player_location_table(deduped: DataFrame) -> DataFrame:
    """One row per player position of each kept moment; every listed position but the ball's stays."""
    positions = deduped.select("game_id", "season", "moment_id", F.inline("positions"))
    return positions.where(~F.col("player_id").eqNullSafe(BALL_ID)).select(
        "game_id",
        "season",
        "moment_id",
        "team_id",
        "player_id",
        F.col("x").alias("player_x"),
        F.col("y").alias("player_y"),
    )


def moment_players(moment: DataFrame, player_location: DataFrame) -> DataFrame:
    """Header/detail join of moments and player positions."""
    return moment.join(player_location.drop("season"), ["game_id", "moment_id"])


def last_listing(events: DataFrame) -> DataFrame:
    """One row per ``(game_id, event_id)``: the last listing in document order wins."""
    identified = events.where("event_id IS NOT NULL")
    return first_per_key(identified, ["game_id", "event_id"], [F.col("event_pos").desc()])


def malformed_counts(events: DataFrame) -> DataFrame:
    """Moments left out by the decoder, per game."""
    return (
        events.groupBy("game_id")
        .agg(F.sum("malformed_moments").alias("malformed"))
        .where("malformed > 0")
    )
