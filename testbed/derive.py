"""Domain-shaped views of the given tables.

The given tables hold no tracking data, so play-by-play rows, event windows, headers and
rosters are derived from every row of ``events``, ``orders``, ``customer``, ``part`` and
``nation``. Only integer arithmetic and dyadic fractions are used, so any engine gets the same
bits. ``oracle.py`` states the same rules in SQL.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rimline.functions.keys import canonical_game_id, season_label, season_start_year
from rimline.operators.trajectory import shot_attempts

# Frames in the window of an event.
FRAMES = 40
TEAM_BASE = 1610612737
PLAYER_BASE = 200000
# A literal calendar that lacks the later seasons of the rosters.
KNOWN_SEASONS = range(1990, 1997)
SERVED_GAME = "0021500000"


# The columns in use of the given tables.
GIVEN = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
    "orders": "o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "part": "p_partkey BIGINT",
    "nation": "n_nationkey INT, n_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_game_id(user: Column) -> Column:
    """Integer game id; users spread over the seasons 2015, 2014, 2000 and 1999."""
    bases = F.array(*[F.lit(b).cast("bigint") for b in (21500000, 21400000, 20000000, 29900000)])
    return F.get(bases, (user % 4).cast("int")) + user


def game_key(user: Column) -> Column:
    return canonical_game_id(raw_game_id(user))


def pbp_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw play-by-play row per event."""
    base = table(spark, sf_dir, "events").select(
        raw_game_id(F.col("user_id")).alias("GAME_ID"),
        F.col("user_id").alias("u"),
        F.col("event_id").alias("e"),
        "ts",
        F.expr("double(get(array(4, 4, 4, 5, 5, 2, 0), int(event_id % 7)))").alias("PERSON1TYPE"),
        F.expr(
            """event_type || CASE event_id % 5 WHEN 0 THEN ' 3PT Jump Shot' WHEN 1 THEN ' 3pt Jump Shot'
               ELSE ' Layup' END"""
        ).alias("text"),
    )
    with_first = base.withColumn(
        "PLAYER1_ID",
        F.expr(
            f"""CASE WHEN PERSON1TYPE IN (4, 5) THEN {PLAYER_BASE} + u * 10 + e % 10
                WHEN PERSON1TYPE = 2 THEN {TEAM_BASE} + u % 30 ELSE 0L END"""
        ),
    )
    return with_first.selectExpr(
        "GAME_ID",
        "e AS EVENTNUM",
        "int(1 + e % 18) AS EVENTMSGTYPE",
        "int(e % 100) AS EVENTMSGACTIONTYPE",
        "int(1 + e % 4) AS PERIOD",
        """CASE WHEN e % 97 = 0 THEN NULL WHEN e % 89 = 0 THEN 'n/a' WHEN e % 83 = 0 THEN '720'
           WHEN e % 79 = 0 THEN 'x:30'
           ELSE string(11 - minute(ts) % 12) || ':' || lpad(string(second(ts)), 2, '0') END AS PCTIMESTRING""",
        "IF(e % 3 = 0, text, NULL) AS HOMEDESCRIPTION",
        "IF(e % 3 = 2, 'neutral ' || text, NULL) AS NEUTRALDESCRIPTION",
        "IF(e % 3 = 1 OR e % 6 = 0, 'visitor ' || text, NULL) AS VISITORDESCRIPTION",
        "PERSON1TYPE",
        "PLAYER1_ID",
        "'Player ' || string(e % 10) AS PLAYER1_NAME",
        f"""CASE WHEN PERSON1TYPE = 4 THEN double({TEAM_BASE} + u % 30)
            WHEN PERSON1TYPE = 5 AND e % 10 = 7 THEN double('NaN')
            WHEN PERSON1TYPE = 5 THEN double({TEAM_BASE} + (u + 1) % 30) END AS PLAYER1_TEAM_ID""",
        "IF(e % 4 = 0, 5D, 0D) AS PERSON2TYPE",
        "IF(e % 4 = 0, PLAYER1_ID + 1, 0L) AS PLAYER2_ID",
        "IF(e % 4 = 0, 'Second', NULL) AS PLAYER2_NAME",
        f"IF(e % 4 = 0, double({TEAM_BASE} + (u + 2) % 30), NULL) AS PLAYER2_TEAM_ID",
        "IF(e % 9 = 0, 3D, 0D) AS PERSON3TYPE",
        f"IF(e % 9 = 0, {TEAM_BASE}L, 0L) AS PLAYER3_ID",
        "CAST(NULL AS STRING) AS PLAYER3_NAME",
        "CAST(NULL AS DOUBLE) AS PLAYER3_TEAM_ID",
    )


def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shot_attempts(pbp_raw(spark, sf_dir), canonical_game_id(F.col("GAME_ID")))


# Where windows were stored, by what they are and the tables they come from.
_STORED: dict[tuple[str, str], str] = {}


def store_windows(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write both kinds of windows once; from then on they are read from there, as jobs read landed ones."""
    for kind, made in (("typed", tracking_events), ("raw", raw_tracking_events)):
        made(spark, sf_dir).write.mode("overwrite").parquet(f"{folder}/{kind}")
    for kind in ("typed", "raw"):
        _STORED[kind, sf_dir] = f"{folder}/{kind}"


# Listed windows that one task makes at most, some 20 KB each, if Spark would deal them to fewer tasks.
TASK_WINDOWS = 25_000


def _windows(spark: SparkSession, sf_dir: str, kind: str, frame: Callable[[int], str]) -> DataFrame:
    """Two listings of each event's window, the first one 50 ft off; those of every 13th event are empty or missing.

    ``frame(i)`` is a window's frame i, NULL for one that is left out. Frames are columns of their own first, which Spark
    compiles one by one; the body of a lambda would be interpreted. They become an array inside a generator of one row,
    hence once per listing whatever is asked of it.
    """
    if (kind, sf_dir) in _STORED:
        return spark.read.parquet(_STORED[kind, sf_dir])
    listed = table(spark, sf_dir, "events").select("event_id", "user_id")
    game = game_key(F.col("user_id"))
    # A row becomes wide below, which Spark can't know: all cores get a share, and no task gets many.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * listed.count() // TASK_WINDOWS)
    placed = listed.repartition(tasks, "event_id").select(
        season_label(season_start_year(game)).alias("season"),
        game.alias("game_id"),
        "event_id",
        (PLAYER_BASE + F.col("user_id") * 10 + F.col("event_id") % 10).alias("shooter"),
        (TEAM_BASE + F.col("user_id") % 30).alias("team"),
        F.expr("double(5 + (37 * event_id) % 84)").alias("x0"),
        F.expr("double(2 + (13 * event_id) % 46)").alias("y0"),
        F.expr("IF(5 + (37 * event_id) % 84 <= 47, 5.25D, 88.75D)").alias("hx"),
        *[F.expr(value).alias(name) for name, value in _OF_EVENT.items()],
    )
    # The second listing of some events has no moments at all.
    listings = placed.select(
        "*",
        F.expr(
            """inline(array(named_struct('event_pos', 2 * event_id, 'shift', 50D, 'missing', false),
                            named_struct('event_pos', 2 * event_id + 1, 'shift', 0D, 'missing', NOT coalesce(event_id % 17 <> 0, false))))"""
        ),
    )
    keys = ["season", "game_id", "event_pos", "event_id"]
    framed = listings.select(*keys, "missing", "empty", *[F.expr(frame(i)).alias(f"frame_{i}") for i in range(FRAMES)])
    frames = F.array_compact(F.array(*[f"frame_{i}" for i in range(FRAMES)]))
    moments = F.when(F.col("missing"), None).when(F.col("empty"), F.array()).otherwise(frames)
    return framed.select(*keys, F.inline(F.array(F.struct(moments.alias("moments")))))


# Frame i of a shot: the ball rests, flies to the hoop from 12 to 28, then drops. What holds for all frames of an event; the
# numbers of frames are by the remainder at which something happens. On some events the clock stops when the ball is through the hoop.
_OF_EVENT = {
    "empty": "coalesce(event_id % 13 = 0, false)",
    "even": "coalesce(event_id % 2 = 0, false)",
    "low": "coalesce(event_id % 11 = 0, false)",
    "stops": "coalesce(event_id % 7 = 3, false)",
    "period": "CAST(1 + event_id % 4 AS INT)",
    "first_stamp": "1450000000000 + 10000 * event_id",
    "first_clock": "double(600 - event_id % 500)",
    "first_shot_clock": "IF(event_id % 6 <> 0, 24D, NULL)",
    "dx": "(1 - event_id % 3) / 4D",
    "dy": "(event_id % 3 - 1) / 8D",
    "unstamped": "int(pmod(-event_id, 31))",
    "without_ball": "int(pmod(-3 * event_id, 41))",
    "unseen": "int(pmod(-7 * event_id, 23))",
    "again": "int(pmod(-5 * event_id, 29))",
    # The frame whose raw form is one element short.
    "malformed": "int(pmod(-11 * event_id, 53))",
}


def _scalars(i: int) -> dict[str, str]:
    return {
        "period": "period",
        "moment_id": f"IF(unstamped <> {i % 31}, first_stamp + {40 * i}, NULL)",
        "game_clock": f"first_clock - {f'IF(stops, 3.5D, {i / 8}D)' if i > 28 else f'{i / 8}D'}",
        "shot_clock": f"first_shot_clock - {i / 8}D",
    }


def _positions(i: int, position: Callable[..., str]) -> str:
    """The positions of frame i, each made by ``position``: ball, shooter, defender, or the other way round."""
    t = 0.0 if i < 12 else 1.0 if i > 28 else (i - 12) / 16
    z = 10 - (i - 28) / 2 if i > 28 else 6 + 4 * t + 12 * t * (1 - t)
    sx, sy = f"x0 + {i - 12}D * dx + shift", f"y0 + {i - 12}D * dy"
    ball = f"array({position('-1L', '-1L', f'x0 + {t}D * (hx - x0) + shift', f'y0 + {t}D * (25D - y0)', f'IF(low, 5D, {z}D)')})"
    shooter = position("team", "shooter", sx, sy, "0D")
    twice = position("team", "shooter", f"{sx} + 1D", f"{sy} + 1D", "0D")
    defender = f"array({position('team + 1', 'shooter + 1', f'{sx} + 2D', f'{sy} + 1D', '0D')})"
    return f"""concat(
        CASE WHEN NOT even THEN {defender} WHEN without_ball <> {i} THEN {ball} ELSE array() END,
        CASE WHEN unseen = {i % 23} THEN array() WHEN again = {i % 29} THEN array({shooter}, {twice}) ELSE array({shooter}) END,
        CASE WHEN even THEN {defender} WHEN without_ball <> {i} THEN {ball} ELSE array() END)"""


def _typed_frame(i: int) -> str:
    position = "named_struct('team_id', {}, 'player_id', {}, 'x', {}, 'y', {}, 'z', {})".format
    scalars = ", ".join(f"'{name}', {value}" for name, value in _scalars(i).items())
    return f"IF(malformed <> {i}, named_struct({scalars}, 'positions', {_positions(i, position)}), NULL)"


def _raw_frame(i: int) -> str:
    absent = "parse_json('null')"
    position = "array(double({}), double({}), {}, {}, {})".format
    scalars = ", ".join(f"coalesce(CAST({value} AS VARIANT), {absent})" for value in _scalars(i).values())
    positions = f"CAST({_positions(i, position)} AS VARIANT)"
    return f"IF(malformed = {i}, array({scalars}, {absent}), array({scalars}, {absent}, {positions}))"


def tracking_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed event windows, as the landing job writes them."""
    return _windows(spark, sf_dir, "typed", _typed_frame)


def raw_tracking_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows as variant moments, as they are read from a tracking document."""
    return _windows(spark, sf_dir, "raw", _raw_frame)


def _header_side(offset: int) -> str:
    players = ", ".join(
        f"""named_struct('playerid', {PLAYER_BASE} + user_id * 10 + {5 * offset + k}, 'firstname', event_type,
              'lastname', 'L' || string(event_id % 3),
              'position', IF(event_id % 5 <> 0, 'POS' || string((event_id + {k}) % 5), NULL))"""
        for k in range(5)
    )
    number = f"(user_id + {offset}) % 30"
    return f"""named_struct('teamid', {TEAM_BASE} + {number}, 'abbreviation', 'T' || string({number}),
        'name', 'Team ' || string(event_id % 4), 'players', array({players}))"""


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event header per event: five players a side, with names that change from event to event."""
    game = game_key(F.col("user_id"))
    return table(spark, sf_dir, "events").select(
        season_label(season_start_year(game)).alias("season"),
        game.alias("game_id"),
        F.expr("IF(event_id % 101 = 0, 'unknown', string(date(ts)))").alias("gamedate"),
        F.col("event_id").alias("event_pos"),
        F.expr(_header_side(0)).alias("home"),
        F.expr(_header_side(1)).alias("visitor"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One game per customer; customers without events are games without rows."""
    key = F.col("c_custkey")
    game = game_key(key)
    return table(spark, sf_dir, "customer").select(
        game.alias("game_id"),
        F.concat(F.lit("g"), key.cast("string"), F.lit(".7z")).alias("tracking_filename"),
        F.col("c_nationkey").cast("string").alias("away"),
        F.col("c_mktsegment").alias("home"),
        season_label(season_start_year(game)).alias("season"),
    )


def requested_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game ids asked for, one per part; some are in no manifest."""
    return table(spark, sf_dir, "part").select(game_key(F.col("p_partkey")).alias("game_id"))


def dim_team_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One team per nation, fewer than the teams that play."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        (F.lit(TEAM_BASE).cast("bigint") + key).alias("team_id"),
        F.concat(F.lit("T"), key.cast("string")).alias("abbreviation"),
        F.col("n_name").alias("full_name"),
    )


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One roster row per order: the customer plays for the priority's team in the order's year."""
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("season_id"),
        (F.lit(TEAM_BASE).cast("bigint") + F.substring("o_orderpriority", 1, 1).cast("bigint")).alias("team_id"),
        F.col("o_custkey").alias("player_id"),
    )


def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar with every season that has a roster row, late October to mid June."""
    year = F.col("season_id")
    return roster(spark, sf_dir).select("season_id").distinct().select(
        "season_id",
        season_label(year).alias("season_label"),
        F.make_date(year, F.lit(10), F.lit(27)).alias("start_date"),
        F.make_date(year + 1, F.lit(6), F.lit(19)).alias("end_date"),
    )


def season_rows() -> tuple:
    """Literal calendar of the known seasons."""
    return tuple((y, f"{y}-{(y + 1) % 100:02d}", f"{y}-10-27", f"{y + 1}-06-19") for y in KNOWN_SEASONS)


def pbp_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play-by-play as text, as season files hold it: numbers written in several ways, gaps and faults in PERIOD."""
    return pbp_raw(spark, sf_dir).selectExpr(
        "string(GAME_ID) AS GAME_ID",
        "IF(EVENTNUM % 2 = 0, EVENTNUM || '.0', string(EVENTNUM)) AS EVENTNUM",
        "CASE EVENTNUM % 3 WHEN 0 THEN ' ' || EVENTMSGTYPE || ' ' WHEN 1 THEN EVENTMSGTYPE || '.00' ELSE string(EVENTMSGTYPE) END AS EVENTMSGTYPE",
        "CASE EVENTNUM % 50 WHEN 0 THEN 'x' WHEN 1 THEN '' WHEN 2 THEN '1.5' ELSE string(PERIOD) END AS PERIOD",
        "IF(EVENTNUM % 7 = 6, '', string(PERSON1TYPE)) AS PERSON1TYPE",
        "PCTIMESTRING",
    )
