"""Tracking documents read by byte ranges: one JSON document by many tasks.

A document is one JSON object with a list of events, each some hundred KB. Spark reads it as text with the key that begins an event as the
line separator, so files are split like any text, and each record is the rest of one event. A first, light pass counts
the events of each range, which numbers them in document order, and looks at how records end: where every record but the last
ends by opening the next event, events can be parsed one by one. Documents of another shape (the key isn't an event's
first, the date comes after the events) are named, to be read whole.
"""

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rimline import schemas
from rimline.operators.decode import WINDOWS, Windows, whole, with_columns

#: The key that every event begins with.
FIRST_KEY = '"eventId"'
#: Ranges that are broadcast to number events; a longer list is joined by a shuffle.
MOST_RANGES = 200_000
#: Games that are broadcast to pick documents; for a longer list all documents of the seasons are read.
MOST_GAMES = 1_000_000

RANGE = ["season", "game_id", "document", "start"]
PARSED = (
    "season STRING, game_id STRING, document STRING, start BIGINT, place BIGINT, event_id BIGINT, "
    f"home {schemas._SIDE}, visitor {schemas._SIDE}, moments ARRAY<{schemas.MOMENT_STRUCT}>, malformed_moments BIGINT"
)


def records(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """(season, game_id, document, start of the range, text): what stands before the first event, and then each event without its first key."""
    reader = spark.read.schema("value STRING, season STRING, game_id STRING").option("basePath", path).option("lineSep", FIRST_KEY)
    text = reader.option("pathGlobFilter", "*.json").text(folders)
    return text.select("season", "game_id", F.col("_metadata.file_path").alias("document"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("text"))


def _is_head() -> F.Column:
    return F.ltrim(F.substring("text", 1, 64)).startswith("{")


def ranges(found: DataFrame) -> DataFrame:
    """A row for each range: the events before it, the document's date, and whether the document can be read by ranges.

    The only whole read of the documents beside the parsing one; nothing of the texts leaves the tasks.
    """
    opens = F.substring("text", -64, 64).rlike(r"[,\[]\s*\{\s*$")
    head = F.when(_is_head(), F.col("text"))
    counted = found.groupBy(*RANGE).agg(
        F.sum(F.when(_is_head(), 0).otherwise(1)).alias("events"),
        F.sum(F.when(opens, 0).otherwise(1)).alias("ends"),
        F.sum(F.when(_is_head(), 1).otherwise(0)).alias("heads"),
        F.max(F.regexp_extract(head, r'"gamedate"\s*:\s*"([^"\\]*)"', 1)).alias("gamedate"),
        F.max(head.rlike(r'"events"\s*:\s*\[\s*\{\s*$')).alias("listed"),
    )
    document = Window.partitionBy("season", "game_id", "document")
    before = document.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole_document = (
        (F.sum("ends").over(document) == 1)
        & (F.sum("heads").over(document) == 1)
        & (F.max("gamedate").over(document) != "")
        & F.max("listed").over(document)
    )
    return counted.select(
        *RANGE,
        F.coalesce(F.sum("events").over(before), F.lit(0)).alias("before"),
        F.max("gamedate").over(document).alias("gamedate"),
        F.coalesce(whole_document, F.lit(False)).alias("by_ranges"),
    )


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value)


def _side(value) -> dict | None:
    """A team as its header says it; fields of other kinds are NULL."""
    if not isinstance(value, dict):
        return None
    players = value.get("players")
    if isinstance(players, list):
        names = ("firstname", "lastname", "position")
        players = [{"playerid": whole(p.get("playerid")), **{n: _text(p.get(n)) for n in names}} if isinstance(p, dict) else None for p in players]
    else:
        players = None
    return {"teamid": whole(value.get("teamid")), "abbreviation": _text(value.get("abbreviation")), "name": _text(value.get("name")), "players": players}


def event_of(text: str) -> dict:
    """The event that a record is the rest of. What follows the event isn't read; broken text is an event without fields."""
    try:
        found, _ = json.JSONDecoder().raw_decode("{" + FIRST_KEY + text)
    except ValueError:
        return {}
    return found


def parse(found: DataFrame) -> DataFrame:
    """Records -> typed events, each with its place in its range; tasks read a range's records in order."""
    from pyspark.sql.pandas.types import to_arrow_type

    schema = StructType.fromDDL(PARSED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[tuple, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, WINDOWS):
                windows, keys, rest = Windows(), [], []
                some = batch.slice(at, WINDOWS)
                for key, text in zip(zip(*(some.column(name).to_pylist() for name in RANGE)), some.column("text")):
                    text = text.as_py()
                    if text.lstrip()[:1] == "{":
                        continue
                    event = event_of(text)
                    windows.add(event.get("moments"))
                    place = places.get(key[2:], 0)
                    places[key[2:]] = place + 1
                    keys.append(key)
                    rest.append((place, whole(event.get("eventId")), _side(event.get("home")), _side(event.get("visitor"))))
                columns = {f.name: None for f in schema}
                fields = zip(*(k + r for k, r in zip(keys, rest))) if keys else [()] * 8
                for field, values in zip(schema, fields):
                    columns[field.name] = pa.array(list(values), to_arrow_type(field.dataType))
                columns["moments"], columns["malformed_moments"] = windows.columns()
                yield with_columns(schema, columns)

    return found.mapInArrow(run, schema)


def read_events(spark: SparkSession, path: str, folders: list[str], games: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, others): typed event windows of the games' documents that can be read by ranges, and the games of other documents.

    ``event_pos`` numbers a document's events from 0, as a read of the whole document does.
    """
    wanted = games.select("season", "game_id").distinct()
    found = records(spark, path, folders)
    # Records must stay in the order of their ranges, so nothing may shuffle them before they are parsed.
    if wanted.count() <= MOST_GAMES:
        found = found.join(F.broadcast(wanted), ["season", "game_id"], "left_semi")
    # Worked out once; what is lost with an executor is worked out again.
    known = ranges(found).persist(StorageLevel.DISK_ONLY)
    numbered = known.where("by_ranges").join(wanted, ["season", "game_id"], "left_semi").select(*RANGE, "before", "gamedate")
    if known.count() <= MOST_RANGES:
        numbered = F.broadcast(numbered)
    events = parse(found).join(numbered, RANGE).select(
        "season",
        "game_id",
        "gamedate",
        (F.col("before") + F.col("place")).alias("event_pos"),
        "event_id",
        "home",
        "visitor",
        "moments",
        "malformed_moments",
    )
    others = wanted.join(known.where("by_ranges").select("season", "game_id"), ["season", "game_id"], "left_anti")
    return events, others
