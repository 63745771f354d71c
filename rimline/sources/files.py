"""Readers. Keys in directory names come back as strings and prune directories."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rimline import schemas
from rimline.operators.manifest import manifest_subset, missing_games
from rimline.sinks.ledger import children


class UnknownGames(ValueError):
    """Requested games are not in the manifest."""


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST).option("enforceSchema", False).csv(path, header=True)


def load_manifest(spark: SparkSession, path: str, game_ids: list[str] | None = None) -> DataFrame:
    """The manifest, or the requested part of it; ids that it does not know are an error."""
    manifest = read_manifest(spark, path)
    if not game_ids:
        return manifest
    requested = spark.createDataFrame([(g,) for g in sorted(set(game_ids))], "game_id string")
    unknown = [row.game_id for row in missing_games(requested, manifest).collect()]
    if unknown:
        raise UnknownGames(f"the manifest does not list {len(unknown)} of the games asked for: {sorted(unknown)}")
    return manifest_subset(manifest, requested)


def season_folders(spark: SparkSession, path: str, seasons: list[str]) -> list[str]:
    """The folders of these seasons that are there."""
    there = set(children(spark, path))
    return [f"{path}/season={season}" for season in seasons if f"season={season}" in there]


def arrived_documents(spark: SparkSession, path: str, seasons: list[str]) -> DataFrame:
    """``(season, game_id)`` of the documents of some seasons. Spark's tasks list the games' folders; no document is opened."""
    listed = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY, season STRING, game_id STRING"
    folders = season_folders(spark, path, seasons)
    if not folders:
        return spark.createDataFrame([], "season STRING, game_id STRING")
    found = spark.read.format("binaryFile").schema(listed).option("basePath", path).option("pathGlobFilter", "*.json")
    return found.load(folders).select("season", "game_id").distinct()


def read_tracking_documents(spark: SparkSession, path: str, seasons: list[str] | None = None) -> DataFrame:
    """One row per game document, of some seasons or all. A document is one JSON object, so one task reads one file."""
    reader = spark.read.schema(schemas.TRACKING_DOCUMENT).option("multiLine", True).option("basePath", path)
    return reader.json(path if seasons is None else season_folders(spark, path, seasons))


class MistypedFields(ValueError):
    """Text in a season file that does not fit the type of its column."""


def _typed(name: str) -> Column:
    """A text field as its column's type: whole numbers may be written as 12 or as 12.0; empty text is NULL."""
    kind = schemas.PBP_TYPES[name].lower()
    text = F.nullif(F.trim(F.col(name)), F.lit(""))
    if kind not in ("bigint", "int"):
        return F.col(name) if kind == "string" else text.try_cast(kind)
    number = text.try_cast("decimal(38,10)")
    return F.when(number == F.floor(number), number).try_cast(kind)


def typed_pbp(rows: DataFrame) -> DataFrame:
    """Text rows with the columns in use typed. ``mistyped`` counts the fields of a row that lose their text, ``faults`` names them.

    A column in use that the rows lack is NULL; other columns stay text.
    """
    wanted = [n for n in schemas.PBP_TYPES if n in rows.columns]
    lost = [F.nullif(F.trim(F.col(n)), F.lit("")).isNotNull() & _typed(n).isNull() for n in wanted]
    others = [F.col(n) for n in rows.columns if n not in schemas.PBP_TYPES]
    absent = [F.lit(None).cast(t.lower()).alias(n) for n, t in schemas.PBP_TYPES.items() if n not in rows.columns]
    mistyped = sum((flag.cast("int") for flag in lost), F.lit(0))
    faults = F.array_compact(F.array(*[F.when(flag, n) for flag, n in zip(lost, wanted)])) if wanted else F.array().cast("array<string>")
    return rows.select(*[_typed(n).alias(n) for n in wanted], *absent, *others, mistyped.alias("mistyped"), faults.alias("faults"))


def _season_paths(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The season files themselves, one per season."""
    listed = spark.read.format("binaryFile").load(paths).select("path")
    return sorted(row.path for row in listed.collect())


#: What ``season_rows`` adds to the columns of the files.
ABOUT_ROWS = ("mistyped", "faults", "source_file", "source_text")


def season_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Season play-by-play files, each read by its own header and matched by column name; faulty rows included.

    A column that one file lacks is NULL there. Columns in use get their types, the others stay text. Beside them
    each row has what does not fit (``mistyped``, ``faults``), its file, and its own text as JSON.
    """

    def one(path: str) -> DataFrame:
        text = spark.read.options(header=True, inferSchema=False, escape='"').csv(path)
        own = F.to_json(F.struct(*[F.col(f"`{c}`") for c in text.columns]))
        return text.select("*", F.col("_metadata.file_path").alias("source_file"), own.alias("source_text"))

    text = [one(path) for path in _season_paths(spark, paths)]
    typed = typed_pbp(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), text))
    # A one-row generator: filters on what was found out about a row don't work it out again, field by field.
    return typed.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in typed.columns]))))


def read_season_pbp(spark: SparkSession, paths: str | list[str], check: bool = True) -> DataFrame:
    """``season_rows`` without what is said about them. With ``check``, faulty fields are counted in one pass and raised."""
    rows = season_rows(spark, paths)
    if check:
        lost = rows.agg(F.sum("mistyped")).first()[0]
        if lost:
            raise MistypedFields(f"{lost} field(s) of the season files do not fit the type of their column")
    return rows.drop(*ABOUT_ROWS)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A partitioned Parquet table; stray files of other kinds are left out."""
    return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)
