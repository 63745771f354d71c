"""What the operators share: reading, cutting lineage, walking Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows turned into Python objects at a time; texts may be long.
SLICE_ROWS = 256
#: Words a worker remembers before it starts anew, which bounds its memory.
REMEMBERED = 300_000
#: Longer words are not remembered.
LONG_WORD = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str = "text") -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def whole_row(docs: DataFrame, *but: str) -> Column:
    """The caller's columns in one, named row, beside which helper columns of any name can stand."""
    return F.struct(*(F.col(quoted(c)) for c in docs.columns if c not in but)).alias("row")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: what ``spark.checkpoint.dir`` names; one of its own only where the setting is
    absent on one machine, as in tests. On a cluster, whose machines share no folder of their own, its absence is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again, so that no later loss repeats what led to them.

    A written table has its true size, by which Spark plans what follows; a checkpoint keeps the estimate of the
    plan behind it, which grows from join to join.
    """
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[dict[str, list]]:
    """The batches as short lists of Python values by column."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows).to_pydict()


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= LONG_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Hashes spread over all 64 bits."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))
