"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into dictionary phrases: the longest phrase known so far and one unit more make the next
phrase. Units are words parted by white space; longer words are taken in pieces, so texts without spaces
parse as well. The fingerprint is the least hashes of the set of phrases. Two fingerprints'
likeness estimates the Jaccard similarity of the phrase sets: texts that compress each other share phrases.

For the query every document meets the next one by id. Ids fall into ranges of about equally many
documents; a range's first document is also dealt to the range before. Each range is one sorted
stream that holds two documents at a time.

Defined cases: a null text is empty; an empty text, or one of white space alone, has the empty
fingerprint, whose likeness is 1 to itself and 0 to others; equal ids follow one another by text; rows with
null ids come before all others; the only document of a table is its own next one; an empty
table gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimline.llm.common import WordHashes, mixed, slices, table

#: Hashes in a fingerprint.
SIZE = 64
#: Longer words are taken in pieces of this many bytes.
UNIT = 24
#: Documents in a range of ids, about.
RANGE_ROWS = 1024
#: Ranges at most; the driver holds the first id of each.
MOST_RANGES = 200_000
#: Quantiles that bound ranges; between two of them ranges are equally wide.
MOST_CUTS = 256
RANGES_PER_TASK = 4

_MASK = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15

PAIRED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def units(text: str) -> list[bytes]:
    words = text.encode().split()
    if max(map(len, words), default=0) <= UNIT:
        return words
    return [w[at : at + UNIT] for w in words for at in range(0, len(w), UNIT)]


def phrases(text: str, hashes: WordHashes) -> set[int]:
    """Hashes of the text's phrases. A phrase is hashed as the one it extends, and a unit."""
    known: set[int] = set()
    add, here = known.add, 0
    for unit in map(hashes.__getitem__, units(text)):
        longer = ((here ^ unit) * _STEP + 1) & _MASK
        if longer in known:
            here = longer
        else:
            add(longer)
            here = 0
    return known


def signature(text: str, hashes: WordHashes, size: int = SIZE) -> np.ndarray:
    """The least hashes of the phrases, as sorted distinct 32-bit numbers."""
    known = phrases(text, hashes)
    spread = (mixed(np.fromiter(known, np.uint64, len(known))) >> np.uint64(32)).astype(np.uint32)
    if len(spread) > 4 * size:
        # Equal numbers may push distinct ones out of the cut: twice the size leaves room for them.
        spread = np.partition(spread, 2 * size)[: 2 * size]
    return np.unique(spread)[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """The share of the least hashes of both that are in each."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:size]
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(both, common, assume_unique=True).sum() / len(both))


def written(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


def edited(text: str, after: str) -> str:
    """The last half of the text replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _pairing(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last = WordHashes(), None

        def pair(doc_id, text, own, after, its):
            changed = edited(text, after)
            other = signature(changed, hashes, size)
            return (
                doc_id,
                len(text),
                hashlib.sha256(changed.encode()).hexdigest(),
                written(own),
                written(other),
                likeness(own, other, size),
                likeness(own, its, size),
            )

        schema = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for rows in slices(batches):
            out = []
            for group, doc_id, text in zip(rows["range"], rows["doc_id"], rows["text"]):
                own = signature(text, hashes, size)
                if last is not None and last[0] == group:
                    out.append(pair(*last[1:], text, own))
                last = group, doc_id, text, own
            columns = list(zip(*out)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema)

    return run


def paired_fingerprints(docs: DataFrame, size: int = SIZE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per document, with its fingerprint, that of its edited text, and likenesses."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = docs.select("doc_id")
    count = ids.count()
    if not count:
        return docs.sparkSession.createDataFrame([], PAIRED)
    ranges = min(MOST_RANGES, count // range_rows + 1)
    parts = min(ranges, MOST_CUTS)
    bounds = ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(parts + 1)], 100 * MOST_CUTS)).first()[0]
    place = _range(sorted(set(bounds or [])), -(-ranges // parts))

    least = ids.select(place, "doc_id").groupBy("range").agg(F.min("doc_id").alias("first"), F.bool_or(F.isnull("doc_id")).alias("none"))
    # One row for each range that has documents.
    firsts = sorted((r["range"], None if r["none"] else r["first"]) for r in least.collect())
    before = {key: (firsts[i - 1][0], i == 0) for i, (key, _) in enumerate(firsts)}
    edges = docs.sparkSession.createDataFrame(
        [(first, *before[key]) for key, first in firsts], "_first long, _before int, _around boolean"
    )
    dealt = docs.select(place, F.lit(0).alias("edge"), "doc_id", "text")
    # As many rows as there are ranges.
    heads = docs.join(F.broadcast(edges), docs.doc_id.eqNullSafe(edges._first))
    heads = heads.groupBy("_before", "doc_id").agg(F.min("text").alias("text"))
    heads = heads.select(F.col("_before").alias("range"), F.lit(1).alias("edge"), "doc_id", "text")
    return (
        dealt.union(heads)
        .repartition(-(-ranges // RANGES_PER_TASK), "range")
        .sortWithinPartitions("range", "edge", F.asc_nulls_first("doc_id"), "text")
        .mapInArrow(_pairing(size), PAIRED)
    )


def _range(bounds: list[int], steps: int):
    """The number of the range an id is in: between two bounds there are so many steps; a null id is in the first."""

    def within(low: int, high: int):
        if low < high:
            middle = (low + high) // 2
            return F.when(F.col("doc_id") > bounds[middle + 1], within(middle + 1, high)).otherwise(within(low, middle))
        if steps == 1 or not bounds:
            return F.lit(low * steps)
        width = max(1, -(-(bounds[min(low + 1, len(bounds) - 1)] - bounds[low]) // steps))
        step = F.floor((F.col("doc_id") - bounds[low]) / width)
        return F.lit(low * steps) + F.greatest(F.lit(0), F.least(F.lit(steps - 1), step))

    return F.coalesce(within(0, max(len(bounds) - 2, 0)).cast("int"), F.lit(0)).alias("range")


def op3_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paired_fingerprints(table(spark, sf_dir, "documents"))
