"""Jaccard join of documents on word n-grams by banded minimum hashes.

1. Each document becomes its set of 5-word n-grams (64-bit hashes). Documents with the same set
   form one class and go on as one.
2. Minimum hashes of a class are cut into bands; numbers of bands and of rows in a band follow from the
   threshold and the recall asked for. Classes shuffle on band hashes; those that share one are
   tied to the least among them, never to each other, and so fall into candidate groups.
3. All pairs of a candidate group are verified on their full sets. A group larger than a block is
   dealt to pairs of blocks, each a task's work of bounded size, and only sums and spanning links leave it.

Two documents link if the Jaccard similarity of their sets is at least the threshold.

Defined cases: words are parted by ASCII white space; a text of one to four words is one n-gram of them
all; a text without words, null included, links to none and is its own class; rows
with null ids are left out; rows with equal ids are copies if their texts have the same set; an
empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimline.llm.common import WordHashes, cut, mixed, slices, table, utf8
from rimline.llm.components import components

WORDS = 5
THRESHOLD = 0.8
#: Share of the pairs at the threshold that must meet in a band.
RECALL = 0.9995
#: Minimum hashes a document may spend.
MOST_HASHES = 192
#: Classes in a block of a candidate group.
BLOCK = 256
#: n-grams multiplied at a time when a block is verified.
COLUMNS = 4096
#: n-grams hashed at a time.
HASHED = 2048


def bands(threshold: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """Numbers of bands and of rows in each: the most selective bands that reach the recall."""
    for rows in range(16, 1, -1):
        number = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if number * rows <= most:
            return number, rows
    return most, 1


def ngrams(text: bytes, hashes: WordHashes, n: int) -> np.ndarray:
    """The sorted distinct n-gram hashes of a text."""
    words = text.split()
    if not words:
        return np.empty(0, np.uint64)
    each = hashes.of(words)
    span = min(n, len(words))
    last = len(words) - span + 1
    grams = np.full(last, span, np.uint64)
    for i in range(span):
        grams = grams * np.uint64(0xD6E8FEB86659FD93) + each[i : i + last]
    return np.unique(mixed(grams))


class Signer:
    """Band hashes of n-gram sets."""

    def __init__(self, number: int, rows: int):
        rng = np.random.default_rng(11)
        self.number, self.rows = number, rows
        self.factors = rng.integers(1, 1 << 32, (number * rows, 1), np.uint32) | np.uint32(1)
        self.shifts = rng.integers(0, 1 << 32, (number * rows, 1), np.uint32)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        short = (grams >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.factors), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(short), HASHED):
            np.minimum(least, (self.factors * short[at : at + HASHED] + self.shifts).min(axis=1), out=least)
        # A band's hash also holds its number, so bands never meet one another.
        hashes = np.arange(1, self.number + 1, dtype=np.uint64)
        for column in least.reshape(self.number, self.rows).T:
            hashes = mixed(hashes * np.uint64(0xD6E8FEB86659FD93) + column)
        return hashes.view(np.int64)


def _signed(n: int, number: int, rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sign = WordHashes(), Signer(number, rows)
        for part in slices(batches):
            keys, signs = [], []
            for text in part["text"]:
                grams = ngrams(text, hashes, n)
                keys.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                signs.append(sign(grams) if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part["doc_id"], pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.list_(pa.int64()))],
                names=["doc_id", "set_key", "signs"],
            )

    return run


def _sets(n: int):
    """The n-gram sets of the texts; rows that share an id with the wanted text are left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            grams = [ngrams(text.as_py(), hashes, n).tobytes() for text in batch.column("text")]
            wanted = [xxhash.xxh3_128_digest(g) == key.as_py() for g, key in zip(grams, batch.column("set_key"))]
            columns = [pa.array(grams, pa.binary()) if name == "text" else batch.column(name) for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array(wanted, pa.bool_()))

    return run


def _roots(adjacent: np.ndarray) -> np.ndarray:
    """The least index of each node's component."""
    roots = np.arange(len(adjacent))
    while True:
        lower = np.minimum(roots, np.where(adjacent, roots[None, :], len(adjacent)).min(axis=1))
        lower = np.minimum(lower, lower[lower])
        if (lower == roots).all():
            return roots
        roots = lower


def _linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the sets are similar enough, self excluded."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    grams, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # n-grams of one set alone are in no intersection.
    columns = np.cumsum(times > 1) - 1
    shared = times[place] > 1
    owner, place = owner[shared], columns[place[shared]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(columns[-1]) + 1, COLUMNS):
        low, high = np.searchsorted(place, [first, first + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[low:high], place[low:high] - first] = 1
        common += held @ held.T
    union = sizes[:, None] + sizes[None, :] - common
    adjacent = common >= threshold * union - 1e-6 * union
    np.fill_diagonal(adjacent, False)
    return adjacent


def _verified(threshold: float):
    """Rows of one candidate group's pair of blocks at a time: links of each class and its least relative there."""

    def judge(key: tuple, members: dict[int, tuple]) -> tuple[list, list, list]:
        _, x, y = key
        nodes = sorted(members)
        copies, block, sets = zip(*(members[node] for node in nodes))
        copies, block, nodes = np.array(copies), np.array(block), np.array(nodes)
        adjacent = _linked([np.frombuffer(s, np.uint64) for s in sets], threshold)
        if x != y:  # Pairs within a block are that block's own task.
            adjacent &= block[:, None] != block[None, :]
        return nodes.tolist(), (adjacent @ copies).tolist(), nodes[_roots(adjacent)].tolist()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, out = None, {}, ([], [], [])

        def close():
            if len(members) > 1:
                for into, values in zip(out, judge(key, members)):
                    into.extend(values)
            members.clear()

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["node", "links", "head"])
            for c in out:
                c.clear()
            return batch

        for part in slices(batches):
            for group, x, y, node, *member in zip(*(part[c] for c in ("group", "x", "y", "node", "copies", "block", "text"))):
                if (group, x, y) != key:
                    close()
                    key = (group, x, y)
                members[node] = member
            if len(out[0]) > 10_000:
                yield flush()
        close()
        yield flush()

    return run


def near_classes(
    docs: DataFrame,
    n: int = WORDS,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: rep_id (least id with the same n-gram set), copies (documents with that set),
    class_id (least id reached over links) and n_links (other documents that it links to)."""
    number, rows = bands(threshold, recall)
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    signed = cut(texts.mapInArrow(_signed(n, number, rows), "doc_id long, set_key binary, signs array<long>"))
    sets = cut(
        signed.where("set_key is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("signs").alias("signs"))
        .withColumn("node", F.xxhash64("set_key"))
    )

    banded = sets.select("node", F.explode("signs").alias("band"))
    heads = cut(banded.groupBy("band").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n"))
    groups = _with_heads(components(banded.join(heads, "band").where("node > head").select("node", "head")))
    groups = cut(groups.withColumnRenamed("head", "group"))
    blocks = cut(groups.groupBy("group").agg(F.ceil(F.count("*") / block).alias("blocks")))
    placed = groups.join(blocks, "group").withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), "blocks"))
    placed = cut(placed.join(sets.drop("signs"), "node"))
    wanted = texts.join(placed.hint("shuffle_hash"), texts.doc_id == placed.rep)
    found = wanted.select("group", "blocks", "block", "node", "copies", "set_key", "text").mapInArrow(
        _sets(n), "group long, blocks long, block long, node long, copies long, set_key binary, text binary"
    )
    paired = found.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
        "group", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "node", "copies", "block", "text"
    )
    judged = cut(
        paired.repartition("group", "x", "y")
        .sortWithinPartitions("group", "x", "y")
        .mapInArrow(_verified(threshold), "node long, links long, head long")
    )
    joined = cut(_with_heads(components(judged.where("head < node").select("node", "head"))).join(sets.select("node", "rep"), "node"))
    least = cut(joined.groupBy("head").agg(F.min("rep").alias("class_id")))
    classes = joined.join(least, "head").select("node", "class_id")
    links = judged.groupBy("node").agg(F.sum("links").alias("links"))
    known = cut(
        sets.drop("signs")
        .join(classes, "node", "left")
        .join(links, "node", "left")
        .select(
            "set_key",
            F.col("rep").alias("rep_id"),
            "copies",
            F.coalesce("class_id", "rep").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    columns = ["doc_id", "rep_id", "copies", "class_id", "n_links"]
    one, none = (F.lit(v).cast("long") for v in (1, 0))
    alone = signed.where("set_key is null").select(
        "doc_id", F.col("doc_id").alias("rep_id"), one.alias("copies"), F.col("doc_id").alias("class_id"), none.alias("n_links")
    )
    return signed.drop("signs").join(known, "set_key").select(columns).union(alone)


def _with_heads(stars: DataFrame) -> DataFrame:
    """The stars' rows and one for each head itself."""
    return stars.select("node", "head").union(stars.select(F.col("head").alias("node"), "head").distinct())


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those that have a smaller id in their class.

    Rows with one id count as one document, which stays if one of its texts has the least id of a class; of
    equal rows one stays. Rows with null ids stay.
    """
    found = near_classes(docs)
    ids = found.groupBy("doc_id").agg(F.bool_and(F.col("doc_id") != F.col("class_id")).alias("gone"), F.count("*").alias("n"))
    ids = cut(ids.where("gone or n > 1"))
    gone = ids.where("gone").select(F.col("doc_id").alias("_near_id"))
    again = ids.where("not gone").select(F.col("doc_id").alias("_near_id"))
    left = docs.join(gone, docs.doc_id == gone._near_id, "left_anti")
    if again.isEmpty():
        return left  # No id is repeated, so no text need be moved to compare rows.
    once = left.join(again, left.doc_id == again._near_id, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(again, left.doc_id == again._near_id, "left_anti").unionByName(once)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))
