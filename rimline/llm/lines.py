"""Line dedup by winnowing: later repeats of runs of lines go.

A line longer than a sentence counts as several: it is cut after words that end in ``.``, ``!`` or ``?``, so that a passage
which shares its first and last line with other text is found, too. Such a piece of a line is a unit here.

A run is consecutive units of one document (lines of white space alone are passed over, and stay) with at
least ``min_words`` words. A unit goes if it lies in a run whose units stand, equal but for outer white
space, earlier: in a document of smaller id, or above in the same one without overlap. With ``min_line``, a whole line
of fewer words is a run, too, if it has that many and stands in more than one document. A line that loses all its
units goes; one that loses some keeps the others with the white space after them.

1. Windows: from every unit the shortest run that begins there, and the shortest that ends there.
   Together they cover every unit of any run. A window's fingerprint is its least unit hash,
   so equal runs have equal fingerprints at equal places. A place is kept once, with its windows.
2. Places of equal fingerprints meet; a fingerprint with one place goes no further.
3. Around a shared fingerprint the match extends both ways: each window about it has a 64-bit key of all
   its units, which with the fingerprint makes 128 bits, and a window with an earlier equal is deleted. Equal windows are
   never compared pair by pair, so a passage in a third of all documents costs one row each.

Defined cases: a null text stays null; rows with null ids stay as they are and match nothing; rows
with equal ids and texts are one document, equal ids with different texts are ordered by
a hash of the text; an empty table gives no rows; other columns are passed on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rimline.llm.common import cut, mixed, slices, table, utf8, whole_row

#: Words a run must have to be deleted.
MIN_WORDS = 30
#: Words of a whole line that is deleted alone, where it stands in other documents.
MIN_LINE = 5

#: Bytes of text looked at together, for speed.
CHUNK = 1 << 18

PLACES = "fingerprint long, doc_id long, part long, windows array<struct<first:int, last:int, key:long, short:boolean>>"
WINDOW = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("key", pa.int64()), ("short", pa.bool_())])

#: A unit ends at a word that ends in one of these, or with its line.
SENTENCE_END = b".!?"
_SPACE, _END = (np.isin(np.arange(256), list(chars)) for chars in (b" \t\n\r\f\v", SENTENCE_END))
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def units(text: bytes) -> tuple[np.ndarray, ...]:
    """Arrays of a text's units: line, words, and where the first word begins and the last one ends."""
    data = np.frombuffer(text + b"\n", np.uint8)
    space = _SPACE[data]
    begin = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    end = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    line = np.searchsorted(np.flatnonzero(data == 10), begin)
    new = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | _END[data[end[:-1] - 1]]])[: len(begin)])
    after = np.append(new[1:], len(begin))[: len(new)]
    return line[new], after - new, begin[new], end[after - 1]


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])


def _least(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The index of the last least hash from first to last, for many spans: two overlapping powers of two cover each."""
    least, of_level = np.empty(len(first), np.int64), np.log2(last - first + 1).astype(np.int64)
    level = np.arange(len(hashes))
    for k in range(int(of_level.max()) + 1):
        if k:
            a, b = level[: -(1 << (k - 1))], level[1 << (k - 1) :]
            level = np.where(hashes[b] <= hashes[a], b, a)
        now = of_level == k
        a, b = level[first[now]], level[last[now] - (1 << k) + 1]
        least[now] = np.where(hashes[b] <= hashes[a], b, a)
    return least


def windows(texts: list[bytes], min_words: int, min_line: int | None = None) -> tuple | None:
    """Arrays of the texts' windows, ordered by place: fingerprint, place, text, first and last unit in it, key, whether shorter than a run."""
    line, words, begin, end = units(whole := b"\n".join(texts))
    if not len(words):
        return None
    n, ends = len(words), np.cumsum(words)
    starts = ends - words
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), begin, side="right")
    # The units of a text, by its number.
    low, high = (np.searchsorted(owner, np.arange(len(texts)), side=side) for side in ("left", "right"))
    each = np.array([xxhash.xxh3_64_intdigest(whole[i:j]) for i, j in zip(begin.tolist(), end.tolist())], np.uint64)
    here = np.arange(n)
    last = np.searchsorted(ends, starts + min_words)
    first = np.searchsorted(starts, ends - min_words, side="right") - 1
    from_here, to_here = last < high[owner], first >= low[owner]
    spans = [here[from_here] * n + last[from_here], first[to_here] * n + here[to_here]]
    if min_line:
        head = np.flatnonzero(np.diff(line, prepend=-1))
        tail = np.append(head[1:], n) - 1
        size = ends[tail] - starts[head]
        alone = (size >= min_line) & (size < min_words)
        spans.append(head[alone] * n + tail[alone])
    first, last = np.divmod(np.unique(np.concatenate(spans)), n)
    if not len(first):
        return None
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(each) * _powers(_BASE, n - 1))])
    keys = mixed((sums[last + 1] - sums[first]) * _powers(_UNBASE, n - 1)[first] + (last - first).astype(np.uint64))
    place = _least(each, first, last)
    order = np.argsort(place, kind="stable")
    first, last, place = first[order], last[order], place[order]
    text = owner[place]
    return each[place].view(np.int64), place, text, first - low[text], last - low[text], keys[order].view(np.int64), ends[last] - starts[first] < min_words


def _chunks(texts: list[bytes]) -> Iterator[slice]:
    """Texts looked at together: so many bytes, or one longer text."""
    at, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > CHUNK:
            yield slice(at, i)
            at, held = i, 0
        held += len(text) + 1
    yield slice(at, len(texts))


def _places(min_words: int, min_line: int | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            for some in _chunks(rows["text"]):
                if (found := windows(rows["text"][some], min_words, min_line)) is None:
                    continue
                fingerprint, place, text, *span = found
                heads = np.flatnonzero(np.diff(place, prepend=-1))
                ids, parts = (np.array(rows[c][some], np.int64)[text[heads]] for c in ("doc_id", "part"))
                spans = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(span, WINDOW)], fields=list(WINDOW))
                nested = pa.ListArray.from_arrays(pa.array(np.append(heads, len(place)), pa.int32()), spans)
                flat = [pa.array(c, pa.int64()) for c in (fingerprint[heads], ids, parts)]
                yield pa.RecordBatch.from_arrays([*flat, nested], names=["fingerprint", "doc_id", "part", "windows"])

    return run


def repeated_ranges(docs: DataFrame, min_words: int = MIN_WORDS, min_line: int | None = MIN_LINE) -> DataFrame:
    """(doc_id, part, ranges): the numbers, from 0, of the units to delete; part is a hash of the text."""
    texts = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("part"), utf8().alias("text")
    )
    places = cut(texts.mapInArrow(_places(min_words, min_line), PLACES))
    shared = cut(places.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1").select("fingerprint"))
    runs = cut(
        places.join(shared, "fingerprint")
        .select("fingerprint", "doc_id", "part", F.explode("windows").alias("w"))
        .select("fingerprint", "w.key", "w.short", F.struct("doc_id", "part", "w.first", "w.last").alias("place"))
    )
    again = runs.groupBy("fingerprint", "key").agg(
        F.min("place").alias("earliest"), F.max("place.doc_id").alias("most"), F.max("short").alias("short"), F.count("*").alias("n")
    )
    earliest = cut(again.where("n > 1 and (not short or earliest.doc_id < most)").select("fingerprint", "key", "earliest"))
    apart = F.expr("place.doc_id <> earliest.doc_id or place.part <> earliest.part or place.first > earliest.last")
    later = runs.join(earliest, ["fingerprint", "key"]).where(apart).select("place.*")
    return later.groupBy("doc_id", "part").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("ranges"))


def shorter(texts: list[bytes], ranges: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple]:
    """(text, lines, lines cut, words cut) of each text without its ranges of units, first and last ones as arrays."""
    whole = b"\n".join(texts)
    line, words, begin, _ = units(whole)
    ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(ends, begin, side="right")
    low = np.searchsorted(owner, np.arange(len(texts)))
    steps = np.zeros(len(line) + 1, np.int64)
    for at, (first, last) in zip(low, ranges):
        np.add.at(steps, at + first, 1)
        np.subtract.at(steps, at + last + 1, 1)
    gone = np.cumsum(steps[:-1]) > 0
    data = np.frombuffer(whole + b"\n", np.uint8)
    over = np.flatnonzero(data == 10)
    lost, held = (np.bincount(x, minlength=len(over)) for x in (line[gone], line))
    empty = (lost == held) & (held > 0)
    head = np.diff(line, prepend=-1) > 0
    begin = np.where(head, np.concatenate([[0], over[:-1] + 1])[line], begin)
    # A unit takes the white space after it along, the last of a line that goes whole the line's end, too.
    until = np.where(np.append(head[1:], True)[: len(line)], over[line] + empty[line], np.append(begin[1:], len(data))[: len(line)])
    steps = np.zeros(len(data) + 1, np.int8)
    steps[begin[gone]] = 1
    np.subtract.at(steps, until[gone], 1)
    stay = np.cumsum(steps[:-1], dtype=np.int8) == 0
    kept, sizes = data[stay].tobytes(), np.concatenate([[0], np.cumsum(stay)])[ends].tolist()
    breaks = np.searchsorted(over, ends).tolist()
    of_lines, of_words = np.concatenate([[0], np.cumsum(empty)])[breaks].tolist(), np.bincount(owner[gone], words[gone], len(texts)).astype(int).tolist()
    for start, size, b0, b1, e0, e1, n in zip([0, *sizes], sizes, [0, *breaks], breaks, [0, *of_lines], of_lines, of_words):
        # The end of the last line parts this text from the next one.
        yield kept[start : max(size - 1, start)], b1 - b0, e1 - e0, n


def _cut_lines(schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ranges = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("ranges")
            made = [(t, 0 if t is None else t.count(b"\n") + 1, 0, 0) for t in texts]
            spans = [ranges.values.field(c).to_numpy() for c in ("first", "last")]
            offsets, known = ranges.offsets.to_numpy(), ranges.is_valid().to_numpy(zero_copy_only=False)
            touched = [i for i in range(len(texts)) if known[i] and texts[i] is not None]
            for some in _chunks([texts[i] for i in touched]):
                rows = touched[some]
                cut_at = [tuple(x[offsets[i] : offsets[i + 1]] for x in spans) for i in rows]
                for i, result in zip(rows, shorter([texts[i] for i in rows], cut_at) if rows else ()):
                    made[i] = result
            new = dict(zip(("text", "_n_lines", "_n_cut_lines", "_n_cut_words"), zip(*made) if made else [[]] * 4))
            new["text"] = pa.array(new["text"], pa.binary()).cast(pa.string())
            columns = [pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _shortened(docs: DataFrame, min_words: int, min_line: int | None) -> DataFrame:
    """(row, text, _n_lines, _n_cut_lines, _n_cut_words): the other columns, packed, and what becomes of the text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ranges = repeated_ranges(docs, min_words, min_line)
    rows = docs.select(whole_row(docs, "text"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    same = (F.col("id") == F.col("doc_id")) & (F.xxhash64("text") == F.col("part"))
    joined = rows.join(ranges.hint("shuffle_hash"), same, "left").select("row", "text", "ranges")
    schema = StructType(list(rows.select("row", "text").schema.fields)).add("_n_lines", "long").add("_n_cut_lines", "long").add("_n_cut_words", "long")
    return joined.mapInArrow(_cut_lines(to_arrow_schema(schema)), schema)


def _unpacked(docs: DataFrame) -> list:
    return [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, min_line: int | None = MIN_LINE) -> DataFrame:
    """The rows with shorter texts, and _n_lines, _n_cut_lines, _n_cut_words (long) beside them."""
    return _shortened(docs, min_words, min_line).select(*_unpacked(docs), "_n_lines", "_n_cut_lines", "_n_cut_words")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated runs of lines deleted; one that loses every word goes.

    Such a document consists of runs that earlier ones hold. Other columns are passed on, whatever their names.
    """
    done = _shortened(docs, MIN_WORDS, MIN_LINE)
    gone = F.col("_n_cut_words") > 0
    return done.where(~(gone & ~F.col("text").rlike(r"[^\x09-\x0D\x20]"))).select(_unpacked(docs))


def op2_winnowed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "text",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_cut_lines").alias("n_cut_lines"),
        F.col("_n_cut_words").alias("n_cut_words"),
    )
