"""Conversation structure repair by depth-first branch and bound.

Turns of a conversation are kept, given the other role, deleted, or new ones are put in, so that the initials of the roles
become ``(s?(ua)+)?`` at the least cost; of edits that cost the same, those whose initials are least in ASCII.

Faults first, on light rows (ids, roles, digests of texts): equal turns of a conversation are one row with a count, the earliest place
of each role and text comes from one aggregation and is joined back. The rows are then dealt out by ranges of
conversation and turn, so a conversation of any length is spread; each task cuts its sorted rows into segments of at
most ``SEGMENT`` turns. A segment is solved for each role that may stand before it: the search goes down an explicit
stack, cheapest child first, drops what the lower bound of the remaining turns can't bring below the incumbent (cost, audit), and what a
node's table says was reached at no higher (cost, audit); an empty stack proves the incumbent. Segments of a conversation are then
joined in order, four rows of costs and audits at a time. No audit can be the beginning of another of equal cost, as that
would have the cost of more inserts, so the least audits of the parts make the least of the whole.

The repaired text is hashed while its turns stream by, sorted, one batch at a time: texts move once, and a task holds no
conversation but its audit. A digest runs through its text in order, so a conversation's texts pass one task.

Defined cases: nulls count as one space when a row is damaged and hashed; turns of one number are ordered by role, then digest of the
text; an initial is a role's first character, an empty role has none; all null ids are one conversation; equal rows
are turns like any other (later ones are duplicates); ids and turns that aren't numbers are refused by Spark's cast; an
empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rimline.llm.common import cut, slices, table

#: Turns that are searched at a time.
SEGMENT = 64
#: Turns that the lower bound takes together.
BOUND = 16
#: Searches a task remembers before it starts anew.
REMEMBERED = 20_000

RETYPE, DELETE, INSERT, BROKEN = 1, 2, 5, 5
#: What may stand before a turn: nothing, or the initial of a role.
STATES = ("", "s", "u", "a")
#: The role that has to follow, which inserting and changing roles can make.
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}
#: The states that may stand on the way to a goal: once a user or an assistant has spoken, there is no way back.
WAYS = {"": ("",), "s": ("", "s"), "u": STATES, "a": STATES, None: STATES}
#: What ends a conversation after each state: inserts only.
CLOSING = {"": "", "s": "II", "u": "I", "a": "", "end": ""}

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
#: How a turn is written for the search: its initial, in capitals if it is truncated; "x" must go; "o" and "O" are other roles.
MUST_GO = "x"


def symbol(role: str, fault: str | None) -> str:
    if fault in (BLANK, DUPLICATE):
        return MUST_GO
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if fault == TRUNCATED else initial


def edits(state: str, turn: str) -> Iterator[tuple[int, str, str, bool]]:
    """(cost, initial, state after, whether the turn is done) of what can be done before or with a turn."""
    after = NEXT[state]
    yield INSERT, "I", after, False
    yield DELETE, "D", state, True
    if turn == MUST_GO:
        return
    broken = BROKEN if turn.isupper() else 0
    kept = turn.lower()
    if kept == after or (kept == "s" and state == ""):
        yield broken, "K", kept, True
    yield broken + RETYPE, "R", after, True


def suffix_bounds(turns: str) -> list[dict[str, int]]:
    """What the turns from each place on cost at least after each state.

    Turns are taken in blocks of ``BOUND``. Within a block this is the cheapest way from the state to whatever role may stand at the
    block's end; later blocks add what each costs after whatever state is best for it.
    """
    later = dict.fromkeys(STATES, 0)
    bounds = [later]
    for i in range(len(turns) - 1, -1, -1):
        if (i + 1) % BOUND == 0:
            later = dict.fromkeys(STATES, min(later.values()))
        found = {}
        for state in STATES:
            # At most two inserts before the turn; those are of use that lead to another state.
            ways, spent = [], 0
            before = state
            for _ in range(3):
                ways += [spent + more + later[after] for more, _, after, done in edits(before, turns[i]) if done]
                before, spent = NEXT[before], spent + INSERT
            found[state] = min(ways)
        later = found
        bounds.append(found)
    return bounds[::-1]


Found = tuple[int, str]


def search(turns: str, state: str, goal: str | None) -> Found | None:
    """The least (cost, audit) from a state over all turns to the goal, or to a whole conversation if that is None.

    Depth first with an explicit stack. The incumbent is the best whole result so far; ``reached`` holds for each node
    (place, state) the least (cost, audit) that came there; the search is over, and the incumbent proved, when the stack is empty.
    """
    if state not in WAYS[goal]:
        return None
    bounds, ways = suffix_bounds(turns), WAYS[goal]
    incumbent: Found | None = None
    reached: dict[tuple[int, str], Found] = {}
    stack: list[tuple[int, int, str, str]] = [(0, 0, state, "")]
    while stack:
        cost, at, before, audit = stack.pop()
        if incumbent is not None and cost + bounds[at][before] > incumbent[0]:
            continue
        prefix = (cost, audit)
        best = reached.get((at, before))
        if best is not None and best <= prefix:  # Inserts that lead back to a state end here, too.
            continue
        reached[at, before] = prefix
        if at == len(turns):
            if goal is None:
                prefix = (cost + INSERT * len(CLOSING[before]), audit + CLOSING[before])
            if goal in (None, before) and (incumbent is None or prefix < incumbent):
                incumbent = prefix
            continue
        children = [(cost + more, at + done, after, audit + initial) for more, initial, after, done in edits(before, turns[at]) if after in ways]
        children.sort(key=lambda c: (c[0] + bounds[c[1]][c[2]], c[3]), reverse=True)
        stack.extend(children)
    return incumbent


def transfers(turns: str, whole: bool) -> list[tuple[str, str, int, str]]:
    """(state before, state after, cost, audit) of a segment for each pair that can be, or of a whole conversation."""
    if whole:
        return [("", "end", *search(turns, "", None))]
    found = ((before, after, search(turns, before, after)) for before in STATES for after in STATES)
    return [(before, after, *best) for before, after, best in found if best is not None]


def joined(held: dict[str, Found], segment: Iterable[tuple[str, str, int, str]]) -> dict[str, Found]:
    """The least (cost, audit) to each state after one more segment."""
    out: dict[str, Found] = {}
    for before, after, cost, audit in segment:
        if before in held:
            whole = (held[before][0] + cost, held[before][1] + audit)
            if after not in out or whole < out[after]:
                out[after] = whole
    return out


def closed(held: dict[str, Found]) -> Found:
    """The least (cost, audit) of a whole conversation."""
    return min((cost + INSERT * len(CLOSING[state]), audit + CLOSING[state]) for state, (cost, audit) in held.items())


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after the damage that the rows' ids choose; dropped rows have 0 copies."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


ORDER = ("conv_id", "turn", "role", "digest")
WHITE = " \t\n\v\f\r"


def light(rows: DataFrame) -> DataFrame:
    """Damaged rows without texts: equal turns as one row with their copies, and the fault of the first of these."""
    trimmed = F.rtrim("text", F.lit(WHITE))
    own = F.when(trimmed == "", BLANK).when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), TRUNCATED)
    there = F.col("copies") > 0
    slim = rows.select(
        "conv_id",
        F.when(there, F.col("turn")).alias("turn"),
        F.when(there, F.col("role")).otherwise("").alias("role"),
        F.when(there, digest()).alias("digest"),
        F.when(there, own).alias("fault"),
        "copies",
    )
    turns = cut(slim.groupBy(*ORDER).agg(F.sum("copies").alias("copies"), F.first("fault").alias("fault")))
    place = F.struct(F.col("turn").isNotNull().alias("set"), "turn")
    said = turns.where("copies > 0 and (fault is null or fault <> 'blank')").groupBy("conv_id", "role", "digest")
    earliest = said.agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1")
    earliest = earliest.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(place) & (F.col("fault").isNull() | (F.col("fault") != BLANK))
    return turns.join(earliest, same, "left").select(*ORDER, "copies", F.when(again, DUPLICATE).otherwise(F.col("fault")).alias("fault"))


def digest():
    """128 bits stand for a text."""
    return F.md5(F.col("text").cast("binary"))


@dataclass
class Counts:
    """What is counted along a conversation; two that follow each other can be added."""

    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    distinct: int = 0
    least: int | None = None
    most: int | None = None
    first: str | None = None
    last: str | None = None

    def add(self, other: Counts) -> None:
        if other.least is not None:
            self.distinct += other.distinct - (self.most == other.least)
            self.least = other.least if self.least is None else self.least
            self.most = other.most
        if other.turns:
            if self.turns:
                self.illegal += f"{self.last}{other.first}" not in ("su", "ua", "au")
            else:
                self.first = other.first
            self.last = other.last
        for name in ("turns", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(other, name))

    @classmethod
    def of(cls, turn: int | None, role: str, fault: str | None) -> Counts:
        return cls(1, fault == BLANK, fault == DUPLICATE, fault == TRUNCATED, 0, turn is not None, turn, turn, role[:1], role[:1])

    @property
    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.distinct


COUNTED = ("turns", "blank", "duplicate", "truncated", "illegal", "distinct", "least", "most", "first", "last")
SEGMENTS = (
    "conv_id long, part int, number long, turns long, blank long, duplicate long, truncated long, illegal long, distinct long, least long, most long, "
    "first string, last string, before array<string>, after array<string>, costs array<long>, audits array<string>"
)
SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REPAIRED = f"{SUMMARY}, repaired_sha256 string"


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _rows(batches: Iterable[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for part in slices(batches):
        yield from zip(*(part[name] for name in names))


def _grouped(rows: Iterator[tuple], schema: pa.Schema, most: int = 1024) -> Iterator[pa.RecordBatch]:
    """The rows as batches."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _batch(held, schema)
            held = []
    yield _batch(held, schema)


def segments(turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Runs of at most ``size`` turns of a conversation, in order, with their counts and transfers."""
    schema = _arrow(SEGMENTS)

    def cut_up(rows: Iterator[tuple]) -> Iterator[tuple]:
        solved: dict[tuple[str, bool], list] = {}
        part = TaskContext.get().partitionId()
        known, number, begun = None, 0, False
        counts, symbols = Counts(), []

        def made(ended: bool) -> tuple:
            key = "".join(symbols), begun and ended
            if key not in solved:
                if len(solved) >= REMEMBERED:
                    solved.clear()
                solved[key] = transfers(*key)
            before, after, costs, audits = map(list, zip(*solved[key]))
            return (known[0], part, number, *(getattr(counts, name) for name in COUNTED), before, after, costs, audits)

        for conv_id, turn, role, copies, fault in rows:
            if known is None or known[0] != conv_id:
                if known is not None:
                    yield made(ended=True)
                # The first conversation of a task may have begun, and the last may go on, in another.
                begun = known is not None
                known, counts, symbols, number = (conv_id,), Counts(), [], number + 1
            for copy in range(copies):
                if len(symbols) == size:
                    yield made(ended=False)
                    counts, symbols, number, begun = Counts(), [], number + 1, False
                own = fault if copy == 0 or fault == BLANK else DUPLICATE
                counts.add(Counts.of(turn, role, own))
                symbols.append(symbol(role, own))
        if known is not None:
            yield made(ended=False)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _grouped(cut_up(_rows(batches, ("conv_id", "turn", "role", "copies", "fault"))), schema)

    return turns.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(run, SEGMENTS)


def summaries(found: DataFrame) -> DataFrame:
    """A row for each conversation: counts, cost and audit."""
    schema = _arrow(SUMMARY)

    def join_up(rows: Iterator[tuple]) -> Iterator[tuple]:
        known, counts, held = None, Counts(), {}

        def whole() -> tuple:
            return (known[0], counts.gaps, counts.blank, counts.duplicate, counts.truncated, counts.illegal, *closed(held))

        for conv_id, *values, before, after, costs, audits in rows:
            if known is None or known[0] != conv_id:
                if known is not None:
                    yield whole()
                known, counts, held = (conv_id,), Counts(), {"": (0, "")}
            counts.add(Counts(*values))
            held = joined(held, zip(before, after, costs, audits))
        if known is not None:
            yield whole()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _grouped(join_up(_rows(batches, ("conv_id", *COUNTED, "before", "after", "costs", "audits"))), schema)

    return found.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number").mapInArrow(run, SUMMARY)


class Writer:
    """Applies an audit to turns that come in order and hashes what is left."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, ""
        self.hash, self.any = hashlib.sha256(), False

    def _write(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any, self.state = True, role[:1]

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._write(FULL[NEXT[self.state]], "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._write(role, text)
        elif edit == "R":
            self._write(FULL[NEXT[self.state]], text)

    def digest(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


def repaired(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """The summaries with the digest of each repaired conversation."""
    schema = _arrow(REPAIRED)
    head = StructType.fromDDL(SUMMARY).names
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(SUMMARY).fields[1:]]
    texts = rows.where("copies > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", digest().alias("digest"), "text", "copies", *nothing)
    firsts = summary.select("conv_id", F.lit(0).alias("kind"), *(F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("role", "string"), ("digest", "string"), ("text", "string"), ("copies", "long"))), *head[1:])
    order = ("conv_id", "kind", "turn", "role", "digest")

    def hash_up(rows: Iterator[tuple]) -> Iterator[tuple]:
        summed, writer = None, None
        for kind, role, text, copies, *summary in rows:
            if kind == 0:
                if summed is not None:
                    yield (*summed, writer.digest())
                summed, writer = summary, Writer(summary[-1])
                continue
            for _ in range(copies):
                writer.turn(role, text)
        if summed is not None:
            yield (*summed, writer.digest())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _grouped(hash_up(_rows(batches, ("kind", "role", "text", "copies", *head))), schema)

    return firsts.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, REPAIRED)


def repair(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """A row for each conversation of (conv_id, turn, role, text, copies): faults, the cheapest edits and the digest after them."""
    return repaired(rows, cut(summaries(cut(segments(light(rows), size)))))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))
