"""Quality rules: a decision list learned from labelled statistics.

Each text becomes a few counts and ratios. From a bounded sample of labelled rows, sequential covering
grows conjunctions of thresholds that hold for poor documents (by FOIL's gain, on two thirds of
the sample), prunes each on the other third, and keeps it while it is precise there. The rules come out in order as one
conditional expression that Spark evaluates for every document.

Defined cases: a null text has no words; words are parted by ASCII white space; rows with null or
repeated ids are judged like any other; without labelled poor and good documents no rule is learned
and the base rules alone decide; an empty table gives no rows; other columns are passed on or
left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rimline.llm.common import table, utf8, whole_row

#: Labelled rows that rules may be learned from: those of the least id hashes.
SAMPLE = 20_000
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
FEWEST_WORDS = 10
MOST_REPEATED = 20
#: What a rule must reach on the rows that it was not grown on.
PRECISION = 0.97
LEAST_COVERED = 5
MOST_CONDITIONS = 3
MOST_RULES = 12
#: Thresholds tried for a statistic: beside so many quantiles of its values.
CUTS = 32

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")
#: Statistics that rules may test, as SQL over the counts.
STATISTICS = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
    "words": "cast(n_words as double)",
}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words within windows that stand twice or more in the text, the first included."""
    if len(words) < window + 1:
        return 0
    known: dict[bytes, int] = {}
    numbers = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    keys, base = numbers[: len(words) - window + 1], len(known)
    for i in range(1, window):
        if base * len(known) >= 1 << 62:  # Numbers stay exact.
            distinct, keys = np.unique(keys, return_inverse=True)
            base = len(distinct)
        keys = keys * len(known) + numbers[i : len(words) - window + 1 + i]
        base *= len(known)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    held = np.zeros(len(words) + 1, np.int64)
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    starts = np.flatnonzero(again)
    held[starts] += 1
    np.add.at(held, starts + window, -1)
    return int((np.cumsum(held) > 0).sum())


def counts(text: bytes) -> tuple[int, ...]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    inside = text.translate(None, SPACE)
    capitals = len(inside) - len(inside.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return (
        len(words),
        len(inside.decode()),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        capitals,
        len(text) - len(text.translate(None, b"!?")),
    )


def _counting(schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(zip(*(counts(text.as_py()) for text in batch.column("_bytes")))) or [[]] * len(COUNTS)
            new = {f"_{name}": pa.array(values, pa.int64()) for name, values in zip(COUNTS, made)}
            yield pa.RecordBatch.from_arrays([new[f.name] if f.name in new else batch.column(f.name) for f in schema], schema=schema)

    return run


def counted(docs: DataFrame) -> DataFrame:
    """The rows with the counts of their texts, each named with a leading underscore."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType(list(docs.schema.fields))
    for name in COUNTS:
        schema = schema.add(f"_{name}", "long")
    return docs.withColumn("_bytes", utf8()).mapInArrow(_counting(to_arrow_schema(schema)), schema)


def base_failed() -> Column:
    return (F.col("_n_words") < FEWEST_WORDS) | (100 * F.col("_n_repeat_words") > MOST_REPEATED * F.col("_n_words"))


def statistic(name: str) -> Column:
    sql = STATISTICS[name]
    for count in sorted(COUNTS, key=len, reverse=True):
        sql = sql.replace(count, f"`_{count}`").replace("`_`_", "`_").replace("``", "`")
    return F.expr(sql)


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        found = values[self.statistic]
        return found > self.threshold if self.above else found <= self.threshold

    def column(self) -> Column:
        found = statistic(self.statistic)
        return found > self.threshold if self.above else found <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], size: int) -> np.ndarray:
    held = np.ones(size, bool)
    for condition in rule:
        held &= condition.holds(values)
    return held


def _thresholds(found: np.ndarray) -> list[float]:
    """Midpoints between neighbouring values, at the quantiles: a rule keeps a margin to the values on either side."""
    known = np.unique(found)
    places = np.searchsorted(known, np.quantile(found, np.linspace(0, 1, CUTS + 1)[:-1], method="lower"))
    places = np.unique(places[places < len(known) - 1])
    return ((known[places] + known[places + 1]) / 2).tolist()


def _grow(values: dict[str, np.ndarray], poor: np.ndarray) -> Rule:
    """Conditions added one by one, each of the largest gain, until only poor rows are covered."""
    rule: Rule = ()
    held = np.ones(len(poor), bool)
    while len(rule) < MOST_CONDITIONS and (held & ~poor).any():
        p, n = (held & poor).sum(), held.sum()
        if not p:
            break
        best, gain = None, 1e-9
        for name, found in values.items():
            for threshold in _thresholds(found[held]):
                for above in (True, False):
                    condition = Condition(name, above, threshold)
                    now = held & condition.holds(values)
                    q = (now & poor).sum()
                    if q and (won := q * (np.log2(q / now.sum()) - np.log2(p / n))) > gain:
                        best, gain = condition, won
        if best is None:
            break
        rule += (best,)
        held &= best.holds(values)
    return rule


def _prune(rule: Rule, values: dict[str, np.ndarray], poor: np.ndarray) -> Rule:
    """The first conditions of the rule that are worth most on rows it was not grown on."""

    def worth(size: int) -> float:
        held = _covers(rule[:size], values, len(poor))
        return ((held & poor).sum() - (held & ~poor).sum()) / max(held.sum(), 1)

    return rule[: max(range(1, len(rule) + 1), key=worth)]


def learn(values: dict[str, np.ndarray], poor: np.ndarray, prune_on: np.ndarray) -> list[Rule]:
    """Rules in order; each covers poor rows that those before it left."""
    rules: list[Rule] = []
    left = np.ones(len(poor), bool)
    while len(rules) < MOST_RULES:
        grow_on, check_on = left & ~prune_on, left & prune_on
        part = lambda rows: {name: found[rows] for name, found in values.items()}
        if not (grow_on & poor).any() or not check_on.any():
            break
        rule = _grow(part(grow_on), poor[grow_on])
        if not rule:
            break
        rule = _prune(rule, part(check_on), poor[check_on])
        held = _covers(rule, part(check_on), check_on.sum())
        right = (held & poor[check_on]).sum()
        if right < LEAST_COVERED or right < PRECISION * held.sum():
            break
        rules.append(rule)
        left &= ~_covers(rule, values, len(poor))
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Rules from the texts of at most ``sample`` labelled documents, picked by a hash of their ids."""
    known = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").alias("_quality"))
    known = known.groupBy("_id").agg(F.min("_quality").alias("_quality")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    # The sample bounds this side: 20,000 rows of two numbers.
    rows = counted(texts.join(F.broadcast(known), "_id"))
    rows = rows.where(~base_failed()).select(
        (F.col("_quality") == 0).alias("poor"), (F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(3)) == 0).alias("check"), *(statistic(s).cast("double").alias(s) for s in STATISTICS)
    )
    found = rows.toPandas().sort_values([*STATISTICS, "poor", "check"])
    values = {name: found[name].to_numpy(float) for name in STATISTICS}
    return learn(values, found["poor"].to_numpy(bool), found["check"].to_numpy(bool))


def verdict(rules: list[Rule]) -> Column:
    """True where no rule rejects the document; the rule that does is the first that holds."""
    choice = F.lit(True)
    for rule in reversed(rules):
        held = rule[0].column()
        for condition in rule[1:]:
            held = held & condition.column()
        choice = F.when(held, F.lit(False)).otherwise(choice)
    return choice


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows with their counts, _base_failed and _kept."""
    failed = base_failed()
    return counted(docs).withColumn("_base_failed", failed).withColumn("_kept", ~failed & verdict(rules))


def only_kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rules = fit_rules(docs, labels)
    return judged(docs.select(whole_row(docs), "text"), rules).where("_kept").select("row.*")


def op6_learned_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit_rules(docs, table(spark, sf_dir, "labels"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged(docs, rules).select("doc_id", *(F.col(f"_{name}").alias(name) for name in names))
