"""Severity of toxic texts by cumulative-link ordinal regression.

Grades are ordered: 0 clean, 1 toxic, 2 severely toxic. The model is

    P(grade <= g) = sigmoid(threshold_g - w . x),

one weight vector for all thresholds, which are kept in order by fitting their first and the logarithms of the
steps between them. x are the presences of words, letters and digits folded to lower case, and of their first
letters, as many languages put endings to a stem; known are those that differ most between labels in
the sample. The model is fitted on a bounded sample of labelled rows;
every whole text is scored.

The labels only part toxic from clean. Toxic rows of the sample count as severe if more different features that mark
toxic texts stand in them than in the median toxic row.

Defined cases: a null or empty text has no words and gets the grade of the thresholds alone; rows with null or
repeated ids are scored like any other; without labelled rows of both kinds all texts have
grade 0; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimline.llm.common import cut, slices, table, utf8
from rimline.llm.licenses import FOLD

#: Labelled rows the model may be fitted on: of either label half of them, those of the least id hashes.
SAMPLE = 8_000
#: Words and beginnings known to the model.
FEATURES = 1024
#: Letters of a word's beginnings.
BEGINNINGS = (4, 5, 6, 7)
#: Documents of the sample that a known word must be in.
LEAST_DOCUMENTS = 3
#: Words with a toxic share this far above the sample's mark toxic texts.
MARKING = 0.9
GRADES = 3
PENALTY = 1e-4
STEPS = 600
RATE = 0.05


def features_of(text: bytes) -> set[str]:
    """The words of a text, and beginnings of longer ones marked by a star."""
    words = set(text.translate(FOLD).decode().split())
    found = set(words)
    for size in BEGINNINGS:
        found.update([w[:size] + "*" for w in words if len(w) > size])
    return found


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def chances(self, words: set[str]) -> list[float]:
        """The probability of each grade."""
        known = self.weights
        score = sum(sorted(known[w] for w in known.keys() & words))
        below = [1 / (1 + np.exp(-min(max(t - score, -500.0), 500.0))) for t in self.thresholds] + [1.0]
        return [float(b - a) for a, b in zip([0.0, *below], below)]


def fit(texts: list[set[str]], grades: np.ndarray, features: list[str], steps: int = STEPS, penalty: float = PENALTY) -> Model:
    """Weights and ordered thresholds of the largest penalised likelihood, by Adam's method over all rows."""
    place = {word: i for i, word in enumerate(features)}
    held = [sorted(place[w] for w in words if w in place) for words in texts]
    row = np.repeat(np.arange(len(held)), [len(h) for h in held])
    column = np.fromiter((i for h in held for i in h), np.int64, len(row))
    top = GRADES - 1
    # Clean rows and toxic ones weigh the same in sum, so a single mark can tip the scale.
    sizes = np.bincount(grades > 0, minlength=2)
    weight = (0.5 / np.maximum(sizes, 1))[(grades > 0).astype(int)]
    state = np.zeros(len(features) + top)
    state[len(features)] = 1.0
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, steps + 1):
        w, free = state[: len(features)], state[len(features) :]
        gaps = np.exp(free[1:])
        cuts = np.concatenate([[-np.inf], free[0] + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
        score = np.bincount(row, w[column], len(held))
        high, low = cuts[grades + 1] - score, cuts[grades] - score
        f_high, f_low = (1 / (1 + np.exp(-np.clip(x, -500, 500))) for x in (high, low))
        f_high, f_low = np.where(np.isinf(high), 1.0, f_high), np.where(np.isinf(low), 0.0, f_low)
        chance = np.maximum(f_high - f_low, 1e-12)
        d_high, d_low = f_high * (1 - f_high) / chance * weight, f_low * (1 - f_low) / chance * weight
        slope = np.zeros_like(state)
        slope[: len(features)] = np.bincount(column, (d_high - d_low)[row], len(features)) + penalty * w
        by_cut = np.array([d_low[grades == g + 1].sum() - d_high[grades == g].sum() for g in range(top)])
        slope[len(features)] = by_cut.sum()
        for g in range(1, top):
            slope[len(features) + g] = by_cut[g:].sum() * gaps[g - 1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        # Steps shrink to nothing, so the last ones settle.
        state = state - RATE * (1 - step / (steps + 1)) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    free = state[len(features) :]
    cuts = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
    return Model(dict(zip(features, state[: len(features)].tolist())), tuple(cuts.tolist()))


def sampled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(toxic, text) of at most ``sample`` labelled documents."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.groupBy("_id").agg(F.max("toxic").alias("toxic"))
    halves = [known.where(F.col("toxic") == v).orderBy(F.xxhash64("_id"), "_id").limit(sample // 2) for v in (0, 1)]
    # The sample bounds this side.
    picked = F.broadcast(cut(halves[0].union(halves[1])))
    return docs.select(F.col("doc_id").cast("long").alias("_id"), utf8().alias("text")).join(picked, "_id").select("toxic", "text")


def candidates(rows: DataFrame, n_clean: int, n_bad: int, most: int) -> list[tuple[str, int, int]]:
    """The features that part the labels best, with their clean and toxic documents. Counted by tasks, ranked by Spark."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for part in slices(batches):
            for label, text in zip(part["toxic"], part["text"]):
                for feature in features_of(text):
                    counts.setdefault(feature, [0, 0])[label] += 1
        clean, bad = zip(*counts.values()) if counts else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(clean, pa.int64()), pa.array(bad, pa.int64())], names=["feature", "clean", "bad"])

    size = n_clean + n_bad
    counted = rows.mapInArrow(count, "feature string, clean long, bad long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    counted = cut(counted.where(F.col("clean") + F.col("bad") >= min(LEAST_DOCUMENTS, size // 2)))

    def part(seen: Column, share: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / share)).otherwise(0.0)

    held = F.col("clean") + F.col("bad")
    # The likelihood ratio of a feature's documents against the labels.
    parting = 2 * (
        part(F.col("bad"), held * n_bad / size)
        + part(F.col("clean"), held * n_clean / size)
        + part(n_bad - F.col("bad"), (size - held) * n_bad / size)
        + part(n_clean - F.col("clean"), (size - held) * n_clean / size)
    )
    # Chance alone brings the best of so many candidates about to this.
    least = 2 * math.log(max(counted.count(), 2))
    best = counted.withColumn("parting", F.round(parting, 6)).where(F.col("parting") >= least)
    return [(r["feature"], r["clean"], r["bad"]) for r in best.orderBy(F.desc("parting"), "feature").limit(most).collect()]


def learn(docs: DataFrame, labels: DataFrame, features: int = FEATURES, sample: int = SAMPLE) -> Model | None:
    """The model of labelled texts; none if all have one label or nothing parts them.

    What comes to the driver: twice as many features as the model may have, and for each sampled text which of them it has.
    """
    rows = cut(sampled(docs, labels, sample))
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_clean, n_bad = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_bad:
        return None
    found = candidates(rows, n_clean, n_bad, 2 * features)
    place = {feature: i for i, (feature, _, _) in enumerate(found)}

    def hold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            held = [sorted(place[f] for f in features_of(text) if f in place) for text in part["text"]]
            yield pa.RecordBatch.from_arrays([pa.array(part["toxic"], pa.int32()), pa.array(held, pa.list_(pa.int32()))], names=["toxic", "held"])

    texts = sorted((list(r["held"]), r["toxic"]) for r in rows.mapInArrow(hold, "toxic int, held array<int>").collect())
    toxic = np.array([label for _, label in texts])
    # Of features in the same documents one will do: the longest, which comes with a word's beginnings.
    places: dict[int, list[int]] = {i: [] for i in place.values()}
    for row, (held, _) in enumerate(texts):
        for i in held:
            places[i].append(row)
    whole = {tuple(at): i for i, at in sorted(places.items(), key=lambda p: (len(found[p[0]][0]), found[p[0]][0]))}
    best = sorted(whole.values())[:features]
    if not best:
        return None
    marks = {i for i in best if found[i][2] / n_bad >= MARKING * (found[i][2] / n_bad + found[i][1] / n_clean)}
    strength = np.array([len(marks.intersection(held)) for held, _ in texts])
    grades = toxic * (1 + (strength > np.median(strength[toxic == 1])))
    return fit([{found[i][0] for i in held} for held, _ in texts], grades.astype(int), [found[i][0] for i in best])


SCORED = "doc_id long, grade int, expected_severity double, p_clean double, p_toxic double, p_severe double"


def severity(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: the likeliest grade, the expected one, and the probability of each."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(SCORED))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for doc_id, text in zip(part["doc_id"], part["text"]):
                chances = model.chances(features_of(text)) if model else [1.0, 0.0, 0.0]
                # The grade is the median one: the first that at least half of the probability lies at or below.
                grade = next((g for g in range(GRADES) if sum(chances[: g + 1]) >= 0.5), GRADES - 1)
                rows.append((doc_id, grade, sum(g * c for g, c in enumerate(chances)), *chances))
            columns = list(zip(*rows)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text")).mapInArrow(run, SCORED)


def op8_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return severity(docs, model).withColumn("toxic", F.col("grade") > 0)
