"""Soft-membership mixing: rates for documents, so that expected domain totals meet target weights.

1. A word classifier (Bayes over presence and absence of the most telling words of a bounded labelled sample)
   gives each document a posterior over the domains. Log odds end at ``softness``, so memberships stay soft.
2. The rates minimise, over r >= 0,

       sum_k (E_k(r) - t_k)^2 / (2 E_k(1))  +  ridge / 2 * sum_j n_j (r_j - 1)^2,

   where n_j are a document's tokens, E_k(r) = sum_j r_j n_j p_jk the expected tokens of a domain, and
   t_k its target. Steps follow the gradient in the metric of the tokens and are projected to r >= 0. Each is
   one aggregation over all documents: a row of one number for each domain comes back, and a
   document's rate is an expression of its posterior and those numbers.
3. A document is taken floor(r + u) times, u in [0, 1) being a hash of its id.

Everything runs as DataFrame functions. The totals are scaled so that documents of the anchor domain
alone keep a rate of about one.

Defined cases: words are parted by ASCII white space; a text without words, null included, has no
tokens, the prior as its posterior and a rate like any other; rows with equal ids count as one document of all
their texts; null ids are one such document; without labels all rates are one; a domain that no
document is expected in is left out of the fit; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimline.llm.common import cut, table, whole_row

#: Labelled rows that the classifier may be fitted on: those of the least id hashes.
SAMPLE = 20_000
#: Words the classifier knows; the most telling ones of the sample.
FEATURES = 4096
SMOOTHING = 0.5
MICRO = 1_000_000
#: Log odds beyond which a domain is no less likely, so memberships stay soft.
SOFTNESS = 6.0
RIDGE = 1e-3
STEPS = 40
#: How much more often than in those of the largest domain a word must be in the texts of some domain.
RATIO = 8.0
#: Steps stop when no domain's share of the total moves by more.
SETTLED = 1e-6

#: Target shares of the tokens by domain.
TARGETS = {"clean": 0.98, "poor": 0.005, "toxic": 0.015}
ANCHOR = "clean"
WORD_BREAK = r"[\x09-\x0D\x20]+"


def label_domain(domains: Iterable[str]) -> Column:
    """The domain of a row of the labels table. Where poor is not among the domains, poor texts are clean unless toxic."""
    toxic = F.when(F.col("toxic") == 1, "toxic")
    if "poor" in domains:
        return toxic.when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "clean")
    return toxic.when(F.col("toxic") == 0, "clean")


def _words(docs: DataFrame, id_name: str) -> DataFrame:
    """One row per distinct word of a text, the first with the number of all words; a row of a null word for a text without any."""
    words = F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), WORD_BREAK), lambda w: w != "")
    listed = docs.select(F.col("doc_id").cast("long").alias(id_name), words.alias("words"))
    each = listed.select(id_name, F.size("words").alias("size"), F.posexplode_outer(F.array_distinct("words")).alias("place", "word"))
    return each.select(id_name, "word", F.when(F.coalesce("place", F.lit(0)) == 0, F.col("size")).alias("size"))


def fit_classifier(docs: DataFrame, labels: DataFrame, domains: list[str], sample: int = SAMPLE, features: int = FEATURES) -> tuple[DataFrame, list[float]]:
    """(word, w0, w1, ...) of the telling words, and the log scores of a text with none of them. Weights are what a
    word's presence adds, in whole millionths, so that sums don't depend on the order of rows."""
    known = labels.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("_id"), label_domain(domains).alias("_domain"))
    known = known.where(F.col("_domain").isin(domains)).groupBy("_id").agg(F.min("_domain").alias("_domain"))
    # The sample bounds this side: 20,000 rows of an id and a name.
    known = F.broadcast(cut(known.orderBy(F.xxhash64("_id"), "_id").limit(sample)))
    held_rows = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_id"))
    words = _words(held_rows.select("doc_id", "text"), "_doc")
    words = words.where("word is not null").join(known, F.col("_doc") == F.col("_id"))
    each = [F.count(F.when(F.col("_domain") == d, 1)).alias(f"n{k}") for k, d in enumerate(domains)]
    counted = cut(words.groupBy("word").agg(*each))
    size = counted.count()
    # Of the labelled rows, those that are there: labels may outnumber the documents.
    seen = {r["_domain"]: r["count"] for r in held_rows.groupBy("_domain").count().collect()}
    sums = [float(seen.get(d, 0)) for d in domains]
    priors = [float(np.log((n + 1) / (sum(sums) + len(domains)))) for n in sums]
    found = sum((F.col(f"n{k}") for k in range(len(domains))), F.lit(0))
    # Half the likelihood ratio of the word's documents against the domains' sizes; chance alone brings the best word to about log(words).
    parts = (F.col(f"n{k}") * F.log(F.greatest(F.col(f"n{k}"), F.lit(1)) / (found * max(n, 1) / max(sum(sums), 1))) for k, n in enumerate(sums))
    telling = sum(parts, F.lit(0.0))
    held = [(F.col(f"n{k}") + SMOOTHING) / (n + 2 * SMOOTHING) for k, n in enumerate(sums)]
    # Words usual in the largest domain are missing from short texts and other languages, too, so that their absence
    # tells nothing: a marking word is far more usual in another domain. No share of a domain's texts is asked for, as a
    # smaller language's words would never have it.
    usual = held[int(np.argmax(sums))]
    marking = (F.greatest(*held) / usual >= RATIO) if len(domains) > 1 else F.lit(True)
    best = counted.withColumn("_telling", telling).where((F.col("_telling") >= float(np.log(max(size, 2)))) & marking)
    best = best.orderBy(F.desc("_telling"), "word").limit(features)
    present = (F.round(F.log(h / (1 - h)) * MICRO).cast("long").alias(f"w{k}") for k, h in enumerate(held))
    absent = (F.round(F.log(1 - h) * MICRO).cast("long").alias(f"b{k}") for k, h in enumerate(held))
    weights = cut(best.select("word", *present, *absent))
    without = weights.agg(*(F.sum(f"b{k}") for k in range(len(domains)))).first()
    return weights, [p + (b or 0) / MICRO for p, b in zip(priors, without)]


def posteriors(docs: DataFrame, weights: DataFrame, priors: list[float], softness: float = SOFTNESS) -> DataFrame:
    """(doc_id, n_tokens, p0, p1, ...): each document's words and its posterior over the domains."""
    ks = range(len(priors))
    # The weights are as many rows as there are features.
    rows = _words(docs, "doc_id").join(F.broadcast(weights), "word", "left")
    sums = rows.groupBy("doc_id").agg(F.sum("size").alias("n_tokens"), *(F.sum(f"w{k}").alias(f"s{k}") for k in ks))
    scores = sums.select("doc_id", "n_tokens", *((F.lit(priors[k]) + F.coalesce(f"s{k}", F.lit(0)) / MICRO).alias(f"l{k}") for k in ks))
    most = F.greatest(*(F.col(f"l{k}") for k in ks)) if len(priors) > 1 else F.col("l0")
    raised = scores.select("doc_id", "n_tokens", *(F.exp(F.greatest(F.col(f"l{k}") - most, F.lit(-softness))).alias(f"e{k}") for k in ks))
    total = sum((F.col(f"e{k}") for k in ks), F.lit(0.0))
    return raised.select("doc_id", "n_tokens", *((F.col(f"e{k}") / total).alias(f"p{k}") for k in ks))


def _stepped(rate: Column, pull: list[float], ridge: float) -> Column:
    """A projected step; pull holds each domain's residual over its size."""
    step = 1 / (1 + ridge)
    slope = sum((F.col(f"p{k}") * float(g) for k, g in enumerate(pull)), F.lit(0.0))
    return F.greatest(F.lit(0.0), rate * (1 - step * ridge) + F.lit(step * ridge) - slope * step)


def fit_rates(members: DataFrame, targets: list[float], anchor: int, ridge: float = RIDGE, steps: int = STEPS) -> DataFrame:
    """``members`` (doc_id, n_tokens, p0, ...) with a column rate; target weights need not sum to one."""
    ks = range(len(targets))

    def totals(df: DataFrame, rate: Column) -> np.ndarray:
        row = df.agg(*(F.sum(rate * F.col("n_tokens") * F.col(f"p{k}")) for k in ks)).first()
        return np.array([v or 0.0 for v in row])

    rate = F.lit(1.0)
    sizes = totals(members, rate)
    wanted = np.array(targets) / sum(targets)
    goal = wanted * (sizes[anchor] / wanted[anchor])
    open_ = sizes > 0
    if not open_.any():
        return members.withColumn("rate", rate)
    now, state = sizes, members
    for step in range(1, steps + 1):
        pull = np.where(open_, (now - goal) / np.where(open_, sizes, 1), 0.0)
        rate = _stepped(rate, pull.tolist(), ridge)
        if step % 20 == 0:  # Keeps the expression short.
            state = cut(state.withColumn("rate_", rate).drop("rate").withColumnRenamed("rate_", "rate"))
            rate = F.col("rate")
        before, now = now, totals(state, rate)
        if np.abs(now - before).max() <= SETTLED * sizes.sum():
            break
    return state.withColumn("rate", rate)


def copies(rate: Column, key: Column) -> Column:
    """How often a document is taken: the rate, rounded up or down by a hash of its id."""
    even = F.pmod(F.xxhash64(key, F.lit("mix")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return F.floor(rate + even)


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, anchor: str = ANCHOR) -> DataFrame:
    """(doc_id, n_tokens, p0, ..., rate), domains in the order of ``targets``."""
    domains = list(targets)
    weights, priors = fit_classifier(docs, labels, domains)
    members = cut(posteriors(docs, weights, priors))
    if weights.isEmpty():
        return members.withColumn("rate", F.lit(1.0))
    return fit_rates(members, list(targets.values()), domains.index(anchor))


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, anchor: str = ANCHOR) -> DataFrame:
    """The documents, each as often as its rate says. Other columns are passed on, whatever their names."""
    found = rates(docs, labels, targets, anchor).select(F.col("doc_id").alias("known"), copies(F.col("rate"), F.col("doc_id")).alias("copies"))
    rows = docs.select(whole_row(docs), F.col("doc_id").cast("long").alias("id"))
    joined = rows.join(found.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("known")), "left")
    return joined.select("row", F.explode(F.expr("array_repeat(0, cast(copies as int))"))).select("row.*")


def op1_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = rates(docs, labels)
    shares = [F.col(f"p{k}").alias(f"p_{domain}") for k, domain in enumerate(TARGETS)]
    return found.select("doc_id", "n_tokens", *shares, "rate", copies(F.col("rate"), F.col("doc_id")).alias("copies"))
