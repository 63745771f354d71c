"""The fit against a dense solver, the classifier against labels, and whole totals."""

import numpy as np
from pyspark.sql import functions as F

from rimline.llm.common import table
from rimline.llm.mixing import TARGETS, copies, fit_classifier, fit_rates, mixed, op1_soft_membership_mixing, rates

SF_DIR = "/root/testdata/sf0.01"


def test_rates_solve_the_least_squares(spark):
    rng = np.random.default_rng(4)
    tokens = rng.integers(0, 500, 300)
    p = rng.dirichlet([0.3, 0.3, 0.3], 300)
    rows = [(int(i), int(n), *map(float, q)) for i, (n, q) in enumerate(zip(tokens, p))]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, p0 double, p1 double, p2 double")
    found = {r.doc_id: r.rate for r in fit_rates(df, [0.6, 0.3, 0.1], 0).collect()}
    r = np.ones(300)
    sizes = (tokens[:, None] * p).sum(0)
    goal = np.array([0.6, 0.3, 0.1]) * sizes[0] / 0.6
    for _ in range(20_000):
        pull = ((tokens * r)[:, None] * p).sum(0) - goal
        r = np.maximum(0, r - 0.3 * (p @ (pull / sizes) + 1e-3 * (r - 1)))
    assert min(found.values()) >= 0
    reached = (tokens * np.array([found[i] for i in range(300)])) @ p
    assert np.abs(reached - (tokens * r) @ p).max() < 2e-3 * sizes.sum()
    assert np.abs(reached - goal).max() < 0.01 * goal.sum()


def test_query_meets_targets_and_labels(spark):
    found = op1_soft_membership_mixing(spark, SF_DIR).toPandas().set_index("doc_id")
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text", "lang").toPandas().set_index("doc_id")
    assert (found.n_tokens.sort_index() == docs.text.map(lambda t: len(t.encode().split())).sort_index()).all()
    names = [f"p_{d}" for d in TARGETS]
    assert np.allclose(found[names].sum(axis=1), 1)
    totals = (found[names].mul(found.n_tokens * found.rate, axis=0)).sum()
    assert np.abs(totals / totals.sum() - np.array(list(TARGETS.values()))).max() < 0.01
    assert (abs(found.copies - found.rate) < 1).all()
    labels = table(spark, SF_DIR, "labels").toPandas().set_index("doc_id")
    # Other languages have a handful of labelled toxic texts here, and texts turned to junk have lost the words.
    english = docs.lang.loc[labels.index] == "en"
    toxic = found.loc[labels.index[(labels.toxic == 1) & (labels.quality == 1) & english]]
    clean = found.loc[labels.index[(labels.toxic == 0) & (labels.quality == 1)]]
    assert (toxic.p_toxic > 0.5).mean() > 0.7
    assert (clean.p_clean > 0.5).mean() > 0.9


def test_odd_rows(spark):
    rows = [(1, "good words here", "p0"), (1, "good words here", "p0"), (2, None, None), (None, "x", "y"), (3, "", ""), (4, "bad " * 50_000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p0 string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 0, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in rates(docs, labels).collect()}
    assert {i: r.n_tokens for i, r in found.items()} == {1: 6, 2: 0, None: 1, 3: 0, 4: 50_000}
    assert all(r.rate >= 0 for r in found.values())
    assert mixed(docs, labels).columns == docs.columns
    none = labels.limit(0)
    assert {r.rate for r in rates(docs, none).collect()} == {1.0}
    assert mixed(docs, none).count() == len(rows)
    assert mixed(docs.limit(0), labels).count() == 0


def test_copies_average_to_the_rate(spark):
    df = spark.range(20_000).select(copies(F.lit(1.3), F.col("id")).alias("n"))
    assert abs(df.agg(F.avg("n")).first()[0] - 1.3) < 0.02


def test_toxic_texts_of_each_language_are_found(spark):
    folder = "/root/testdata/sf0.1"
    found = op1_soft_membership_mixing(spark, folder)
    labels = table(spark, folder, "labels").where("toxic = 1 and quality = 1")
    langs = table(spark, folder, "documents").select("doc_id", "lang")
    each = found.join(labels, "doc_id").join(langs, "doc_id").groupBy("lang").agg(F.avg((F.col("p_toxic") > 0.5).cast("int")).alias("share"))
    shares = {r.lang: r.share for r in each.collect()}
    assert len(shares) == 4 and min(shares.values()) > 0.7, shares


def test_class_sizes_are_of_documents_that_are_there(spark):
    docs = spark.createDataFrame([(i, f"own{i} " + ("foul" if i < 10 else "fine")) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i < 10)) for i in range(200)], "doc_id long, quality int, toxic int")
    absent = spark.createDataFrame([(i, 1, 1) for i in range(1000, 9000)], labels.schema)
    alone, beside = fit_classifier(docs, labels, ["clean", "toxic"]), fit_classifier(docs, labels.union(absent), ["clean", "toxic"])
    assert alone[1] == beside[1] and alone[0].collect() == beside[0].collect() != []


def test_poor_texts_have_a_posterior_and_a_lower_rate(spark):
    found = op1_soft_membership_mixing(spark, SF_DIR)
    assert "p_poor" in found.columns
    each = found.join(table(spark, SF_DIR, "labels").where("toxic = 0"), "doc_id").groupBy("quality")
    rows = {r.quality: r for r in each.agg(F.avg("rate").alias("rate"), F.avg("p_poor").alias("poor")).collect()}
    assert rows[0].poor > rows[1].poor and rows[0].rate < rows[1].rate


def test_domains_are_those_of_the_targets(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    assert rates(docs, labels, {"clean": 0.985, "toxic": 0.015}).columns == ["doc_id", "n_tokens", "p0", "p1", "rate"]
