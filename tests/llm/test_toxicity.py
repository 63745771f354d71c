"""The ordinal model against planted grades and held-out labels."""

import numpy as np
from pyspark.sql import functions as F

from rimline.llm.common import table
from rimline.llm.toxicity import Model, fit, learn, op8_ordinal_toxicity, severity


def test_thresholds_share_weights_and_stay_in_order():
    rng = np.random.default_rng(7)
    features = [f"w{i}" for i in range(30)]
    strength = np.concatenate([np.linspace(1, 3, 5), np.zeros(25)])
    held = rng.random((3000, 30)) < 0.2
    score = held @ strength + rng.logistic(size=3000)
    grades = (score > 1.5).astype(int) + (score > 3.5)
    texts = [{f for f, h in zip(features, row) if h} for row in held]
    model = fit(texts[:2000], grades[:2000], features, penalty=1e-4)
    assert model.thresholds[0] < model.thresholds[1]
    chances = np.array([model.chances(t) for t in texts[2000:]])
    assert np.allclose(chances.sum(axis=1), 1)
    expected = chances @ np.arange(3)
    assert np.corrcoef(expected, held[2000:] @ strength)[0, 1] > 0.95
    weights = np.array([model.weights[f] for f in features])
    assert weights[:5].min() > np.abs(weights[5:]).max()


def test_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)) == 0
    model = learn(docs, labels.where(~held))
    found = severity(docs, model).join(labels.where(held), "doc_id").toPandas()
    # Texts turned to junk have lost the words that made them toxic, but not the label.
    toxic = found[(found.toxic == 1) & (found.quality == 1)]
    clean = found[found.toxic == 0]
    assert (toxic.grade > 0).mean() > 0.93
    assert (clean.grade == 0).mean() > 0.98
    assert toxic.expected_severity.mean() > 1 > 0.2 > clean.expected_severity.mean()
    assert set(toxic.grade) >= {1, 2}


def test_query(spark):
    found = op8_ordinal_toxicity(spark, "/root/testdata/sf0.01").toPandas()
    assert len(found) == 1000 and found.doc_id.is_unique
    assert np.allclose(found[["p_clean", "p_toxic", "p_severe"]].sum(axis=1), 1)
    assert np.allclose(found.expected_severity, found.p_toxic + 2 * found.p_severe)


def test_odd_rows_and_labels(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (2, "bad " * 50_000, 3), (None, "good", 4)], "doc_id long, text string, grade int")
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    assert severity(docs, None).agg(F.max("grade")).first()[0] == 0
    model = learn(docs, labels)
    assert severity(docs, model).count() == 4
    assert learn(docs, labels.limit(0)) is None
    assert severity(docs.limit(0), Model({"x": 1.0}, (0.0, 1.0))).count() == 0
