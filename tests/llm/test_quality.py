"""Counts against a plain reading of their definitions; rules against planted ones and held-out labels."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from rimline.llm import quality
from rimline.llm.common import table
from rimline.llm.quality import counts, fit_rules, judged, learn, op6_learned_decision_list, only_kept

SF_DIR = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_query_on_given_documents(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()}
    found = op6_learned_decision_list(spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for r in found:
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)
        assert r.base_failed == (n_words < 10 or 100 * n_repeat_words > 20 * n_words)
        assert not (r.base_failed and r.kept)


def test_counts_on_odd_texts():
    rng = random.Random(2)
    texts = [None, "", " \n\t\x0b\x0c\r", "a", "é ü ß \x1c x", "A!B? <#>|"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += ["\n".join(rng.choice(["x y", "x y ", "", "z"]) for _ in range(12)) for _ in range(20)]
    for text in texts:
        assert counts((text or "").encode())[:5] == brute(text)
    many = [f"w{i}" for i in range(9000)]
    assert counts(" ".join(many + many[:7]).encode())[4] == 14


def test_rules_find_planted_thresholds():
    rng = np.random.default_rng(1)
    values = {"a": rng.random(3000), "b": rng.random(3000)}
    poor = (values["a"] > 0.9) | ((values["b"] < 0.1) & (values["a"] < 0.4))
    rules = learn(values, poor, rng.random(3000) < 0.33)
    said = np.zeros(3000, bool)
    for rule in rules:
        said |= quality._covers(rule, values, 3000)
    assert (said & poor).sum() > 0.9 * poor.sum()
    assert (said & ~poor).sum() < 0.02 * (~poor).sum()


def test_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = table(spark, sf_dir, "labels")
    held = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2)) == 0
    rules = fit_rules(table(spark, sf_dir, "documents"), labels.where(~held))
    assert rules
    found = judged(table(spark, sf_dir, "documents").select("doc_id", "text"), rules).join(labels.where(held), "doc_id").collect()
    good = [r for r in found if r.quality == 1]
    poor = [r for r in found if r.quality == 0]
    assert sum(r._kept for r in good) >= 0.97 * len(good)
    assert sum(not r._kept for r in poor) >= 0.8 * len(poor)


def test_odd_rows_and_no_labels(spark):
    rows = [(1, None, "x"), (1, "ten words " * 5, "x"), (None, "a b c d e f g h i j k", None), (2, "", "y"), (3, "z" * 200_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fit_rules(docs, none) == []
    kept = only_kept(docs, none)
    assert kept.columns == docs.columns
    assert [r.text for r in kept.collect()] == ["a b c d e f g h i j k"]
    assert only_kept(docs.limit(0), none).count() == 0
