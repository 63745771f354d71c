"""Fingerprints of documents and of their edited texts against a plain reading."""

import hashlib

import numpy as np

from rimline.llm import fingerprints
from rimline.llm.common import WordHashes, table
from rimline.llm.fingerprints import likeness, op3_phrase_fingerprints, paired_fingerprints, phrases, signature, written

SF_DIR = "/root/testdata/sf0.001"


def pairs(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    return [(i, t, rows[(k + 1) % len(rows)][1]) for k, (i, t) in enumerate(rows)]


def expected(rows):
    out = []
    hashes = WordHashes()
    for i, text, after in pairs(rows):
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        own, other, its = (signature(t, hashes) for t in (text, edit, after))
        out.append((i, len(text), hashlib.sha256(edit.encode()).hexdigest(), written(own), written(other), likeness(own, other), likeness(own, its)))
    return sorted(out, key=str)


def test_query_on_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    found = op3_phrase_fingerprints(spark, SF_DIR).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows)


def test_many_ranges_odd_ids_and_texts(spark):
    rows = [(i * i * i - 5000, f"text {i} " * (i % 9)) for i in range(120)] + [(7, "b"), (7, "a"), (7, "a"), (None, "n"), (None, None), (10**15, "é" * 30_001), (-(10**15), "no space" * 9)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, range int")
    for size in (3, 1000):
        assert sorted(map(tuple, paired_fingerprints(docs, range_rows=size).collect()), key=str) == expected(rows)


def test_one_document_and_none(spark):
    docs = spark.createDataFrame([(4, "abcd efgh")], "doc_id long, text string")
    assert [tuple(r) for r in paired_fingerprints(docs).collect()] == expected([(4, "abcd efgh")])
    assert paired_fingerprints(docs.limit(0)).count() == 0


def test_many_steps_between_bounds(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "MOST_CUTS", 3)
    rows = [(i * i, f"t{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, paired_fingerprints(docs, range_rows=4).collect()), key=str) == expected(rows)


def test_phrases_are_those_of_the_parse():
    hashes = WordHashes()
    assert len(phrases("a a a a a a", hashes)) == 3  # a, aa, aaa
    assert len(phrases("a b a c a b c", hashes)) == 5  # a, b, ac, ab, c
    assert phrases("", hashes) == set()


def test_likeness_follows_shared_phrases():
    hashes = WordHashes()
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in rng.integers(0, 5000, 3000)]
    text = " ".join(words)
    own = signature(text, hashes)
    assert likeness(own, signature(text, hashes)) == 1.0
    near = likeness(own, signature(" ".join(words[:2900]), hashes))
    far = likeness(own, signature(" ".join(f"v{i}" for i in range(3000)), hashes))
    assert near > 0.85 and far == 0.0
    exact = phrases(text, hashes), phrases(" ".join(words[:1500]), hashes)
    share = len(exact[0] & exact[1]) / len(exact[0] | exact[1])
    assert abs(likeness(own, signature(" ".join(words[:1500]), hashes)) - share) < 0.2
