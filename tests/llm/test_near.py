"""The Jaccard join against all pairs compared."""

import random

import pytest

from rimline.llm.near import bands, keep_one, near_classes, op10_ngram_jaccard_join
from rimline.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def grams(text):
    words = (text or "").encode().split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(rows):
    """(id, rep, copies, class, links) of every row, by comparing all pairs."""
    rows = [(i, frozenset(grams(t))) for i, t in rows if i is not None]
    links = [[j for j, (_, b) in enumerate(rows) if j != i and a and b and len(a & b) >= 0.8 * len(a | b)] for i, (_, a) in enumerate(rows)]
    out = []
    for i, (doc, a) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        same = [d for d, b in rows if b == a] if a else [doc]
        out.append((doc, min(same), len(same), min(rows[j][0] for j in seen), len(links[i])))
    return sorted(out)


def found(df):
    return sorted((r.doc_id, r.rep_id, r.copies, r.class_id, r.n_links) for r in df.collect())


def test_bands_reach_the_recall():
    number, rows = bands(0.8, 0.9995)
    assert 1 - (1 - 0.8**rows) ** number >= 0.9995


def test_given_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert any(row[4] for row in expected)
    assert found(op10_ngram_jaccard_join(spark, SF_DIR)) == expected


def test_chains_blocks_nulls_and_repeats(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    rows = []
    for i in range(90):  # A drifting chain: neighbours are similar, the ends are not.
        base[rng.randrange(120)] = word()
        rows.append((i, " ".join(base)))
    rows += [(200, "one two"), (201, "one\ttwo"), (202, "two one"), (203, ""), (204, None), (205, "  \n"), (None, "one two")]
    rows += [(300, rows[3][1]), (300, "other words under the very same id"), (301, "x" * 100_000), (302, "x" * 100_000)]
    rows += [(303, "so " * 50_000), (304, "so so so so so")]
    docs = spark.createDataFrame([(i, t, "node", 7) for i, t in rows], "doc_id long, text string, head string, text_n int")
    assert found(near_classes(docs, block=16)) == brute(rows)


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (2, text + " more"), (9, "alone in here"), (9, "alone in here"), (None, "x"), (11, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((tuple(r) for r in keep_one(docs).collect()), key=str)
    assert kept == sorted([(2, text + " more"), (9, "alone in here"), (None, "x"), (11, None)], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_classes(docs).count() == 0
    assert keep_one(docs).count() == 0


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95])
def test_bands_stay_within_the_hashes(threshold):
    number, rows = bands(threshold, 0.999)
    assert number * rows <= 192
