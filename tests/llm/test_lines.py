"""Line dedup against a plain search of all runs."""

import random
import re

from rimline.llm.common import table
from rimline.llm.lines import dedup_lines, op2_winnowed_lines, without_repeats

SF_DIR = "/root/testdata/sf0.001"


def units_of(line):
    """The line cut after white space that follows the end of a sentence."""
    found, unit = [], ""
    for c, after in zip(line, line[1:] + "x"):
        unit += c
        ended = unit.rstrip(" \t\r\f\v")
        if after not in " \t\r\f\v" and c in " \t\r\f\v" and ended and ended[-1] in ".!?":
            found.append(unit)
            unit = ""
    return found + [unit] * (unit != "")


def brute(docs, min_words=30, min_line=5):
    """Texts by id: every run of every document looked up among all earlier places."""
    earliest, latest, runs, kept = {}, {}, {}, {}
    for doc, text in sorted((d for d in docs if d[1] is not None), key=lambda d: d[0]):
        lines = [(n, u.strip(" \t\r\f\v").encode()) for n, x in enumerate(text.split("\n")) if x.encode().split() for u in units_of(x)]
        sizes = [len(u.split()) for _, u in lines]
        found = []
        for i in range(len(lines)):
            words = 0
            for j in range(i, len(lines)):
                words += sizes[j]
                if words >= min_words:
                    found.append((i, j, False))
                    if words - sizes[i] - sizes[j] >= min_words:
                        break  # Shorter runs cover a longer one, and it is earlier wherever it stands.
        for n in {n for n, _ in lines}:
            of_line = [k for k, (m, _) in enumerate(lines) if m == n]
            if min_line and min_line <= sum(sizes[k] for k in of_line) < min_words:
                found.append((of_line[0], of_line[-1], True))
        for i, j, short in sorted(found):
            key = (short, *(u for _, u in lines[i : j + 1]))
            earliest.setdefault(key, (doc, i, j))
            latest[key] = doc
            runs.setdefault(doc, []).append((key, i, j))
    for doc, text in docs:
        gone = set()
        for key, i, j in runs.get(doc, ()):
            d, _, end = earliest[key]
            if (d != doc or i > end) and (not key[0] or d < latest[key]):
                gone |= set(range(i, j + 1))
        left, k = [], 0
        for line in (text or "").split("\n"):
            if not line.encode().split():
                left.append(line)
                continue
            units = units_of(line)
            stay = [u for at, u in enumerate(units, k) if at not in gone]
            k += len(units)
            left += ["".join(stay)] * bool(stay)
        kept[doc] = "\n".join(left) if text is not None else None
    return kept


def test_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    result = {r.doc_id: r for r in op2_winnowed_lines(spark, SF_DIR).collect()}
    expected = brute(docs)
    assert {i: r.text for i, r in result.items()} == expected
    assert all(r.n_lines == texts.count("\n") + 1 for texts, r in ((t, result[i]) for i, t in docs))
    assert sum(r.n_cut_words for r in result.values()) == sum(len(t.split()) - len(expected[i].split()) for i, t in docs) > 0


def test_random_lines(spark):
    rng = random.Random(3)
    pool = ["a b c", " a b c", "d", "e f", "g h i j k", "", "  ", "l m n o", "p. q r s? t", ". u v!  w x y", "p. q r s?", "u v! . é\u00a0. z."]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "long " * 40_000), (103, "long " * 40_000), (104, "a b c\n" * 300)]
    df = spark.createDataFrame([(i, t, "x", [1]) for i, t in docs], "doc_id long, text string, first string, windows array<int>")
    for least, line in ((1, None), (6, None), (9, None), (6, 2), (9, 4)):
        done = dedup_lines(df, least, line)
        assert {r.doc_id: r.text for r in done.collect()} == brute(docs, least, line)
        assert [r.windows for r in done.collect()] == [[1]] * len(docs)


def test_copies_go_and_clean_documents_stay(spark):
    passage = " ".join(f"w{i}" for i in range(55))
    rows = [(1, f"own one\n{passage}\nend one"), (2, f"own two\n{passage}\nend two"), (3, passage), (None, passage), (4, "short"), (5, "short"), (6, None)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, part int")
    kept = {r.doc_id: r.text for r in without_repeats(df).collect()}
    assert kept == {1: rows[0][1], 2: "own two\nend two", None: passage, 4: "short", 5: "short", 6: None}


def test_rows_with_one_id(spark):
    a, b = " ".join(["a"] * 40), " ".join(["b"] * 40)
    df = spark.createDataFrame([(1, a), (1, a), (1, b), (2, b)], "doc_id long, text string")
    assert sorted(r.text for r in dedup_lines(df).collect()) == sorted([a, a, b, ""])


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_short_lines_that_stand_in_several_documents(spark):
    rows = [
        (1, "one alone of five words\nx\none alone of five words"),
        (2, "these are five words here"),
        (3, "these are five words here\nfour words are few"),
        (4, "four words are few\nthese are five words here\nand this is its own end"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in dedup_lines(df).collect()}
    assert found == {1: rows[0][1], 2: rows[1][1], 3: "four words are few", 4: "four words are few\nand this is its own end"}


def test_passages_that_share_their_lines_with_other_text(spark):
    rng = random.Random(5)

    def words(n):
        return " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))

    passage = ". ".join(words(8) for _ in range(7)) + "."
    rows = [(i, f"{words(30)} {passage} {words(30)}.") for i in range(40)]
    kept = {r.doc_id: r.text for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    inner = passage.split(". ")[1:]
    assert kept[0] == rows[0][1] and all(not any(p in kept[i] for p in inner) for i in range(1, 40))
    own = [t.replace(passage, "") for _, t in rows]
    assert all(own[i].split()[:30] == kept[i].split()[:30] and own[i].split()[-30:] == kept[i].split()[-30:] for i in range(40))
