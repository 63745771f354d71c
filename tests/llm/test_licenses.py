"""Base phrases against a plain search; templates against planted notices."""

import re

from rimline.llm.common import table
from rimline.llm.licenses import BASE, TEMPLATES, op4_license_scan, scan_licenses

SF_DIR = "/root/testdata/sf0.01"


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = []
    for phrase, label in BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_query_on_given_documents(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()}
    found = op4_license_scan(spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
        assert ("cc-by-nc-4.0" in r.labels) == ("CC BY-NC 4.0" in texts[r.doc_id])
        assert ("mit-notice" in r.labels) == ("under the MIT License" in texts[r.doc_id])


def test_planted_templates(spark):
    filler = " ".join(f"filler{i}" for i in range(300))
    rows = []
    for n, (label, (text, keys)) in enumerate(TEMPLATES.items()):
        rows.append((n, f"{filler} {text.upper()} {filler}", label, 1.0))
        words, held = text.split(), " ".join(keys).split()
        free = [i for i, word in enumerate(words) if word not in held]
        if len(free) > 4:  # A word outside the key phrases dropped, one added before another such word.
            changed = words[: free[0]] + words[free[0] + 1 : free[-1]] + ["indeed"] + words[free[-1] :]
            rows.append((100 + n, " ".join([filler, *changed, filler]), label, 0.8))
    rows.append((500, filler + " permission granted free software license copy", "", 0.0))
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    found = {r.doc_id: r for r in scan_licenses(docs).collect()}
    for i, _, label, least in rows:
        if label:
            assert label in found[i].labels.split(","), (label, found[i])
            assert found[i].score >= least
        else:
            assert found[i].labels == "" and found[i].score == 0


def test_two_notices_in_one_text(spark):
    text = "Released under the MIT License.\n" + "word " * 500 + "Licensed under CC BY-NC 4.0.\n" + "Released under the MIT License."
    r = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.labels == "cc-by-nc-4.0,mit,mit-notice"
    assert r.n_base == 2 and r.spans.count("mit-notice") == 2


def test_odd_rows(spark):
    rows = [(1, None, "a"), (1, "", "b"), (None, "MIT-License", "c"), (2, "mit " * 40_000 + "license", "d"), (3, "the apachë license", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    found = sorted((r.n_words, r.n_base, r.labels) for r in scan_licenses(docs).collect())
    assert found == [(0, 0, ""), (0, 0, ""), (2, 1, "mit"), (3, 0, ""), (40_001, 1, "mit")]
    assert scan_licenses(docs.limit(0)).count() == 0
