"""Spans against the plain patterns and checks in Python."""

import hashlib
import random
import re

from rimline.llm.common import table
from rimline.llm.pii import op5_personal_data, personal_data

SF_DIR = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    kinds = list(PATTERNS)
    spans = [(m.start(), kinds.index(k), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]
    return [f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(spans)]


def base(spans):
    return [f"{s.kind}:{s.start}:{s.end}" for s in spans if s.kind in PATTERNS]


def test_query_on_given_documents(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()}
    result = op5_personal_data(spark, SF_DIR)
    assert not any(word in result._jdf.queryExecution().executedPlan().toString() for word in ("Python", "Arrow", "Exchange"))
    some = 0
    for r in result.collect():
        spans = brute(texts[r.doc_id])
        some += len(spans)
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("iban")] == spans
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in spans) for k in PATTERNS]
    assert some > 50


def test_random_texts(spark):
    rng = random.Random(6)
    signs = ["a", "b.c", "@", ".", "..", "-", "%", "+", "1", "25", "300", " ", "(", ")", "é", "😀", "_", "x@y.z", "1.2.3.4", "0001.2.3.0255", "4111 1111 1111 1111", "+1 (555) 123-4567", "\n", "  "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 25))) for _ in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in personal_data(docs).collect():
        assert base(r.spans) == brute(texts[r.doc_id]), repr(texts[r.doc_id])


def test_long_runs_end(spark):
    texts = ["a" * 200_000, "1" * 200_000, "1 " * 100_000, "a@" + "b." * 100_000, "+1" + " " * 100_000, "a." * 100_000 + "@b.c", "1." * 100_000, "a@b.c " * 2000, "A" * 100_000, "DE89" * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: base(r.spans) for r in personal_data(docs).collect()}
    assert found[3] == [f"email:0:{len(texts[3]) - 1}"]
    assert found[5] == [f"email:0:{len(texts[5])}"]
    assert found[7] == brute(texts[7])
    assert found[6] == brute(texts[6])
    assert found[2] == brute(texts[2])


def test_accounts_and_scores(spark):
    rows = [(1, "My bank account: DE89 3704 0044 0532 0130 00."), (2, "DE89370400440532013001"), (3, "serial GB82WEST12345698765432"), (4, "call me at +1 555 123 4567"), (5, "+1 555 123 4567 is the sum total")]
    found = {r.doc_id: {s.kind: s.score for s in r.spans} for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found[1]) == {"iban"} and "iban" not in found[2] and "iban" not in found[3]
    assert found[4]["phone"] > 0.7 > found[5]["phone"]


def test_accounts_end_where_their_country_says(spark):
    texts = ["DE89370400440532013000 BIC COBADEFFXXX", "GB82 WEST 1234 5698 7654 32 USD 500", "DE89370400440532013000 2024", "NO93 8601 1117 947", "DE893704004405320130001", "XX89370400440532013000", "DE89 3704 0044 0532 0130 01 and GB82WEST12345698765432"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == "iban"] for r in personal_data(docs).collect()}
    assert found == {0: [texts[0][:22]], 1: [texts[1][:27]], 2: [texts[2][:22]], 3: [texts[3]], 4: [], 5: [], 6: ["GB82WEST12345698765432"]}


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (None, "x@y.zz", "c")], "doc_id long, text string, spans string")
    assert sorted(len(r.spans) for r in personal_data(docs).collect()) == [0, 0, 1]
    assert personal_data(docs.limit(0)).count() == 0
