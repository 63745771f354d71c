"""Every id in one piece, windows gapless and full, ids as the tokenizer's own."""

import random
import zlib
from array import array
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

from rimline.llm.common import table
from rimline.llm.packing import TIERS, WordIds, grouped, op9_hierarchical_packing, pack

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def own_ids(text):
    return array("I", Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2])


def windows(pieces):
    found = defaultdict(list)
    for p in pieces:
        found[p.sequence_id].append(p)
    for parts in found.values():
        parts.sort(key=lambda p: p.offset)
        at = 0
        for p in parts:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 4096
    return {s: sum(p.length for p in parts) for s, parts in found.items()}


def test_query_on_given_documents(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()}
    pieces = op9_hierarchical_packing(spark, SF_DIR).collect()
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    assert set(by_doc) == set(texts)
    tokenizer = Tokenizer.from_file(PATH)
    for doc, parts in by_doc.items():
        ids = array("I", tokenizer.encode(texts[doc], add_special_tokens=False).ids + [2])
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    sizes = windows(pieces)
    assert sum(size not in TIERS for size in sizes.values()) <= 8
    padding = sum(4096 - size for size in sizes.values() if size & (size - 1))
    assert padding <= 4096


def test_words_have_the_ids_they_have_in_texts(spark):
    rng = random.Random(8)
    signs = ["a", "B", "é", "é", "́", "Σ", "ς", "İ", "'s", "'LL", "12", "½", "!?", " ", " ", "\x1c", "\x85", "　", "日本", "한", "하", "<|endoftext|>", "<|", "🙂", "‍", "ﬁ", " ", "\n", "\t", "\x0b", "\r\n"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 60))) for _ in range(800)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = defaultdict(dict)
    for p in pack(docs).collect():
        found[p.doc_id][p.start] = bytes(p.ids)
    tokenizer = Tokenizer.from_file(PATH)
    for i, text in enumerate(texts):
        assert b"".join(found[i][s] for s in sorted(found[i])) == array("I", tokenizer.encode(text, add_special_tokens=False).ids + [2]).tobytes(), repr(text)


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "three words here", 3), (4, "w " * 9000, 4), (4, "w " * 9000, 4), (5, "x" * 50_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    pieces = pack(docs).collect()
    windows(pieces)
    assert sum(p.length for p in pieces) == sum(len(own_ids(t)) for _, t, _ in rows)
    assert [(p.length, p.doc_tokens) for p in pieces if p.doc_id in (1, 2)] == [(1, 1), (1, 1)]
    assert pack(docs.limit(0)).count() == 0


def test_step_groups_hold_equal_tokens(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 700)) for i in range(400)], "doc_id long, text string").coalesce(1)
    tokens = defaultdict(int)
    for p in pack(docs, tokens_per_step=8192).collect():
        tokens[p.tier, p.step_group] += p.length
    by_tier = defaultdict(list)
    for (tier, group), held in sorted(tokens.items()):
        by_tier[tier].append(held)
    assert all(held == 8192 for groups in by_tier.values() for held in groups[:-1])


def test_a_word_is_looked_up_once_for_all_texts():
    words, asked = WordIds(PATH), []

    class Asked(type(words.words)):
        def __contains__(self, word):
            asked.append(word)
            return super().__contains__(word)

    words.words = Asked(10)
    texts = ["one two, one\t", "", " two, three", "one " * 50, "\n"]
    assert words.of([t.encode() for t in texts]) == [own_ids(t)[:-1].tobytes() for t in texts]
    assert sorted(w for w in asked if w) == [b"one", b"three", b"two,"]


def test_texts_of_some_bytes_are_looked_up_together():
    slices = [{"text": [b"abc"] * n} for n in (1, 2, 3, 1)]
    assert list(grouped(slices, 9)) == [slices[:2], slices[2:3], slices[3:]]
