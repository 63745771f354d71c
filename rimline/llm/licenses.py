"""License scan by a positional index of rare template words.

1. Document frequencies of all template words are counted over all documents.
2. A file's licence words are ranked by inverse document frequency; for every template the rarest few that
   the file has are looked up. Each place of such a word in the file, less its place in the template, votes
   for an offset at which the template would begin.
3. Where rare words agree on an offset, up to small shifts by added or dropped words, the template's
   mandatory key phrases must stand in the file near their places. The score is the share of the template's
   words found in order of place about that offset.

The base phrases are found at every place, whatever the templates say.

Defined cases: a null or empty text has no words and no labels (empty strings), and a score of 0; rows with
null or repeated ids are scanned like any other; an empty table gives no rows; other columns are
never read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimline.llm.common import slices, table, utf8

# Base phrases and their labels.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Label: opening words of the licence or of its notice, and phrases that must stand in it.
TEMPLATES = {
    "agpl-3.0": (
        "gnu affero general public license as published by the free software foundation either version 3 of the license or",
        ("affero general public license",),
    ),
    "apache-2.0": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        ("apache license version 2 0",),
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ("source and binary forms", "with or without modification"),
    ),
    "cc-by": (
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution",),
    ),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    "cc-by-4.0": ("licensed under cc by 4 0", ("cc by 4 0",)),
    "gpl-2.0": (
        "this work is licensed under the gnu general public license version 2",
        ("general public license version 2",),
    ),
    "gpl-3.0": (
        "this work is licensed under the gnu general public license version 3",
        ("general public license version 3",),
    ),
    "gpl-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation",
        ("gnu general public license", "free software foundation"),
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("use copy modify and or distribute this software",),
    ),
    "lgpl": (
        "under the terms of the gnu lesser general public license as published by the free software foundation",
        ("lesser general public license",),
    ),
    "mit-notice": ("released under the mit license", ("under the mit license",)),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    "mpl-2.0": (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license v 2 0",),
    ),
    "unlicense": (
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
}

#: Rarest template words of a file that are looked up for a template.
RAREST = 4
#: Words by which an offset may shift within a template.
SLACK = 2
#: Share of a template's words that must be found.
LEAST_SCORE = 0.7
#: What a base phrase alone is worth.
PHRASE_SCORE = 0.5

#: Bytes outside words to spaces, A-Z to a-z: bytes above 127 are always parts of words.
FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Index:
    """Template words with their places in templates."""

    def __init__(self, templates: dict[str, tuple] = TEMPLATES, base: dict[str, str] = BASE):
        self.words = {label: text.encode().split() for label, (text, _) in templates.items()}
        self.keys = {label: [p.encode().split() for p in phrases] for label, (_, phrases) in templates.items()}
        self.base = [(p.encode().split(), label) for p, label in base.items()]
        self.postings: dict[bytes, dict[str, list[int]]] = defaultdict(lambda: defaultdict(list))
        for label, words in self.words.items():
            for place, word in enumerate(words):
                self.postings[word][label].append(place)
        self.vocabulary = frozenset(self.postings) | {w for p, _ in self.base for w in p}

    def places(self, words: list[bytes]) -> dict[bytes, list[int]]:
        found: dict[bytes, list[int]] = defaultdict(list)
        known = self.vocabulary
        for place, word in enumerate(words):
            if word in known:
                found[word].append(place)
        return found


def _phrase_places(phrase: list[bytes], places: dict[bytes, set[int]]) -> list[int]:
    """Where the phrase's words stand one after the other."""
    none: set[int] = set()
    found = places.get(phrase[0], none)
    for i, word in enumerate(phrase[1:], 1):
        found = found & {p - i for p in places.get(word, none)}
    return sorted(found)


def _template_places(index: Index, label: str, listed: dict[bytes, list[int]], places: dict[bytes, set[int]], idf: dict[bytes, float]) -> list[tuple[int, float]]:
    """(first word, score) of the template wherever it stands in the file."""
    words = index.words[label]
    keys = [_phrase_places(key, places) for key in index.keys[label]]
    if not all(keys):
        return []
    held = sorted({w for w in words if w in listed}, key=lambda w: (-idf.get(w, 0.0), w))[:RAREST]
    votes: dict[int, set[bytes]] = defaultdict(set)
    for word in held:
        for place in index.postings[word][label]:
            for at in listed[word]:
                votes[at - place].add(word)
    need = min(2, len(held))
    found, taken = [], None
    for offset in sorted(votes):
        agreeing = set().union(*(votes.get(offset + s, ()) for s in range(SLACK + 1)))
        if len(agreeing) < need or taken is not None and offset <= taken:
            continue
        near = lambda p: any(p + offset + s in places.get(words[p], ()) for s in range(-SLACK, SLACK + 1))
        score = sum(near(p) for p in range(len(words))) / len(words)
        last = offset + len(words) + SLACK
        if score >= LEAST_SCORE and all(any(offset - SLACK <= p <= last for p in key) for key in keys):
            found.append((max(offset, 0), score))
            taken = offset + len(words) - 1
    return found


def scan(text: bytes, index: Index, idf: dict[bytes, float]) -> tuple:
    words = words_of(text)
    listed = index.places(words)
    places = {word: set(at) for word, at in listed.items()}
    base = [(at, len(phrase), label) for phrase, label in index.base for at in _phrase_places(phrase, places)]
    spans = [(at, at + len(index.words[label]), label, score) for label in index.words for at, score in _template_places(index, label, listed, places, idf)]
    starts = [at for at, _, _ in base]
    base_labels = {label for _, _, label in base}
    return (
        len(words),
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base_labels)),
        ",".join(sorted(base_labels | {label for _, _, label, _ in spans})),
        max([score for *_, score in spans] + [PHRASE_SCORE] * bool(base), default=0.0),
        ",".join(f"{label}:{first}:{last}" for first, last, label, _ in sorted(spans)),
    )


def word_frequencies(docs: DataFrame, index: Index) -> tuple[int, dict[bytes, int]]:
    """The number of documents, and for each template word of those that have it. Counted over all documents."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[bytes, int] = defaultdict(int)
        for rows in slices(batches):
            for text in rows["text"]:
                totals[b""] += 1
                for word in index.vocabulary.intersection(words_of(text)):
                    totals[word] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.binary()), pa.array(list(totals.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(utf8().alias("text")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {bytes(r["word"]): r["n"] for r in rows}  # At most one row per template word.
    return found.pop(b"", 0), found


SCANNED = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"


def scan_licenses(docs: DataFrame, templates: dict[str, tuple] = TEMPLATES) -> DataFrame:
    """One row per document: base phrases, labels, score, and the templates' spans (words, end exclusive)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    plain = Index(templates)
    total, frequency = word_frequencies(docs, plain)
    idf = {word: math.log((1 + total) / (1 + frequency.get(word, 0))) for word in plain.vocabulary}
    schema = to_arrow_schema(StructType.fromDDL(SCANNED))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for rows in slices(batches):
            columns = list(zip(*((i, *scan(t, index, idf)) for i, t in zip(rows["doc_id"], rows["text"])))) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text")).mapInArrow(run, SCANNED)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
