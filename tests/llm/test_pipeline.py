"""The pipeline's stages, each against a plain version of it on what the stage before returned."""

from array import array
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from rimline.llm.common import table
from test_lines import brute as plain_lines
from test_near import brute as plain_near
from test_quality import brute as plain_counts

SF_DIR = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_each_stage_on_given_documents(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    columns, kept = docs.columns, {None: texts(docs)}
    before = None
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            break
        assert docs.columns == columns
        kept[name] = texts(docs)
        before = kept[before] if name == "quality_rules" else before
        if name == "quality_rules":
            known = dict(before)
            assert set(kept[name]) <= set(before)
            failed = {i for i, t in known.items() for n, _, _, _, r in [plain_counts(t)] if n < 10 or 100 * r > 20 * n}
            assert not failed & {i for i, _ in kept[name]}
            good = {r.doc_id for r in table(spark, SF_DIR, "labels").where("quality = 1").collect()} - failed
            assert len(good & {i for i, _ in kept[name]}) >= 0.95 * len(good)
        elif name == "line_dedup":
            plain = plain_lines(kept["quality_rules"])
            assert sorted(kept[name]) == sorted((i, t) for i, t in plain.items() if t.strip())
        elif name == "near_copies":
            assert sorted(i for i, _ in kept[name]) == sorted(i for i, _, _, c, _ in plain_near(kept["line_dedup"]) if c == i)
        elif name == "mixture":
            assert set(kept[name]) <= set(kept["near_copies"])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter()
    for i, t in kept["mixture"]:
        wanted[i] += len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
    found = Counter()
    for p in docs.collect():
        found[p.doc_id] += p.length
        assert len(p.ids) == 4 * p.length and array("I", bytes(p.ids))
    assert found == wanted


def test_workers_remember_no_words_after_packing(spark):
    path, size = public_tokenizers.path("word_bpe_49k.json"), corpus_pipeline.REMEMBERED

    def remembered(batches):
        import pyarrow as pa
        from rimline.llm.packing import word_ids

        for batch in batches:
            known = word_ids(path, size)
            held = sum(len(words) + len(words.older) for words in (known.words, known.parts))
            yield pa.RecordBatch.from_arrays([pa.array([held] * batch.num_rows, pa.int64())], names=["held"])

    docs = spark.createDataFrame([(i, f"some words of text{i}") for i in range(400)], "doc_id long, text string").repartition(8)
    assert corpus_pipeline.packing_stage(spark, docs, SF_DIR).count() > 0
    found = spark.range(0, 8, 1, 8).mapInArrow(remembered, "held long").collect()
    assert len(found) == 8 and {r.held for r in found} == {0}


def test_run_on_odd_rows(spark, tmp_path):
    words = " ".join(f"word{i}" for i in range(80))
    rows = [(1, words), (2, words), (3, words + " and an end"), (None, words[:300]), (4, None), (5, ""), (6, "few"), (7, " ".join(f"other{i}" for i in range(40)))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string"
    spark.createDataFrame([(i, t, None, None, None, "x") for i, t in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == {1, None, 7}


def test_run_on_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


HELPERS = (
    "row", "id", "part", "ranges", "known", "copies", "n", "size", "head", "node", "bytes", "kept", "text_", "_id", "_bytes", "_kept", "_base_failed", "_n_words", "_word_chars",
    "_n_lines", "_n_cut_lines", "_n_cut_words", "_cut_id", "_cut_part", "_cut_ranges", "_mix_id", "_mix_copies", "_mix_again", "_near_id", "_quality", "a b", "a.b", "a`b",
)


def test_columns_of_any_name_come_through_unchanged(spark, tmp_path):
    words = [" ".join(f"{w}{i}" for i in range(60)) for w in ("alpha", "beta", "gamma")]
    base = [(1, words[0]), (2, words[0] + " end"), (3, words[1] + "\n" + words[2]), (4, "own words here\n" * 12 + words[2]), (None, words[1][:150]), (5, None)]
    extra = ", ".join(f"`{name.replace('`', '``')}` string" for name in HELPERS)
    rows = [(i, t, "en", *(f"{name}-{k}" for name in HELPERS)) for k, (i, t) in enumerate(base)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, {extra}")
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    whole = {r[3:] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        found = out.collect()
        assert found and {r[3:] for r in found} <= whole, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0
