"""From raw documents to packed windows: rules, repeated lines, near copies, mixture, packing.

Each stage is a function of (spark, docs, sf_dir); its rows are written and read again as the next one's docs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rimline.llm import lines, mixing, near, packing, quality
from rimline.llm.common import shared_folder, table

#: Target shares of the mixture. Poor texts that the rules let pass can't be told from clean ones by their words, so no rates
#: could meet a target for them but by giving up clean documents.
MIXTURE = {"clean": 0.985, "toxic": 0.015}
#: Words that a packing worker remembers: fewer than alone, as the stages before have filled the executors' heaps.
REMEMBERED = 60_000
#: Text whose words it looks up together, less for the same reason.
GROUP_BYTES = 1 << 21


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the decision list learned from the labels keeps."""
    return quality.only_kept(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines deleted; documents of nothing else go."""
    return lines.without_repeats(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the fitted rates say."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"), MIXTURE)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in full windows, with their token ids."""
    return packing.pack(docs, remembered=REMEMBERED, group_bytes=GROUP_BYTES, forget=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("packing", packing_stage),
]

#: Learned rules, components of a similarity graph and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents; what each returns is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
