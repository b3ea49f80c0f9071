"""Corpus pipeline: quality filter, near-duplicate removal, benchmark decontamination, source mixing, sharding.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return the columns of ``docs``; the last adds
``size``, ``text_crc32``, ``shard`` and ``slot``. ``run`` applies them to the ``documents`` table of ``sf_dir``.

Each stage works on every row that its predecessor kept: the classifier is fitted on labelled rows among its input,
near duplicates are five-word shingle sets of similarity 0.8 or more, and targets and shards follow from the rows that
arrive there. An empty input gives an empty output of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickscope.llm import decontaminate, kd_shards, mixing, near_dups, quality
from clickscope.llm.common import shared_folder

QUALITY_THRESHOLD = 0.7
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80
EDIT_RATE = 0.1
SHARDS = 8


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts; all if there are no labels to fit it on."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model, QUALITY_THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return near_dups.deduplicated(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item, also allowing for edits."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), EDIT_RATE)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares; a document comes once, twice or not at all."""
    return mixing.mixed_rows(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return kd_shards.kd_shards(docs, leaves=SHARDS)


STAGES = [("quality classifier", quality_filter), ("MinHash near-dedup", near_dedup),
          ("benchmark decontamination", benchmark_decontamination),
          ("mixing sources to target weights", source_mixing), ("sharding", sharding)]

ORACLE_SQL = None  # compression and edit distance have no SQL; tests/llm checks each stage by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        folder = shared_folder(spark, "corpus-pipeline")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(folder)
        docs = spark.read.schema(out.schema).parquet(folder)
    return docs
