"""Corpus pipeline: quality classifier, language ID, near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's result as Parquet in the shared
folder and reads it back as the next stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokscope.llm import langid, mixing, packing, quality, simhash
from tokscope.llm.common import table, written
from tokscope.session import drop_scratch, scratch_mark


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from this stage's rows and ``labels``, accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return langid.keep_identified(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies (three-word shingles, fingerprints within 2 bits)."""
    return simhash.keep_one(docs, k=3, r=2)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights."""
    return mixing.sample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("SimHash near-dedup", no_near_copies),
    ("mixing sources to target weights", mixed_sources),
    ("packing", packed),
]

#: The models, fingerprints and tokenizers of the stages have no SQL form; tests/llm hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = table(spark, sf_dir, "documents"), scratch_mark()
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
        drop_scratch(spark, since=mark, keep=1)         # the stage before, and what this one wrote on its way
    return docs
