"""A training-corpus pipeline: each stage works on what the one before kept.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and
returns the documents that go on, with the columns of ``documents``; the last
returns the packed sequences.  Every result is written as Parquet and read back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm import minhash, mixing, packing, quality, toxicity
from freightlens.llm.catalog import END_ID, TOKENIZER
from freightlens.llm.common import Scratch, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic (0.5 or more) go."""
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic").where(~toxicity.in_fold(F.col("doc_id")))
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.where("toxic_score < 0.5").select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or their group's thresholds go."""
    return quality.judge(docs, Scratch(spark, "quality")).where("quality_kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in random order."""
    return mixing.replicate(docs, mixing.WEIGHTS, Scratch(spark, "mixing")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES = [("toxicity", drop_toxic), ("quality_rules", quality_rules), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs


# Token ids and the learned scores are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None
