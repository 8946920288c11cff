"""The corpus pipeline: stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import table, written
from tickloom.llm.exact_dedup import dedup_stage
from tickloom.llm.mixing import mixing_stage
from tickloom.llm.packing import packing_stage
from tickloom.llm.quality import quality_stage
from tickloom.llm.simhash import simhash_stage

STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("source_mixing", mixing_stage),
    ("mixture_packing", packing_stage),
]

#: SQL can express neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
