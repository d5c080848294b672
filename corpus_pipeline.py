"""The corpus pipeline: documents to training sequences.

Each stage is called with what its predecessor kept, written as Parquet and
read again.  SQL can express none of the models and matching structures, so
there is no oracle; the tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearth.llm import packing, simhash, suffix_dedup, toxicity
from hearth.llm._common import written

STAGES = [
    ("toxicity", toxicity.clean_documents),
    ("simhash_near_dedup", simhash.one_of_each_group),
    ("suffix_array_dedup", suffix_dedup.without_repeats),
    ("packing", packing.packed_documents),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
