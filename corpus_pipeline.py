"""The corpus pipeline: five stages, each written as Parquet and read again for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm import stages, store

STAGES = [
    ("quality_classifier", stages.quality_classifier),
    ("quality_rules", stages.quality_rules),
    ("line_dedup", stages.line_dedup),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("packing", stages.packing),
]

#: A trained network, fingerprints and a dynamic programme have no SQL; tests compare them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what a stage wrote besides its result goes once that is written."""
    docs, start = spark.read.parquet(f"{sf_dir}/documents.parquet"), store.mark()
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        path = store.write_shared(result, f"pipeline-{name}")
        docs = spark.read.schema(result.schema).parquet(path)
        store.discard(spark, start, keep=path)
    return docs
