"""A training corpus from documents: each stage works on what the one before
it kept, as a Parquet table in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm import decontaminate, line_dedup, packing, simhash_dedup, toxicity_zstd
from voxloom.llm.common import materialize

STAGES = [
    ("toxicity", toxicity_zstd.stage),
    ("line_dedup", line_dedup.stage),
    ("simhash_dedup", simhash_dedup.stage),
    ("decontaminate", decontaminate.stage),
    ("packing", packing.stage),
]

ORACLE_SQL = None  # dictionaries, fingerprints and tokenizers have no SQL form; tests compare each stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
