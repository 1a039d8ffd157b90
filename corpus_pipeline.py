"""A corpus from raw documents: language, near-duplicates, personal data, mixture, tokens.

Each stage is written as Parquet and read again before the next one runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelsift.llm import op1_mixing, op2_pii, op4_pieces, op5_minhash, op9_language
from reelsift.llm.common import Scratch, read_table

STAGES = [
    ("language_id", op9_language.stage),
    ("minhash_near_dedup", op5_minhash.stage),
    ("pii", op2_pii.stage),
    ("mixing", op1_mixing.stage),
    ("sentencepiece", op4_pieces.stage),
]

#: Language models, sketches and merges aren't SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
