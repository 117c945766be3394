"""The corpus pipeline: documents are filtered, deduplicated, masked, mixed and encoded.

Every stage works on all that its predecessor kept and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import stages
from tillstar.llm.common import table
from tillstar.session import stored

STAGES = [
    ("quality", stages.quality),
    ("deduplicate", stages.deduplicate),
    ("mask_personal_data", stages.mask_personal_data),
    ("mix_sources", stages.mix_sources),
    ("encode", stages.encode),
]

#: Models and encodings cannot be written in SQL; tests compare stages with plain versions or with their operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
