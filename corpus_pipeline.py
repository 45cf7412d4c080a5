"""A training corpus from raw documents, in stages.

Each stage gets what the one before it kept, written as Parquet in the shared folder, and works on
all of it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lakewright.llm import contamination, language, lines, neardup, pieces
from lakewright.session import shared_folder

STAGES = [
    ("language_id", language.stage),
    ("line_dedup", lines.stage),
    ("near_dedup", neardup.stage),
    ("decontamination", contamination.stage),
    ("sentencepiece", pieces.stage),
]

#: Language ID and piece encoding have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the documents that all stages keep."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{n}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
