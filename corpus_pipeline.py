"""Cleaning pipeline over `documents`: every stage's output is written as Parquet and read again by the next one.

Stages take (spark, docs, sf_dir) and, but for the last, return the columns of
documents; a missing doc_id or text is handled as the operators' docstrings say.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm.dartmin import stage_near_dedup
from linkloom.llm.decontam import stage_decontaminate
from linkloom.llm.mixing import stage_mix
from linkloom.llm.substring import stage_substring_dedup
from linkloom.llm.toxicity import stage_toxicity

STAGES = [
    ("toxicity", stage_toxicity),
    ("near_dedup", stage_near_dedup),
    ("substring_dedup", stage_substring_dedup),
    ("decontamination", stage_decontaminate),
    ("source_mix", stage_mix),
]

#: The learned and hashed decisions have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def _folder(spark: SparkSession) -> str:
    """A fresh folder for the intermediate tables: in the shared folder of the cluster, or a local one where it names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return f"{shared.rstrip('/')}/pipeline-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="pipeline-")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = _folder(spark)
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
