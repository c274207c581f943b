"""A corpus pipeline over ``documents``: language, near duplicates, benchmark passages, personal data, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metaskein.llm import stages
from metaskein.llm.runtime import stored

STAGES = [
    ("language", stages.keep_identified),
    ("near_duplicates", stages.keep_first_of_each_group),
    ("decontamination", stages.drop_contaminated),
    ("personal_data", stages.replace_personal_data),
    ("tokens", stages.tokenize),
]

#: SQL cannot express the language, personal-data and token stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each one's rows are written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
