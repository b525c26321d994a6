"""A training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import decontaminate, pii, quality, simhash, transducer
from kestrel.llm.common import stored
from kestrel.sources.tables import load


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes frequent lines, and the documents that fail the base rules or
    have too little left (operator 1)."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (operator 5)."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark passages go (operator 2)."""
    return decontaminate.remove(docs, load(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by a mark of its kind (operator 9)."""
    return pii.redact(docs, pii.train(docs))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' piece ids, and whether they decode to the text (operator 7)."""
    return transducer.encode(docs, ["doc_id", "lang", "source", "n_chars"])


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates),
          ("decontamination", decontamination), ("personal data", personal_data),
          ("sentencepiece", sentencepiece)]

#: SQL can express neither the random field nor the shortest paths.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
