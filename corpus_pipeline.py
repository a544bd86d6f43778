"""A corpus pipeline of the operators in gridloom.llm: toxicity, near duplicates, benchmark decontamination, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontamination, lsh_forest, packing, pii, toxicity
from gridloom.llm.common import release, stage, staged, table
from gridloom.llm.queries import tokenizer_path

#: Documents that score this much or more go.
TOXIC_AT = 0.7


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go. The labels of crc32(doc_id as text) mod 3 = 1 stay out of the fit, as in the operator's query."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.TRAIN)
    return toxicity.civil(docs, model, TOXIC_AT)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the least doc_id."""
    return lsh_forest.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences, with their tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", civil), ("near_duplicates", distinct), ("decontamination", uncontaminated), ("pii", private), ("packing", packed)]
#: No SQL expresses the learned model, the forest or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each stage's result is written to the shared folder and read again, and what it was made of is deleted."""
    docs = table(spark, sf_dir, "documents")
    first = staged()
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
        release(first, staged() - 1)
    return STAGES[-1][1](spark, docs, sf_dir)
