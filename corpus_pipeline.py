"""A training corpus from documents: without toxic documents, near copies, benchmark passages and
secrets, packed into sequences.

Each stage takes the documents that the one before kept. A stage's rows are written to the shared
folder and read again, so a lost executor costs work of one stage only. Defined results for nulls,
empty texts, repeated rows and empty tables are those of the operators, in their docstrings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from entigrid.llm import decontaminate, jaccard_join, packing, secret_scan, toxicity
from entigrid.llm.common import prepare, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the rejecting one."""
    prepare(spark)
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the least doc_id."""
    prepare(spark)
    return jaccard_join.one_of_each(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark windows; documents that are mostly benchmark go."""
    prepare(spark)
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced; no document goes."""
    prepare(spark)
    return secret_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences, and their ids."""
    prepare(spark)
    return packing.packed(packing.pieces(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("secrets", redact_secrets),
    ("packing", pack),
]

# Neither the scores nor the packing can be put in SQL; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
