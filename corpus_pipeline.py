"""A corpus pipeline of five stages: language ID, near-dedup, decontamination, mixing and sharding.

Each stage takes what the one before kept, as (spark, docs, sf_dir), and all but the last return the columns of
`documents`. `run` writes every stage's rows to the shared folder and reads them again, so a lost executor costs no
more than the stage it was in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.llm import decontaminate, langid, minhash, mixing, sharding
from paceline.llm.shared import table, written

SHARDS = 40


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language the centroids reject; the centroids learn from this stage's own input.

    Without any label there is nothing to compare with, and all stay.
    """
    return langid.identified(docs, langid.fit(docs, langid.remainder() != 1))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group; rows of one id are one document, and rows without an id stay."""
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source's weight of the token budget; a row that is taken in several epochs is repeated."""
    return mixing.mixed_rows(docs).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with their shard and their slot in it."""
    return sharding.deal(docs, SHARDS)


STAGES = [
    ("language ID", language_id),
    ("near-dedup", near_dedup),
    ("decontamination", benchmark_decontamination),
    ("mixing", source_mixing),
    ("sharding", shard),
]

#: Clustering and the bisected mixture have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
