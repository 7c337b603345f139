"""The corpus pipeline: five operators of ``tripmart.llm`` in a row over ``documents``.

Each stage takes all documents that the stage before it kept, and its decisions take
effect: toxic documents go, repeated lines go, one document of each group of near
duplicates stays, sources are mixed to their target weights (so documents repeat or
go), and what is left is encoded.  All but the last return the columns of documents.
``run`` writes each stage's result as Parquet into the shared folder that the
session names in ``spark.checkpoint.dir`` and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import bpe, linededup, minhash, mixing, toxicity
from tripmart.llm.common import lean, table
from tripmart.session import scratch


#: Near duplicates share this percentage of their shingles of so many words.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    scorer = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, scorer)


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    left = linededup.without_repeats(docs)
    return left.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return minhash.keep_first(docs, NEAR_WIDTH, NEAR_PERCENT)


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return mixing.emit(docs)


def stage_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return bpe.encode(docs)


STAGES = [
    ("toxicity", stage_toxicity),
    ("line_dedup", stage_line_dedup),
    ("near_dedup", stage_near_dedup),
    ("mixing", stage_mixing),
    ("byte_bpe", stage_encoding),
]

#: Stages 1, 2 and 3 cannot be expressed in SQL; tests/llm compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(lean(spark), sf_dir, "documents")
    root = scratch(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
