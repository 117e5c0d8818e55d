"""Corpus pipeline: quality, exact copies, near copies, source mix, BPE.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` writes each stage's result as Parquet and rereads
it as the next one's documents. All stages but the last return the columns of
``documents``; the last returns the token ids and the text they decode to.

Empty tables pass through every stage; nulls in any column, repeated rows and
extra columns are handled as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from apiary.llm import bpe, exact_dedup, jaccard_join, mixing, quality
from apiary.llm.common import stage, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact_dedup.keep_one(docs, keep="largest")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, similarity 0.8 or more) the row with the smallest id."""
    return jaccard_join.keep_one(docs, shingle=5, num=4, den=5)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to target weights; one row per document and turn it is taken in."""
    return mixing.mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and the text they decode to."""
    return bpe.round_trip(docs, bpe.default_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing sources", mix_stage),
    ("BPE", bpe_stage),
]

# No stage but exact dedup has an SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
