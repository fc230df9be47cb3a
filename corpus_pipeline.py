"""Training-corpus pipeline: toxicity, near duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All stages but
the last return rows of documents as they came, all columns kept:

* toxicity drops the documents that the ordinal model rejects;
* near_duplicates keeps of each component the document with the smallest id;
* decontamination drops the documents that hold a window of the benchmark;
* packing returns the pieces of the documents in sequences of 2048 tokens.

Defined results: null texts have no words and stay in every filter; rows with
a null id are never duplicates of others; of repeated rows with one id and
text, one stays; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martspark.llm import decontaminate, ngram_join, packing, toxicity
from martspark.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), threshold=0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pieces(docs, packing.tokenizer_path(), length=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The fitted model and free cuts of sequences have no SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
