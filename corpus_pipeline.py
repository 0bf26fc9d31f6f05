"""A training corpus from the documents: quality rules, near duplicates, source mix, encoding.

Each stage takes all rows that its predecessor kept, written as Parquet and
read again; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirescope.llm import mixing, ngram_join, quality, sp_codec
from hirescope.llm.common import read, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and their group's adaptive thresholds."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 5-word shingle sets linked at Jaccard 0.75."""
    return ngram_join.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, a document that is taken twice as two rows."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked to decode to its text; copies of one are segmented anew."""
    return sp_codec.encoded_documents(docs, copies=True)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("source_mix", source_mix), ("encode", encode)]

#: SentencePiece encoding has no SQL form; tests hold the rows against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    name, last = STAGES[-1]
    return stored(last(spark, docs, sf_dir), f"pipeline-{name}")
