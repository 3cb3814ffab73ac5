"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept;
its result is written as Parquet and read again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``.

1. toxicity            documents that score as toxic go
2. quality classifier  documents above their language's perplexity threshold go
3. n-gram Jaccard join one document of each group of near copies stays
4. PII                 personal data in the texts is replaced by [KIND]
5. packing             the texts' tokens are packed into sequences
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.llm.common import table
from clinloom.llm.ngram_join import one_of_each
from clinloom.llm.packing import pack
from clinloom.llm.personal_data import mask
from clinloom.llm.quality import keep_good
from clinloom.llm.toxicity import drop_toxic, train
from clinloom.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels"), F.lit(True)))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("PII", pii),
    ("packing", packing),
]

# Trained models, language-model scores and tokenizers are beyond SQL; tests/llm holds
# the pipeline against its stages' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
