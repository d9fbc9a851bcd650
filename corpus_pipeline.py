"""From raw documents to token ids: language ID, line dedup, near-dedup, mixing, BPE.

Each stage takes what its predecessor kept and returns the columns of
``documents``; the last returns ``doc_id``, ``n_tokens``, the digests of the ids and of
the decoded bytes, ``source`` and ``lang`` for each copy of a document in the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seisloom.llm import bpe, language, line_dedup, mixing, simhash
from seisloom.llm.common import fresh_path, read

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs).select(*COLUMNS)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of a page count once here: removing them is the next stage's work."""
    out = line_dedup.drop_boilerplate(docs, distinct_pages=True)
    chars = F.when(F.col("lines_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words a shingle; 14 differing bits of 64 hold nearly all pairs of a similarity of 0.8 or more."""
    return simhash.keep_one(docs, width=5, distance=14, by_words=True).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take_documents(mixing.mix_sources(docs)).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, carry=("source", "lang"))


STAGES = [
    ("language", known_language),
    ("line_dedup", without_boilerplate),
    ("simhash", without_near_copies),
    ("mixing", mixed),
    ("bpe", tokens),
]
#: Language ID, SimHash and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
