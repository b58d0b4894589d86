"""The corpus pipeline: stages over documents, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bucketlens.llm import bpe, language_id, line_dedup, mixing, simhash
from bucketlens.llm.queries import TOKENIZER, documents
from bucketlens.session import staged


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without letters or with no clear language go."""
    return language_id.keep_identified(docs)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; ``n_chars`` follows the text."""
    rest = line_dedup.dedup_lines(docs)
    return rest.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the tokens and of the text decoded from them."""
    return bpe.bpe_query(docs, TOKENIZER)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Learnt languages, majority bits and merges have no SQL form: compared with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
