"""One query per corpus operator over its whole table, and SQL where it can say it."""

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from bucketlens.llm import (
    bpe,
    embedding_dedup,
    fim,
    html_extract,
    language_id,
    line_dedup,
    mixing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_query(documents(spark, sf_dir))


def op2_quality_classifier(spark, sf_dir):
    return quality_classifier.quality_query(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup_query(documents(spark, sf_dir))


def op4_sharding(spark, sf_dir):
    return sharding.shard_documents(documents(spark, sf_dir))


def op5_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules_query(documents(spark, sf_dir))


def op7_language_id(spark, sf_dir):
    return language_id.language_query(documents(spark, sf_dir))


def op8_simhash(spark, sf_dir):
    return simhash.simhash_query(documents(spark, sf_dir))


def op9_mixing(spark, sf_dir):
    return mixing.mix_query(documents(spark, sf_dir))


def op10_bpe(spark, sf_dir):
    return bpe.bpe_query(documents(spark, sf_dir), TOKENIZER)


def op11_fim(spark, sf_dir):
    return fim.fim_query(documents(spark, sf_dir))


def op12_html_extract(spark, sf_dir):
    return html_extract.html_query(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.runs_query(documents(spark, sf_dir))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_line_dedup": op3_line_dedup,
    "op4_sharding": op4_sharding,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_language_id": op7_language_id,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_bpe": op10_bpe,
    "op11_fim": op11_fim,
    "op12_html_extract": op12_html_extract,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES = {
    "op3_line_dedup": line_dedup.oracle(),
    "op6_quality_rules": quality_rules.oracle(),
    "op9_mixing": mixing.oracle(),
    "op11_fim": fim.oracle(),
}
