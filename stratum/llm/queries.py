"""The operators applied to their whole tables, with production parameters.

``QUERIES`` maps a name to (spark, sf_dir) -> DataFrame; ``ORACLES`` holds DuckDB SQL for those that
SQL can express.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import (
    alignment, byte_bpe, chat_format, decontamination, divergence, language_id, neighbours, packing, quality_rules, simhash, token_count,
    toxicity, url_filter,
)
from stratum.llm.common import ready, table


def op1_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.filter(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"))
    return neighbours.nearest(vectors, asked)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return byte_bpe.encode_decode(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return language_id.languages(table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.linked_calls(*chat_format.calls_of(table(spark, sf_dir, "conversations")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return decontamination.digest(decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return alignment.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_token_count, op2_nearest_neighbours, op3_byte_bpe, op4_url_filter, op5_quality_rules, op6_language_id,
    op7_chat_format, op8_simhash, op9_packing, op10_toxicity, op11_decontamination, op12_source_divergence,
    op13_tokenizer_alignment, pipeline)}
ORACLES = {"op5_quality_rules": quality_rules.ORACLE_SQL, "op7_chat_format": chat_format.ORACLE_SQL,
           "op11_decontamination": decontamination.ORACLE_SQL, "op12_source_divergence": divergence.ORACLE_SQL}
