"""The corpus pipeline: documents -> quality rules -> language ID -> near-dedup -> packed sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame,
which ``run`` writes as Parquet and reads again. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratum.llm import language_id, packing, quality_rules, simhash
from stratum.llm.common import ready, stored, table

#: No SQL: language ID, SimHash and tokenizers aren't expressible; the tests compare with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told clearly."""
    ready(spark)
    return language_id.keep_known(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id."""
    ready(spark)
    return simhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    ready(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality_stage), ("language ID", language_stage),
          ("SimHash near-dedup", dedup_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return docs
