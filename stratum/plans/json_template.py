"""JSON template flow: JSON ingest (inferred types, rescued data) -> explode nested array with
drop / warn expectations -> temporary exploded feed -> apply changes by key and sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.functions.datetime import epoch_seconds_to_ts, ntz_to_epoch_seconds
from stratum.operators.changes import apply_changes
from stratum.operators.quality import expect, expect_or_drop, expectation_counts
from stratum.sources.files import infer_schema, stream_files
from stratum.sources.json import parse_json_rescue

# The declared expectations of the silver table.
DROP_RULES = {"valid_id": "table_id IS NOT NULL"}
WARN_RULES = {"over_24hr_old_data": "secs_since_last_reported < 86400"}
OTHER_SCHEMA = ("data STRUCT<stuff: ARRAY<STRUCT<a: STRING, b: STRING>>>, table_id STRING, "
                "last_updated BIGINT")


def raw_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """JSON lines as text, parsed with the frozen schema; unexpected fields rescued."""
    text = stream_files(spark, path, "text", "value STRING", max_files=max_files, recursiveFileLookup=True)
    return parse_json_rescue(text, "value", schema)


def raw_batch(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    text = spark.read.option("recursiveFileLookup", True).text(path)
    return parse_json_rescue(text, "value", schema)


def frozen_schema(spark: SparkSession, sample_path: str) -> StructType:
    return infer_schema(spark, sample_path, "json")


def exploded(raw: DataFrame) -> DataFrame:
    """One row per element of data.field with the derived time columns (before expectations)."""
    inner = raw.select(F.explode("data.field").alias("field"), "last_updated",
                       epoch_seconds_to_ts("last_updated").alias("last_updated_ts"))
    return inner.select(
        F.col("field.table_id").alias("table_id"),
        F.col("field.other_column").alias("other_column"),
        epoch_seconds_to_ts("field.last_reported").alias("last_reported_ts"),
        "last_updated", "last_updated_ts",
        F.to_date("last_updated_ts").alias("last_updated_date"),
        ntz_to_epoch_seconds(F.date_trunc("HOUR", F.col("last_updated_ts"))).alias("last_updated_hr"),
        (F.col("last_updated") - F.col("field.last_reported")).alias("secs_since_last_reported"))


def clean(raw: DataFrame):
    """Silver: drop rows without an id; count (keep) rows older than a day. Returns (df, observation)."""
    warned, obs = expect(exploded(raw), {**DROP_RULES, **WARN_RULES}, name="table_name_clean")
    return expect_or_drop(warned, DROP_RULES), obs


def clean_metrics(raw: DataFrame) -> DataFrame:
    return expectation_counts(exploded(raw), {**DROP_RULES, **WARN_RULES})


def exploded_other(raw: DataFrame) -> DataFrame:
    """Temporary feed: one row per stuff element, with the key and sequence projected through."""
    return raw.select(F.explode("data.stuff").alias("stuff"), "table_id", "last_updated") \
              .select("table_id", F.col("stuff.a").alias("a"), F.col("stuff.b").alias("b"),
                      "last_updated", epoch_seconds_to_ts("last_updated").alias("last_updated_ts"))


def stuff_clean(changes: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """APPLY CHANGES INTO stuff_clean KEYS (table_id) SEQUENCE BY last_updated."""
    return apply_changes(target, changes, "table_id", "last_updated")
