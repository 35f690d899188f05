"""IoT users flow: CSV stream -> bronze (ingest id + time) -> silver (watermark, drop nulls) ->
gold (average weight by gender, complete mode); ad-hoc averages before/after clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.functions.columns import stamp_ingest
from stratum.operators.aggregates import avg_by_key
from stratum.sources.files import redistribute, stream_files


def bronze_stream(spark: SparkSession, path: str, schema: StructType, max_files: int = 1,
                  partitions: int | None = None) -> DataFrame:
    """CSV files one per trigger, stamped with a random id and the ingest time."""
    return stamp_ingest(redistribute(stream_files(spark, path, "csv", schema, max_files=max_files), width=partitions))


def silver(bronze: DataFrame, delay: str = "1 day") -> DataFrame:
    """Watermark on the ingest time (no effect without a stateful operator) and drop null rows."""
    return bronze.withWatermark("timestamp", delay).dropna()


def gold(silver_df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Average weight per gender; a streaming input runs in complete mode."""
    return silver_df.withWatermark("timestamp", delay).groupBy("gender") \
                    .agg(F.avg("weight").alias("avg_weight"))


def gender_averages(silver_df: DataFrame) -> DataFrame:
    """SELECT gender, avg(weight) AVG_weight, avg(height) AVG_height ... ORDER BY gender DESC, AVG_weight."""
    return avg_by_key(silver_df, "gender", ["weight", "height"], ["AVG_weight", "AVG_height"],
                      order=[F.col("gender").desc(), F.col("AVG_weight").asc()])
