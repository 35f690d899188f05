"""Commit-log reports (C7, C8): one row per committed write, metrics unpacked from the map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.datetime import utc_to_local


def _metric(name: str, cast: str = "bigint"):
    return F.try_element_at(F.col("operationMetrics"), F.lit(name)).cast(cast)


def commit_report(log: DataFrame, tz: str = "Europe/London") -> DataFrame:
    """version, local commit time, operation, rows and bytes written."""
    return log.select("version", utc_to_local("timestamp", tz).alias("timestamp"), "operation",
                      _metric("numOutputRows").alias("num_rows_written"),
                      _metric("numOutputBytes").alias("num_bytes_written"))


def merge_report(log: DataFrame, tz: str = "Europe/London") -> DataFrame:
    """Merge history: inserted / written / updated / deleted rows and execution, scan, rewrite seconds."""
    return log.select(
        "version", utc_to_local("timestamp", tz).alias("timestamp"), "operation",
        _metric("numTargetRowsInserted").alias("num_rows_inserted"),
        _metric("numOutputRows").alias("num_rows_written"),
        _metric("numTargetRowsUpdated").alias("num_rows_updated"),
        _metric("numTargetRowsDeleted").alias("num_rows_deleted"),
        (_metric("executionTimeMs", "double") / 1000).alias("execution_time_seconds"),
        (_metric("scanTimeMs", "double") / 1000).alias("scan_time_seconds"),
        (_metric("rewriteTimeMs", "double") / 1000).alias("rewrite_time_seconds"))
