"""Message-bus envelope -> typed bronze columns.

Any streaming or batch source that yields an offset, an enqueue time and a binary body works
(a Kafka source gives ``offset, timestamp, value``: pass their names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from stratum.functions.datetime import utc_to_local


def utc_wall_clock(df: DataFrame, col: str) -> Column:
    """The column as a TIMESTAMP_NTZ UTC wall clock, whether it is NTZ already or an instant."""
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        return F.col(col)
    # instant -> session wall clock (cast) -> UTC wall clock (source zone = the session's)
    return F.convert_timezone(None, F.lit("UTC"), F.col(col).cast("timestamp_ntz"))


def ingest_envelope(df: DataFrame, tz: str = "Europe/London", offset: str = "offset",
                    enqueued: str = "enqueuedTime", body: str = "body",
                    keep: list[str] | None = None) -> DataFrame:
    """Offset as long, received time as local wall clock, UTC received date parts, body as text.

    The date parts use the calendar year ('yyyy'), not the week-based year.
    """
    utc = utc_wall_clock(df, enqueued)
    return df.select(
        F.col(offset).cast("long").alias("Offset"),
        utc_to_local(utc, tz).alias("ReceivedTime"),
        F.date_format(utc, "yyyy-MM-dd").alias("ReceivedDate"),
        F.date_format(utc, "yyyy").alias("ReceivedYear"),
        F.date_format(utc, "MM").alias("ReceivedMonth"),
        F.date_format(utc, "dd").alias("ReceivedDay"),
        F.col(body).cast("string").alias("Body"),
        *(keep or []),
    )


def stream_bus(spark, fmt: str = "kafka", options: dict | None = None, start_from: dict | None = None,
               tz: str = "Europe/London"):
    """A message-bus stream mapped to the bronze envelope columns.

    ``start_from`` is the starting position: ``{"offsets": "earliest" | "latest" | json}`` or
    ``{"timestamp": epoch_ms}`` (Kafka ``startingOffsets`` / ``startingTimestamp``). The connector
    jar must be on the cluster's classpath; none is bundled with this library.
    """
    r = spark.readStream.format(fmt).options(**(options or {}))
    if start_from:
        if "offsets" in start_from:
            r = r.option("startingOffsets", start_from["offsets"])
        if "timestamp" in start_from:
            r = r.option("startingTimestamp", str(start_from["timestamp"]))
    df = r.load()
    if fmt == "kafka":
        return ingest_envelope(df, tz, offset="offset", enqueued="timestamp", body="value")
    return ingest_envelope(df, tz)
