"""Alert XML bodies -> one row per event.

``from_xml`` parses JVM-side against a declared schema. Unlike ``xpath`` it does not fail the job on
a malformed body: the parsed struct comes back with NULL fields, so such messages can be routed to
quarantine. Reading whole ``MeterReading`` and ``Event`` structs keeps every event's timestamp and alert
code together, and each event inherits its reading's meter and delivery point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.datetime import parse_utc_millis, with_time_parts

# The element layout of the alert message (root element: Envelope).
ALERT_XML_SCHEMA = (
    "Body struct<MeterReadsReplyMessage: struct<payload: struct<"
    "MeterReading: array<struct<Meter: struct<mRID: string>, ServiceDeliveryPoint: struct<mRID: string>, "
    "Event: array<struct<timestamp: string, argument: array<struct<value: string>>>>>>, "
    "endTime: string>>>"
)
ALERT_CODE_ARGUMENT = 6          # the alert code is the value of the 6th argument
ALERT_COLUMNS = ["guid", "mpan", "event_timestamp", "alert_code", "end_time", "received_timestamp"]
DEDUPE_COLUMNS = ALERT_COLUMNS


def parse_alert_body(df: DataFrame, body: str = "Body") -> DataFrame:
    payload = F.from_xml(F.col(body), ALERT_XML_SCHEMA).getField("Body") \
        .getField("MeterReadsReplyMessage").getField("payload")
    return df.withColumn("_payload", payload)


def malformed_alerts(bronze: DataFrame, body: str = "Body") -> DataFrame:
    """Messages whose body holds no meter reading (quarantine): exactly those without a row in
    ``flatten_alerts``."""
    p = parse_alert_body(bronze, body)
    readings = F.coalesce(F.size("_payload.MeterReading"), F.lit(0))
    return p.filter(readings <= 0).drop("_payload")


def flatten_alerts(bronze: DataFrame, body: str = "Body",
                   received: str = "ReceivedTime", keep: list[str] | None = None,
                   time_parts: bool = True) -> DataFrame:
    """One row per Event of each MeterReading: guid, mpan, event_timestamp, alert_code, end_time, received_timestamp,
    plus event_date and event_year / _month / _day / _hour strings.

    A reading without events gives one row with a NULL event time and code; messages without readings
    (or not parseable) produce no rows; a missing 6th argument gives a NULL alert code; a timestamp without millis gives a NULL event time. ``keep`` columns of the
    message are carried onto each of its events.
    """
    keep = list(keep or [])
    p = parse_alert_body(bronze, body)
    # with the empty array, the optimizer doesn't ask for the array's size in a filter of its own, which it would
    # push below exchanges, down to the scan, and for which every body would be parsed once more
    readings = p.select(F.explode(F.coalesce("_payload.MeterReading", F.array())).alias("reading"),
                        F.col("_payload.endTime").alias("end_text"),
                        F.col(received).alias("received_timestamp"), *keep)
    events = readings.select(
        F.col("reading.Meter.mRID").alias("guid"),
        F.col("reading.ServiceDeliveryPoint.mRID").alias("mpan"),
        F.explode_outer("reading.Event").alias("ev"),
        "end_text", "received_timestamp", *keep)
    flat = events.select(
        "guid", "mpan",
        parse_utc_millis(F.col("ev.timestamp")).alias("event_timestamp"),
        F.get(F.col("ev.argument"), ALERT_CODE_ARGUMENT - 1).getField("value").alias("alert_code"),
        parse_utc_millis(F.col("end_text")).alias("end_time"),
        "received_timestamp", *keep)
    if not time_parts:
        return flat
    out = with_time_parts(flat, "event_timestamp", "event")
    return out.select(*[c for c in out.columns if c not in keep], *keep)
