"""Voltage-alert flow: envelope -> bronze -> XML flatten -> dedupe -> enrich -> gold view (upsert)
and gold history (append); plus retention, commit-log reports and hourly reconciliation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from stratum.functions.datetime import with_time_parts
from stratum.functions.xml import DEDUPE_COLUMNS, flatten_alerts
from stratum.operators.changes import dedupe
from stratum.operators.joins import enrich, strip_text, with_region
from stratum.sources.envelope import ingest_envelope
from stratum.sources.files import read_lookup, redistribute

# Distribution network by mpan prefix; anything else (or NULL) is 'Others'.
DNO_PREFIXES = {"12": "LPN", "19": "SPN", "10": "EPN"}
# The alert-code lookup CSV header and the names it is renamed to.
LOOKUP_SCHEMA = StructType([StructField(n, StringType(), True) for n in
                            ["Alert Code", "DESC_TEXT", "Alert Type", "Final Desc", "Phase", "Phase Number"]])
LOOKUP_RENAMES = {"Alert Code": "alert_code", "DESC_TEXT": "alert_desc", "Alert Type": "alert_type",
                  "Final Desc": "final_alert_desc", "Phase": "phase", "Phase Number": "phase_number"}
MERGE_KEYS = ["mpan", "event_timestamp", "received_timestamp"]
GOLD_PARTITION_BY = ["event_year", "event_month", "event_day"]
BRONZE_PARTITION_BY = ["ReceivedYear", "ReceivedMonth", "ReceivedDay"]


def bronze(envelope: DataFrame, tz: str = "Europe/London", keep: list[str] | None = None,
           width: int | None = None, dealt: bool = False) -> DataFrame:
    """Typed envelopes. Their bodies are heavy to parse, so a narrow scan is dealt out first (P17), unless
    the envelopes were made from rows already ``dealt`` out."""
    return ingest_envelope(envelope if dealt else redistribute(envelope, width=width), tz, keep=keep)


def flattened(bronze_df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return flatten_alerts(bronze_df, keep=keep)


def silver(bronze_df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Flattened alerts without exact repeats (6-column key, plus any ``keep`` columns such as a
    micro-batch id, so that repeats are removed within each batch).

    The repeats are removed before the date parts are derived: the dedupe is then a plain distinct
    over the key columns (hash aggregate with a map-side partial), and the parts are computed once
    per surviving row.
    """
    keep = list(keep or [])
    base = dedupe(flatten_alerts(bronze_df, time_parts=False, keep=keep), DEDUPE_COLUMNS + keep)
    out = with_time_parts(base, "event_timestamp", "event")
    return out.select(*[c for c in out.columns if c not in keep], *keep)


def alert_lookup(spark: SparkSession, path: str) -> DataFrame:
    df = read_lookup(spark, path, LOOKUP_SCHEMA, LOOKUP_RENAMES)
    return df.withColumn("alert_code", strip_text("alert_code", "0x"))


def join_lookup(silver_df: DataFrame, lookup: DataFrame) -> DataFrame:
    return enrich(silver_df, lookup, "alert_code", "inner")


def join_connectivity(df: DataFrame, connectivity: DataFrame) -> DataFrame:
    return enrich(df, connectivity, "mpan", "left_outer")


def enriched(silver_df: DataFrame, lookup: DataFrame, connectivity: DataFrame) -> DataFrame:
    """Inner join on alert code, left outer join on mpan, then the network operator by prefix."""
    return with_region(join_connectivity(join_lookup(silver_df, lookup), connectivity), "mpan", DNO_PREFIXES)


def gold_table(spark: SparkSession, path: str, schema: StructType, sink_id: str = "vw_voltage_alerts"):
    from stratum.streaming.upsert import UpsertTable
    return UpsertTable(spark, path, MERGE_KEYS, schema, GOLD_PARTITION_BY, sink_id=sink_id,
                       dedupe_cols=DEDUPE_COLUMNS, on_multiple="all", partition_from_keys=True)  # event_timestamp's date


def run_voltage(spark: SparkSession, envelope_path: str, lookup_path: str, connectivity: DataFrame,
                root: str, envelope_schema: StructType, trigger: dict | None = None, view: bool = True):
    """Ingest then enrich, in order (U5): two streaming stages, each with its own checkpoint.

    Stage 1 appends typed envelopes to bronze (partitioned by received date). Stage 2 streams bronze
    into the gold history (append, partitioned by event date) and, when ``view``, into the gold view
    through a per-batch upsert (foreachBatch) — two sinks from one flattened stream (T12).
    """
    from stratum.sources.files import stream_files, stream_table
    from stratum.streaming.sinks import append_stream, upsert_stream

    b_path, h_path, v_path = f"{root}/bronze", f"{root}/history", f"{root}/view"
    env = stream_files(spark, envelope_path, "parquet", envelope_schema, recursiveFileLookup=True)
    b = bronze(env)
    append_stream(b, b_path, f"{root}/ck/bronze", BRONZE_PARTITION_BY, trigger).awaitTermination()

    # bronze is read with its declared schema: received-date partition values stay strings
    flat = flattened(stream_table(spark, b_path, schema=b.schema))
    append_stream(flat, h_path, f"{root}/ck/history", GOLD_PARTITION_BY, trigger).awaitTermination()
    paths = {"bronze": b_path, "history": h_path}
    if view:
        lookup = alert_lookup(spark, lookup_path)
        # repeats go within each batch, and the merge puts a repeated row in its own place: no state
        gold = enriched(flat, lookup, connectivity)
        table = gold_table(spark, v_path, gold.schema)
        upsert_stream(gold, table, f"{root}/ck/view", trigger).awaitTermination()
        paths["view"] = v_path
    return paths
