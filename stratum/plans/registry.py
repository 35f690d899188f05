"""Registered queries: name -> (Spark callable (spark, sf_dir) -> DataFrame, DuckDB oracle SQL or None).

Each Spark query reads the driver tables (or feeds Spark derives from them and lands in the shared
scratch area) and runs the library's operators over the whole of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.plans import fixtures as fx
from stratum.plans import oracle as osql
from stratum.plans import retail

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _round(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ------------------------------------------------------------------------------------ retail
def _retail_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned node as a table: the feed is written once, then read by the quality node.

    Materialising it (as the flow does between nodes) keeps the text-building expressions of the
    feed out of the quality filter, which Catalyst would otherwise inline and evaluate per rule.
    """
    from stratum.session import scratch_dir
    path = scratch_dir(spark, "retail_cleaned") + "/cleaned"
    retail.cleaned_retail(fx.retail_src(spark, sf_dir).drop("arrival"), dealt=True).write.parquet(path)
    return spark.read.parquet(path)


def _retail_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.sales_all_countries(retail.quality_retail(_retail_cleaned(spark, sf_dir)))


@register("retail_quality", osql.RETAIL_QUALITY)
def q_retail_quality(spark, sf_dir):
    return retail.quality_retail(_retail_cleaned(spark, sf_dir))


@register("apply_changes_latest", osql.RETAIL_LATEST)
def q_apply_changes_latest(spark, sf_dir):
    return _retail_latest(spark, sf_dir)


@register("retail_sales_by_country", f"""
SELECT Country, ROUND(SUM(Quantity), 4) AS TotalSales FROM ({osql.RETAIL_LATEST}) GROUP BY Country
""")
def q_retail_sales_by_country(spark, sf_dir):
    return _round(retail.sales_by_country(_retail_latest(spark, sf_dir)), ["TotalSales"])


def _land_and_ingest_retail(spark: SparkSession, sf_dir: str) -> str:
    """Land the retail CSV feed, ingest it with the incremental CSV stream, return the raw table."""
    from stratum.session import scratch_dir
    from stratum.streaming.sinks import append_stream
    root = scratch_dir(spark, "retail_raw")
    csv = fx.land_retail_csv(spark, sf_dir, root)
    raw = retail.raw_retail_stream(spark, csv)
    append_stream(raw, f"{root}/raw", f"{root}/ck_raw", partition_by=["Country"]).awaitTermination()
    return f"{root}/raw"


def _folder_of_file(col: str = "inputFileName"):
    # parent folder of the source file: 'arrival=<year>'
    return F.element_at(F.split(F.col(col), "/"), -2)


@register("retail_raw", osql.RETAIL_RAW)
def q_retail_raw(spark, sf_dir):
    raw = spark.read.parquet(_land_and_ingest_retail(spark, sf_dir))
    return raw.withColumn("inputFileName", _folder_of_file())


@register("path_query", osql.RETAIL_PATH_QUERY)
def q_path_query(spark, sf_dir):
    from stratum.sources.files import path_query
    raw = _land_and_ingest_retail(spark, sf_dir)
    return path_query(spark, """
        SELECT Country, COUNT(*) AS line_count, ROUND(SUM(Quantity), 4) AS total_quantity,
               COUNT(DISTINCT element_at(split(inputFileName, '/'), -2)) AS file_folders
        FROM parquet.`{raw}` GROUP BY Country""", raw=raw)


@register("retail_quarantine", osql.RETAIL_QUARANTINE)
def q_retail_quarantine(spark, sf_dir):
    return retail.quarantined_retail(_retail_cleaned(spark, sf_dir))


@register("quality_split", osql.RETAIL_SPLIT)
def q_quality_split(spark, sf_dir):
    from stratum.operators.quality import failed_rules
    shaped = retail.shape_retail(_retail_cleaned(spark, sf_dir))
    return shaped.withColumn("failed_rules", F.array_join(failed_rules(retail.QUALITY_RULES), ","))


@register("retail_by_country_split", osql.RETAIL_QUALITY)
def q_retail_by_country_split(spark, sf_dir):
    from stratum.session import scratch_dir
    from stratum.sources.files import read_table
    path = scratch_dir(spark, "retail_split") + "/split_by_country"
    quality = retail.quality_retail(_retail_cleaned(spark, sf_dir))
    (retail.quality_split_by_country(quality).write.mode("overwrite")
        .partitionBy("Country").parquet(path))
    return read_table(spark, path)


@register("apply_changes_late", osql.RETAIL_LATEST)
def q_apply_changes_late(spark, sf_dir):
    """Change batches applied incrementally, newest year first: older rows arrive after newer ones.

    Each batch is merged into the stored target (the per-batch apply-changes a stream runs), never
    re-aggregating the whole target.
    """
    from stratum.session import scratch_dir
    from stratum.streaming.upsert import UpsertTable
    root = scratch_dir(spark, "apply_late")
    retail.quality_retail(_retail_cleaned(spark, sf_dir)).write.parquet(f"{root}/quality")
    quality = spark.read.parquet(f"{root}/quality")
    years = sorted(r[0] for r in quality.select(F.year("InvoiceDatetime")).distinct().collect())
    table = UpsertTable(spark, f"{root}/target", retail.CHANGE_KEYS, quality.schema, sink_id="apply_changes",
                        on_multiple="latest", sequence_by=[retail.SEQUENCE_BY])
    for y in reversed(years):
        table.merge_batch(quality.filter(F.year("InvoiceDatetime") == y), int(y))
    return table.read()


@register("retail_sales_by_day", osql.RETAIL_SALES_BY_DAY)
def q_retail_sales_by_day(spark, sf_dir):
    return _round(retail.sales_by_day(_retail_latest(spark, sf_dir)), ["TotalSales"])


@register("retail_top_customers", osql.RETAIL_TOP_CUSTOMERS)
def q_retail_top_customers(spark, sf_dir):
    return _round(retail.top_ten_customers(_retail_latest(spark, sf_dir)), ["TotalSales"])


@register("retail_countries", osql.RETAIL_COUNTRIES)
def q_retail_countries(spark, sf_dir):
    return retail.distinct_countries(retail.quality_retail(_retail_cleaned(spark, sf_dir)))


@register("retail_dag", osql.RETAIL_TOP_CUSTOMERS)
def q_retail_dag(spark, sf_dir):
    """The whole retail graph (streams + complete tables) in dependency order; returns the top ten."""
    from stratum.session import scratch_dir
    from stratum.sources.catalog import delete_folder
    root = scratch_dir(spark, "retail_dag")
    csv = fx.land_retail_csv(spark, sf_dir, root)
    # the landed files go once the raw table holds their rows
    tables = retail.run_retail(spark, csv, root, prefix="retail_" + root.rsplit("-", 1)[-1], keep_hours=0,
                               landed=lambda: delete_folder(spark, csv))
    return _round(tables.table(spark, "top_ten_customers"), ["TotalSales"])


# ------------------------------------------------------------------------------- voltage alerts
from stratum.functions.datetime import with_time_parts  # noqa: E402
from stratum.functions.xml import DEDUPE_COLUMNS  # noqa: E402
from stratum.operators import aggregates as agg  # noqa: E402
from stratum.operators.changes import dedupe  # noqa: E402
from stratum.plans import voltage  # noqa: E402

FLAT_COLS = [c.strip() for c in osql.FLAT_COLS.split(",")]
AS_OF = "2024-04-15"


def _bronze(spark, sf_dir, with_delivery=False):
    return voltage.bronze(fx.alerts_envelope(spark, sf_dir), keep=["delivery"] if with_delivery else [], dealt=True)


def _lookup(spark, sf_dir):
    from stratum.session import scratch_dir
    root = scratch_dir(spark, "alert_lookup")
    return voltage.alert_lookup(spark, fx.land_alert_lookup(spark, sf_dir, root))


@register("envelope_ingest", f"SELECT {osql.BRONZE_COLS} FROM ({osql.BRONZE})")
def q_envelope_ingest(spark, sf_dir):
    return voltage.bronze(fx.alerts_envelope(spark, sf_dir).drop("delivery"), dealt=True)


@register("voltage_flatten", osql.FLATTEN)
def q_voltage_flatten(spark, sf_dir):
    return voltage.flattened(_bronze(spark, sf_dir))


@register("voltage_silver", osql.SILVER)
def q_voltage_silver(spark, sf_dir):
    return voltage.silver(_bronze(spark, sf_dir))


@register("dedupe_subset", f"SELECT DISTINCT mpan, alert_code FROM ({osql.FLATTEN})")
def q_dedupe_subset(spark, sf_dir):
    return dedupe(voltage.flattened(_bronze(spark, sf_dir)), ["mpan", "alert_code"]).select("mpan", "alert_code")


@register("alert_lookup", osql.LOOKUP)
def q_alert_lookup(spark, sf_dir):
    return _lookup(spark, sf_dir)


@register("join_inner_lookup", osql.JOIN_INNER)
def q_join_inner_lookup(spark, sf_dir):
    return voltage.join_lookup(voltage.silver(_bronze(spark, sf_dir)), _lookup(spark, sf_dir))


@register("join_left_customer", osql.JOIN_LEFT)
def q_join_left_customer(spark, sf_dir):
    j = voltage.join_lookup(voltage.silver(_bronze(spark, sf_dir)), _lookup(spark, sf_dir))
    return voltage.join_connectivity(j, fx.connectivity(spark, sf_dir))


@register("region_case", osql.REGION)
def q_region_case(spark, sf_dir):
    return voltage.enriched(voltage.silver(_bronze(spark, sf_dir)), _lookup(spark, sf_dir),
                            fx.connectivity(spark, sf_dir))


def _gold_run(spark, sf_dir):
    """Upsert the enriched alerts delivery by delivery (the foreachBatch function, driven in order).

    The per-batch transformations (parse, dedupe within the batch, enrich) run for all deliveries
    in one parallel pass, written partitioned by delivery; each micro-batch then reads its folder.
    """
    from stratum.session import scratch_dir
    root = scratch_dir(spark, "voltage_gold")
    env = fx.alerts_envelope(spark, sf_dir)
    lookup = _lookup(spark, sf_dir)
    conn = fx.connectivity(spark, sf_dir)
    batches = voltage.enriched(voltage.silver(voltage.bronze(env, keep=["delivery"], dealt=True), keep=["delivery"]),
                               lookup, conn)
    batches.write.partitionBy("delivery").parquet(f"{root}/batches")
    staged = spark.read.parquet(f"{root}/batches")
    deliveries = sorted(r[0] for r in staged.select("delivery").distinct().collect())
    table = None
    for d in deliveries:
        batch = staged.filter(F.col("delivery") == d).drop("delivery")
        if table is None:
            table = voltage.gold_table(spark, f"{root}/view", batch.schema)
        table.merge_batch(batch, int(d))
    return table


@register("voltage_gold", osql.GOLD_VIEW)
def q_voltage_gold(spark, sf_dir):
    return _gold_run(spark, sf_dir).read()


@register("upsert_batches", osql.UPSERT_BATCHES)
def q_upsert_batches(spark, sf_dir):
    """MERGE (update all / insert all) of event batches into an initially empty target, keyed on
    value columns, batches newest first: the last merged batch wins, whatever its timestamps."""
    from stratum.operators.changes import merge_upsert
    from stratum.session import scratch_dir
    from stratum.sources.files import empty_like
    root = scratch_dir(spark, "upsert_batches")
    ev = fx.table(spark, sf_dir, "events")
    blk = ((F.dayofmonth("ts") - 1) / 10).cast("int")
    blocks = sorted(r[0] for r in ev.select(blk.alias("b")).distinct().collect())
    target = empty_like(ev)
    for i, b in enumerate(reversed(blocks)):
        merged = merge_upsert(target, ev.filter(blk == b), ["user_id", "event_type"],
                              on_multiple="latest", sequence_by="ts")
        merged.write.parquet(f"{root}/v{i}")        # each version is a written table (lineage cut)
        target = spark.read.parquet(f"{root}/v{i}")
    return target


@register("merge_log_report", osql.MERGE_LOG)
def q_merge_log_report(spark, sf_dir):
    from stratum.operators.reports import merge_report
    rep = merge_report(_gold_run(spark, sf_dir).log.read())
    return rep.select("version", "operation", "num_rows_inserted", "num_rows_updated", "num_rows_deleted")


@register("commit_log_report", osql.COMMIT_LOG)
def q_commit_log_report(spark, sf_dir):
    """Bronze written delivery by delivery, each write recorded in the table's commit log."""
    from stratum.operators.reports import commit_report
    from stratum.session import scratch_dir
    from stratum.streaming.upsert import CommitLog, append_batch
    root = scratch_dir(spark, "bronze_log")
    env_path = f"{root}/envelope"
    fx.alerts_envelope(spark, sf_dir).write.partitionBy("delivery").parquet(env_path)
    env = spark.read.parquet(env_path)
    log = CommitLog(spark, f"{root}/bronze_commits")
    for d in sorted(r[0] for r in env.select("delivery").distinct().collect()):
        append_batch(voltage.bronze(env.filter(F.col("delivery") == d)), f"{root}/bronze", log,
                     "bronze", int(d), voltage.BRONZE_PARTITION_BY)
    return commit_report(log.read()).select("version", "operation", "num_rows_written")


def _stored_history(spark, sf_dir):
    """Gold history: flattened alerts appended, partitioned by event date. Returns (path, schema)."""
    from stratum.session import scratch_dir
    from stratum.sources.catalog import overwrite_table
    path = scratch_dir(spark, "voltage_history") + "/history"
    flat = voltage.flattened(_bronze(spark, sf_dir))
    overwrite_table(flat, path, voltage.GOLD_PARTITION_BY, optimize_write=True)
    return path, flat.schema


def _history(spark, sf_dir):
    """The gold history read with its schema."""
    from stratum.sources.catalog import read_partitioned
    path, schema = _stored_history(spark, sf_dir)
    return read_partitioned(spark, path, schema).select(*schema.fieldNames())


@register("voltage_history", osql.FLATTEN)
def q_voltage_history(spark, sf_dir):
    return _history(spark, sf_dir)


@register("schema_evolution", f"""
SELECT {osql.FLAT_COLS}, CASE WHEN delivery >= 1 THEN 'delivery-' || CAST(delivery AS VARCHAR) END AS source_batch
FROM ({osql._FLAT_BASE})""")
def q_schema_evolution(spark, sf_dir):
    """Later batches add a column; the table is read back with the merged schema (missing = NULL)."""
    from stratum.session import scratch_dir
    from stratum.sources.catalog import overwrite_table
    path = scratch_dir(spark, "schema_evolution") + "/history"
    flat = voltage.flattened(_bronze(spark, sf_dir, with_delivery=True), keep=["delivery"])
    first = flat.filter(F.col("delivery") == 0).drop("delivery")
    later = (flat.filter(F.col("delivery") >= 1)
                 .withColumn("source_batch", F.concat(F.lit("delivery-"), F.col("delivery").cast("string")))
                 .drop("delivery"))
    overwrite_table(first, path + "/part=0")
    overwrite_table(later, path + "/part=1")
    from stratum.operators.schema import read_merged
    merged = read_merged(spark, path + "/part=0", path + "/part=1")
    return merged.select(*FLAT_COLS, "source_batch")


# ------------------------------------------------------------------------ reconciliation, retention
@register("recon_bronze_received", osql.hourly(f"SELECT * FROM ({osql.BRONZE})", "ReceivedTime",
                                               "received_start_time", "received_end_time"))
def q_recon_bronze_received(spark, sf_dir):
    return agg.count_by_window(_bronze(spark, sf_dir), "ReceivedTime", "1 hour", "1 hour",
                               "received_start_time", "received_end_time")


@register("recon_view_event", osql.hourly(osql.GOLD_VIEW, "event_timestamp", "start_time", "end_time"))
def q_recon_view_event(spark, sf_dir):
    return agg.count_by_window(_gold_run(spark, sf_dir).read(), "event_timestamp", "1 hour")


@register("recon_history_received", osql.hourly(osql.FLATTEN, "received_timestamp", "start_time", "end_time"))
def q_recon_history_received(spark, sf_dir):
    return agg.count_by_window(_history(spark, sf_dir), "received_timestamp", "1 hour")


@register("recon_history_event", osql.hourly(osql.FLATTEN, "event_timestamp",
                                             "event_start_time", "event_end_time"))
def q_recon_history_event(spark, sf_dir):
    return agg.count_by_window(_history(spark, sf_dir), "event_timestamp", "1 hour", None,
                               "event_start_time", "event_end_time")


@register("recon_compare", f"""
WITH a AS ({osql.hourly(f"SELECT * FROM ({osql.BRONZE})", "ReceivedTime", "start_time", "end_time")}),
b AS ({osql.hourly(osql.FLATTEN, "received_timestamp", "start_time", "end_time")})
SELECT COALESCE(a.start_time, b.start_time) AS start_time,
       COALESCE(a.count, 0) AS bronze_messages, COALESCE(b.count, 0) AS history_events,
       COALESCE(a.count, 0) - COALESCE(b.count, 0) AS difference
FROM a FULL JOIN b ON a.start_time = b.start_time
""")
def q_recon_compare(spark, sf_dir):
    """Bronze messages vs gold-history events per received hour (full outer join + difference)."""
    a = agg.count_by_window(_bronze(spark, sf_dir), "ReceivedTime", "1 hour")
    b = agg.count_by_window(_history(spark, sf_dir), "received_timestamp", "1 hour")
    return agg.reconcile(a, b, "start_time", "bronze_messages", "history_events")


@register("retention_delete", f"""
SELECT {osql.BRONZE_COLS} FROM ({osql.BRONZE})
WHERE NOT COALESCE(CAST(ReceivedDate AS DATE) < DATE '2024-01-15', FALSE)""")
def q_retention_delete(spark, sf_dir):
    """Stored bronze after DELETE WHERE months_between(as_of, ReceivedDate) > 3 (as_of fixed: 2024-04-15)."""
    from stratum.session import scratch_dir
    from stratum.sources.catalog import delete_expired, overwrite_table, read_partitioned
    path, bronze = scratch_dir(spark, "retention") + "/bronze", _bronze(spark, sf_dir)
    overwrite_table(bronze, path, voltage.BRONZE_PARTITION_BY, optimize_write=True)
    delete_expired(spark, path, bronze.schema, "ReceivedDate", voltage.BRONZE_PARTITION_BY, 3, AS_OF, "date")
    return read_partitioned(spark, path, bronze.schema).select(*bronze.columns)


@register("retention_delete_ts", f"""
SELECT {osql.FLAT_COLS} FROM ({osql._FLAT_BASE})
WHERE NOT COALESCE(event_timestamp < TIMESTAMP '2024-01-15 00:00:00', FALSE)""")
def q_retention_delete_ts(spark, sf_dir):
    """Stored gold history after DELETE WHERE months_between(as_of, event_timestamp) > 3."""
    from stratum.sources.catalog import delete_expired, read_partitioned
    path, schema = _stored_history(spark, sf_dir)
    delete_expired(spark, path, schema, "event_timestamp", voltage.GOLD_PARTITION_BY, 3, AS_OF + " 00:00:00",
                   "timestamp")
    return read_partitioned(spark, path, schema).select(*schema.fieldNames())


@register("table_counts", f"""
SELECT 'bronze' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM ({osql.BRONZE})
UNION ALL SELECT 'history', CAST(count(*) AS BIGINT) FROM ({osql.FLATTEN})
UNION ALL SELECT 'silver', CAST(count(*) AS BIGINT) FROM ({osql.SILVER})
""")
def q_table_counts(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return agg.table_counts({"bronze": b, "history": voltage.flattened(b), "silver": voltage.silver(b)})


@register("recent_alerts", f"""
SELECT * FROM ({osql.BRONZE.replace(', delivery', '')}) WHERE ReceivedTime > TIMESTAMP '2024-01-29 12:00:00'
ORDER BY ReceivedTime DESC, "Offset" DESC LIMIT 100""")
def q_recent_alerts(spark, sf_dir):
    """Ad-hoc: newest 100 bronze messages after a cut-off (filter + order + limit)."""
    b = _bronze(spark, sf_dir)
    return (b.filter(F.col("ReceivedTime") > F.lit("2024-01-29 12:00:00").cast("timestamp_ntz"))
              .orderBy(F.col("ReceivedTime").desc(), F.col("Offset").desc()).limit(100))


# ------------------------------------------------------------------------------- JSON template
from stratum.plans import json_template as jt  # noqa: E402


def _json_bronze(spark, sf_dir):
    """Land the JSON feed; freeze the schema inferred from the early files; stream all files in."""
    from stratum.session import scratch_dir
    from stratum.streaming.sinks import append_stream
    root = scratch_dir(spark, "json_ingest")
    path = fx.land_json(spark, sf_dir, root)
    schema = jt.frozen_schema(spark, f"{path}/late=false")
    append_stream(jt.raw_stream(spark, path, schema), f"{root}/bronze", f"{root}/ck").awaitTermination()
    return spark.read.parquet(f"{root}/bronze")


@register("json_ingest", f"SELECT last_updated, n_field, _rescued_data FROM ({osql.JSON_RECORDS})")
def q_json_ingest(spark, sf_dir):
    b = _json_bronze(spark, sf_dir)
    return b.select("last_updated", F.size("data.field").alias("n_field"), "_rescued_data")


@register("json_rescue", f"SELECT last_updated, _rescued_data FROM ({osql.JSON_RECORDS}) WHERE _rescued_data IS NOT NULL")
def q_json_rescue(spark, sf_dir):
    return _json_bronze(spark, sf_dir).filter(F.col("_rescued_data").isNotNull()) \
        .select("last_updated", "_rescued_data")


@register("json_flatten", osql.JSON_FLATTEN)
def q_json_flatten(spark, sf_dir):
    df, _ = jt.clean(_json_bronze(spark, sf_dir))
    return df


@register("expect_metrics", osql.JSON_EXPECT)
def q_expect_metrics(spark, sf_dir):
    return jt.clean_metrics(_json_bronze(spark, sf_dir))


@register("json_apply_changes", osql.JSON_APPLY)
def q_json_apply_changes(spark, sf_dir):
    from stratum.session import scratch_dir
    from pyspark.sql.types import _parse_datatype_string
    path = scratch_dir(spark, "json_other") + "/other_raw"
    fx.other_records(spark, sf_dir).write.text(path)
    raw = jt.raw_batch(spark, path, _parse_datatype_string(jt.OTHER_SCHEMA))
    return jt.stuff_clean(jt.exploded_other(raw))


# ------------------------------------------------------------------------------------- IoT
from stratum.plans import iot  # noqa: E402


def _iot_csv(spark, sf_dir):
    from stratum.session import scratch_dir
    root = scratch_dir(spark, "iot")
    return root, fx.land_iot_csv(spark, sf_dir, root)


def _stamped_view(df):
    return df.select(*fx.IOT_CSV_COLUMNS, F.length("id").alias("id_length"),
                     F.col("timestamp").isNotNull().alias("has_ingest_time"))


@register("csv_infer", osql.IOT_CSV)
def q_csv_infer(spark, sf_dir):
    from stratum.sources.files import infer_schema, read_csv
    _, path = _iot_csv(spark, sf_dir)
    return read_csv(spark, path, schema=infer_schema(spark, path, "csv"))


@register("stamp_ingest", osql.IOT_STAMPED)
def q_stamp_ingest(spark, sf_dir):
    from stratum.functions.columns import stamp_ingest
    return _stamped_view(stamp_ingest(fx.iot_src(spark, sf_dir)))


@register("drop_nulls", osql.IOT_SILVER)
def q_drop_nulls(spark, sf_dir):
    return fx.iot_src(spark, sf_dir).dropna()


@register("avg_by_key", osql.IOT_AVG)
def q_avg_by_key(spark, sf_dir):
    return _round(iot.gender_averages(fx.iot_src(spark, sf_dir).dropna()), ["AVG_weight", "AVG_height"])


def _iot_bronze(spark, sf_dir):
    """CSV stream (one file per trigger) -> stamped bronze table (file sink, availableNow)."""
    from stratum.sources.files import infer_schema
    from stratum.streaming.sinks import append_stream
    root, path = _iot_csv(spark, sf_dir)
    schema = infer_schema(spark, path, "csv")
    append_stream(iot.bronze_stream(spark, path, schema, max_files=1), f"{root}/bronze",
                  f"{root}/ck_bronze").awaitTermination()
    return root


@register("stream_bronze_append", osql.IOT_STAMPED)
def q_stream_bronze_append(spark, sf_dir):
    root = _iot_bronze(spark, sf_dir)
    return _stamped_view(spark.read.parquet(f"{root}/bronze"))


@register("stream_silver_gold", osql.IOT_GOLD)
def q_stream_silver_gold(spark, sf_dir):
    """bronze -> silver (append) -> gold (complete mode, one silver file per trigger)."""
    import uuid
    from stratum.sources.files import stream_table
    from stratum.streaming.sinks import append_stream, memory_stream
    root = _iot_bronze(spark, sf_dir)
    append_stream(iot.silver(stream_table(spark, f"{root}/bronze")), f"{root}/silver",
                  f"{root}/ck_silver").awaitTermination()
    name = f"iot_gold_{uuid.uuid4().hex[:8]}"
    q = memory_stream(iot.gold(stream_table(spark, f"{root}/silver", max_files=1)), name, "complete",
                      f"{root}/ck_gold")
    q.awaitTermination()
    return _round(spark.table(name), ["avg_weight"])


def _arrive_in_order(df: DataFrame, root: str, cuts: list, run) -> None:
    """Files arrive cut by cut: each cut is landed with an ordinary parallel write, then the stream
    picks it up with one ``availableNow`` run on the same checkpoint (one micro-batch per cut, plus
    the no-data batch Spark adds to advance the watermark)."""
    for i, cond in enumerate(cuts):
        df.filter(cond).write.parquet(f"{root}/in/f{i:03d}")
        run().awaitTermination()


def _stream_in(spark, root: str, schema):
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/in")


@register("stream_window_count", osql.EVENTS_HOURLY)
def q_stream_window_count(spark, sf_dir):
    """Hourly counts over an event stream (files arrive in time order); complete mode closes the tail."""
    import uuid
    from stratum.session import scratch_dir
    from stratum.streaming.late import count_by_window_stream, event_time
    from stratum.streaming.sinks import memory_stream
    root = scratch_dir(spark, "window_stream")
    ev = fx.table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    name = f"win_{uuid.uuid4().hex[:8]}"

    def run():
        src = event_time(_stream_in(spark, root, ev.schema), "ts")
        return memory_stream(count_by_window_stream(src, "ts", "1 hour", "1 hour"), name, "complete", f"{root}/ck")

    _arrive_in_order(ev, root, [day <= 10, (day > 10) & (day <= 20), day > 20], run)
    return spark.table(name).select(F.col("start_time").cast("timestamp_ntz").alias("start_time"),
                                    F.col("end_time").cast("timestamp_ntz").alias("end_time"), "count")


def _deduped_stream(spark, sf_dir):
    """Flattened alerts deduped on a stream with the state bounded by an event-time watermark;
    deliveries (and their replays) arrive in order. Returns (rows kept, side table of the others)."""
    from stratum.session import scratch_dir
    from stratum.sources.files import stream_table
    from stratum.streaming.late import dedupe_stream, event_time, late_rows
    from stratum.streaming.sinks import append_stream
    root = scratch_dir(spark, "stream_dedupe")
    env = fx.alerts_envelope(spark, sf_dir)
    deliveries = sorted(r[0] for r in env.select("delivery").distinct().collect())
    bronze = voltage.bronze(env, keep=["delivery"], dealt=True)
    schema = voltage.flattened(bronze.drop("delivery")).schema

    def run():
        # the bodies are parsed once: the stream stores its flattened rows, which the dedupe and the side table read
        append_stream(voltage.flattened(_stream_in(spark, root, bronze.schema).drop("delivery")), f"{root}/flat",
                      f"{root}/ck_flat").awaitTermination()
        flat = event_time(stream_table(spark, f"{root}/flat", schema), "event_timestamp")
        out = dedupe_stream(flat, DEDUPE_COLUMNS, "event_timestamp", "1 day")
        return append_stream(out, f"{root}/silver", f"{root}/ck")

    _arrive_in_order(bronze, root, [F.col("delivery") == d for d in deliveries], run)
    s = spark.read.parquet(f"{root}/silver")
    kept = s.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")).select(*FLAT_COLS)
    arrived = spark.read.schema(schema).parquet(f"{root}/flat").select(*DEDUPE_COLUMNS)
    with_time_parts(late_rows(arrived, kept, DEDUPE_COLUMNS), "event_timestamp", "event").select(*FLAT_COLS) \
        .write.parquet(f"{root}/late")
    return kept, spark.read.parquet(f"{root}/late")


@register("stream_dedupe", osql.SILVER)
def q_stream_dedupe(spark, sf_dir):
    """All distinct alerts: those the stream kept and those of its side table."""
    kept, late = _deduped_stream(spark, sf_dir)
    return kept.unionByName(late)


@register("stream_late_rows", osql.DEDUPE_LATE)
def q_stream_late_rows(spark, sf_dir):
    """The side table alone: alerts behind the watermark when they arrived, or without an event time."""
    return _deduped_stream(spark, sf_dir)[1]


@register("stream_late_filter", osql.LATE_FILTER)
def q_stream_late_filter(spark, sf_dir):
    """Event files arrive out of time order; rows behind the watermark are dropped as late."""
    from stratum.session import scratch_dir
    from stratum.streaming.late import drop_late, event_time
    from stratum.streaming.sinks import append_stream
    root = scratch_dir(spark, "late_filter")
    ev = fx.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    day = F.dayofmonth("ts")

    def run():
        out = drop_late(event_time(_stream_in(spark, root, ev.schema), "ts"), "ts",
                        f"{osql.LATE_DELAY_DAYS} days", ["event_id"])
        return append_stream(out, f"{root}/out", f"{root}/ck")

    _arrive_in_order(ev, root, [(day >= lo) & (day <= hi) for lo, hi in osql.LATE_CUTS], run)
    return spark.read.parquet(f"{root}/out").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# ------------------------------------------------------------------------------ column helpers
from stratum.functions import columns as colf  # noqa: E402


def _people(spark, sf_dir):
    return fx.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ID"), F.col("c_name").alias("First_Name"),
        F.col("c_mktsegment").alias("Last_Name"), F.col("c_nationkey").alias("Age"))


@register("cols_lower", osql.COLS_LOWER)
def q_cols_lower(spark, sf_dir):
    return colf.lowercase_all_column_names(_people(spark, sf_dir))


@register("cols_upper", osql.COLS_UPPER)
def q_cols_upper(spark, sf_dir):
    return colf.uppercase_all_column_names(_people(spark, sf_dir))


@register("add_metadata", osql.ADD_METADATA)
def q_add_metadata(spark, sf_dir):
    return colf.add_metadata(colf.lowercase_all_column_names(_people(spark, sf_dir)),
                             {"task_id": 1,
                              "ingested_at": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")})


# ------------------------------------------------------------------------------------ layout
from stratum.operators import layout  # noqa: E402


@register("partitioned_roundtrip", "SELECT * FROM events")
def q_partitioned_roundtrip(spark, sf_dir):
    from stratum.session import scratch_dir
    from stratum.sources.catalog import overwrite_table, read_partitioned
    ev = fx.table(spark, sf_dir, "events")
    path = scratch_dir(spark, "partitioned") + "/events"
    overwrite_table(ev, path, ["event_type"])
    return read_partitioned(spark, path, ev.schema)


@register("register_table", "SELECT * FROM events")
def q_register_table(spark, sf_dir):
    import uuid
    from stratum.session import scratch_dir
    from stratum.sources.catalog import overwrite_table, register_table
    ev = fx.table(spark, sf_dir, "events")
    path = scratch_dir(spark, "registered") + "/events"
    name = f"stratum_events_{uuid.uuid4().hex[:8]}"
    assert not register_table(spark, name, path)      # nothing committed yet: not registered
    overwrite_table(ev, path)
    assert register_table(spark, name, path)
    return spark.table(name)


def _zordered(spark, sf_dir):
    from stratum.session import scratch_dir
    path = scratch_dir(spark, "zorder") + "/events"
    ev = fx.table(spark, sf_dir, "events")
    layout.cluster_by_zorder(ev, ["user_id", "value"]).write.parquet(path)
    return spark.read.parquet(path)


@register("zorder_rows", "SELECT * FROM events")
def q_zorder_rows(spark, sf_dir):
    return _zordered(spark, sf_dir)


@register("compact_rows", "SELECT * FROM events")
def q_compact_rows(spark, sf_dir):
    """Many small files rewritten as evenly sized ones; the rows are unchanged."""
    from stratum.session import scratch_dir
    root = scratch_dir(spark, "compact")
    ev = fx.table(spark, sf_dir, "events")
    ev.repartition(64).write.parquet(f"{root}/small")
    layout.compact(spark.read.parquet(f"{root}/small")).write.parquet(f"{root}/compacted")
    return spark.read.parquet(f"{root}/compacted")


@register("file_report")
def q_file_report(spark, sf_dir):
    return layout.table_files(_zordered(spark, sf_dir))


@register("file_report_total", "SELECT CAST(count(*) AS BIGINT) AS rows, TRUE AS all_files_have_bytes FROM events")
def q_file_report_total(spark, sf_dir):
    return layout.table_files(_zordered(spark, sf_dir)).agg(
        F.sum("rows").alias("rows"), F.every(F.col("bytes") > 0).alias("all_files_have_bytes"))


@register("zorder_overlap")
def q_zorder_overlap(spark, sf_dir):
    """Files a point predicate on each clustered column must open, after Z-ordering."""
    stats = layout.file_stats(_zordered(spark, sf_dir), ["user_id", "value"])
    probe = fx.table(spark, sf_dir, "events").agg(F.percentile_approx("user_id", 0.5).alias("user_id"),
                                                  F.percentile_approx("value", 0.5).alias("value"))
    has = lambda c: F.count_if(F.col(c).between(F.col(f"min_{c}"), F.col(f"max_{c}")))
    both = stats.join(F.broadcast(probe)).agg(F.count(F.lit(1)).alias("files"), has("user_id").alias("u"), has("value").alias("v"))
    return both.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), "files", F.col(n).alias("files_to_read"))
                                           for c, n in (("user_id", "u"), ("value", "v"))])).alias("r")).select("r.*")


from stratum.plans import incremental  # noqa: E402,F401  (registers its queries)
