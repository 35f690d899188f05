"""Queries of the incremental side: the keyed retail target by appended changes, sums by signed differences,
late rows split by a carried maximum, streams that join refreshed lookups, rule metrics as rows, skipping
of files by text, upserts of growing schemas, hours by UTC instant. Each lands a feed derived from the driver
tables in several deliveries and runs the streams once per delivery.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators import aggregates as agg
from stratum.operators import layout
from stratum.plans import fixtures as fx
from stratum.plans import iot, retail, voltage
from stratum.plans import oracle as osql
from stratum.plans.registry import _iot_csv, _lookup, _round, _stream_in, register
from stratum.session import freed_shuffles, scratch_dir
from stratum.sources.catalog import delete_folder

# ------------------------------------------------------------------------------------ retail
#: Arrival years of the deliveries, newest first: older rows arrive late.
RETAIL_DELIVERIES = [(1997, 9999), (1995, 1996), (0, 1994)]
_RUNS: dict[tuple, object] = {}


def _incremental_retail(spark: SparkSession, sf_dir: str):
    """The retail graph run once per delivery; the second delivery holds the first one again. The tables are
    kept for the session, as several queries show their nodes; what is landed for them goes once it is read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        root = scratch_dir(spark, "retail_incremental")
        number = F.coalesce(*[F.when(F.col("arrival").between(low, high), i) for i, (low, high) in enumerate(RETAIL_DELIVERIES)])
        feed = fx.retail_src(spark, sf_dir).withColumn("delivery", number).drop("arrival")
        with freed_shuffles(spark):
            feed.write.option("compression", retail.CODEC).partitionBy("delivery").parquet(f"{root}/feed")
        prefix = "retail_inc_" + root.rsplit("-", 1)[-1]
        for i in range(len(RETAIL_DELIVERIES)):
            parts = [0, 1] if i == 1 else [i]
            rows = spark.read.schema(feed.schema).parquet(f"{root}/feed").filter(F.col("delivery").isin(parts))
            fx.write_retail_csv(rows.select(*fx.RETAIL_CSV_COLUMNS), f"{root}/csv/delivery={i}")
            for p in parts if i else []:        # not delivered again
                delete_folder(spark, f"{root}/feed/delivery={p}")
            tables = retail.run_retail(spark, f"{root}/csv", root, prefix, keep_hours=0,
                                       landed=partial(delete_folder, spark, f"{root}/csv/delivery={i}"))
        _RUNS[key] = tables
    return _RUNS[key]


@register("retail_changes_target", osql.RETAIL_LATEST)
def q_retail_changes_target(spark, sf_dir):
    """The keyed target after three deliveries (one of them repeated), by merge on read."""
    return _incremental_retail(spark, sf_dir).read(spark, "retail_sales_all_countries")


@register("retail_kept_by_day", osql.RETAIL_SALES_BY_DAY)
def q_retail_kept_by_day(spark, sf_dir):
    return _round(_incremental_retail(spark, sf_dir).read(spark, "sales_by_day"), ["TotalSales"])


@register("retail_kept_by_country", f"""
SELECT Country, ROUND(SUM(Quantity), 4) AS TotalSales FROM ({osql.RETAIL_LATEST}) GROUP BY Country""")
def q_retail_kept_by_country(spark, sf_dir):
    return _round(_incremental_retail(spark, sf_dir).read(spark, "sales_by_country"), ["TotalSales"])


@register("retail_kept_top_customers", osql.RETAIL_TOP_CUSTOMERS)
def q_retail_kept_top_customers(spark, sf_dir):
    return _round(_incremental_retail(spark, sf_dir).read(spark, "top_ten_customers"), ["TotalSales"])


@register("retail_kept_countries", osql.RETAIL_COUNTRIES)
def q_retail_kept_countries(spark, sf_dir):
    return _incremental_retail(spark, sf_dir).read(spark, "distinct_countries_retail")


_RULES_SQL = {"has_customer": "CustomerID IS NOT NULL", "has_invoice": "InvoiceNo IS NOT NULL",
              "valid_date_time": "InvoiceDatetime IS NOT NULL"}


@register("rule_metrics", f"""
WITH r AS (SELECT *, CASE {" ".join(f"WHEN arrival BETWEEN {lo} AND {hi} THEN {i}" for i, (lo, hi) in enumerate(RETAIL_DELIVERIES))} END AS batch_id
           FROM ({osql.RETAIL_SHAPED}))
""" + " UNION ALL ".join(f"""
SELECT '{k}' AS rule, CAST(batch_id AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE NOT ({p})) AS BIGINT) AS violations FROM r GROUP BY batch_id""" for k, p in _RULES_SQL.items()))
def q_rule_metrics(spark, sf_dir):
    """Violations of each rule in each micro-batch of the declared quality dataset, from the observed metrics."""
    from stratum.streaming.datasets import Dataset, rule_metrics, streaming_table
    root = scratch_dir(spark, "rule_metrics")
    fx.retail_src(spark, sf_dir).write.parquet(f"{root}/feed")
    feed = spark.read.parquet(f"{root}/feed")
    ds = Dataset("rule_metrics_" + root.rsplit("-", 1)[-1], f"{root}/quality", drop_rules=retail.QUALITY_RULES)
    cleaned = feed.drop("arrival")
    for i, (low, high) in enumerate(RETAIL_DELIVERIES):
        feed.filter(F.col("arrival").between(low, high)).drop("arrival").write.parquet(f"{root}/in/f{i:03d}")
        streaming_table(spark, ds, retail.shape_retail(_stream_in(spark, root, cleaned.schema)), f"{root}/ck")
    return rule_metrics(spark, ds).drop("dataset")


# ------------------------------------------------------------------------------- late rows
_SPLIT = f"""
WITH c AS (SELECT event_id, ts, CASE {" ".join(f"WHEN dayofmonth(ts) BETWEEN {lo} AND {hi} THEN {p}" for p, (lo, hi) in enumerate(osql.LATE_CUTS))} END AS batch
           FROM events),
m AS (SELECT batch, max(ts) AS mx FROM c GROUP BY batch),
w AS (SELECT a.batch, (SELECT max(b.mx) FROM m b WHERE b.batch < a.batch) - INTERVAL {osql.LATE_DELAY_DAYS} DAY AS mark FROM m a),
s AS (SELECT c.*, coalesce(ts < mark, FALSE) AS late FROM c JOIN w USING (batch))"""


def _late_split(spark, sf_dir):
    from stratum.streaming.late import LateSplit
    root = scratch_dir(spark, "late_split")
    ev = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    split = LateSplit(spark, f"{root}/out", "ts", f"{osql.LATE_DELAY_DAYS} days")
    day = F.dayofmonth("ts")
    for i, (low, high) in enumerate(osql.LATE_CUTS):
        ev.filter(day.between(low, high)).write.parquet(f"{root}/in/f{i:03d}")
        split.run(_stream_in(spark, root, ev.schema), f"{root}/ck")
    return split


@register("late_split", _SPLIT + " SELECT event_id, ts, late FROM s")
def q_late_split(spark, sf_dir):
    """Every event once, in the kept table or its side table, as the carried maximum has it."""
    split = _late_split(spark, sf_dir)
    both = split.kept().withColumn("late", F.lit(False)).unionByName(split.side().withColumn("late", F.lit(True)))
    return both.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "late")


@register("late_split_counts", _SPLIT + """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE late) AS BIGINT) AS late, max(ts) AS max_ts FROM s GROUP BY batch""")
def q_late_split_counts(spark, sf_dir):
    """Rows, late rows and largest event time of each micro-batch, as observed."""
    return _late_split(spark, sf_dir).metrics().filter("rows > 0") \
        .select("rows", "late", F.col("max_ts").cast("timestamp_ntz").alias("max_ts"))


# ------------------------------------------------------------------------ streams with lookups
#: The event type whose alert code the lookup lists only from the second run on.
LATE_CODE = "signup"


def _two_branches(spark, sf_dir):
    """Bronze in deliveries, flattened by a stream of its own, so that bodies are parsed once for both branches;
    from that a history and an enriched stream, whose lookup grows after the first run."""
    from stratum.sources.files import stream_table
    from stratum.streaming.enrich import Branch, run_branches
    from stratum.streaming.sinks import append_stream
    root = scratch_dir(spark, "stream_enriched")
    env = fx.alerts_envelope(spark, sf_dir)
    bronze = voltage.bronze(env, keep=["delivery"], dealt=True)
    bronze.write.partitionBy("delivery").parquet(f"{root}/all")
    stored = spark.read.schema(bronze.schema).parquet(f"{root}/all")
    deliveries = sorted(r[0] for r in stored.select("delivery").distinct().collect())
    whole, conn = _lookup(spark, sf_dir), fx.connectivity(spark, sf_dir)
    late = fx.ALERT_CODES[LATE_CODE]
    schema = bronze.drop("delivery").schema
    flat = voltage.flattened(bronze.drop("delivery")).schema
    for d in deliveries:
        stored.filter(F.col("delivery") == d).drop("delivery").write.mode("append").parquet(f"{root}/bronze")
        lookup = (lambda: whole.filter(F.col("alert_code") != late)) if d == deliveries[0] else (lambda: whole)
        append_stream(voltage.flattened(stream_table(spark, f"{root}/bronze", schema)), f"{root}/flat",
                      f"{root}/ck/flat").awaitTermination()
        run_branches(spark, f"{root}/flat", flat, [
            Branch("history", f"{root}/history", lambda f: f, {}, voltage.GOLD_PARTITION_BY),
            Branch("enriched", f"{root}/enriched", voltage.enriched,
                   {"lookup": lookup, "connectivity": lambda: conn})], f"{root}/ck")
    return root, flat


@register("stream_history", osql.FLATTEN)
def q_stream_history(spark, sf_dir):
    """The first branch: flattened alerts appended, partitioned by event date."""
    root, schema = _two_branches(spark, sf_dir)
    return spark.read.schema(schema).parquet(f"{root}/history").select(*schema.fieldNames())


@register("stream_enriched", f"""
SELECT f.* EXCLUDE (delivery), l.alert_desc, l.alert_type, l.final_alert_desc, l.phase, l.phase_number,
       c.customer_name, c.segment, c.nation_key, {osql._DNO.replace('mpan', 'f.mpan')} AS dno
FROM ({osql._FLAT_BASE}) f JOIN ({osql.LOOKUP}) l ON f.alert_code = l.alert_code
LEFT JOIN ({osql.CONNECTIVITY}) c ON f.mpan = c.mpan
WHERE f.delivery > 0 OR f.alert_code <> '{fx.ALERT_CODES[LATE_CODE]}'""")
def q_stream_enriched(spark, sf_dir):
    """The second branch: alerts joined with the lookup as it was when they came."""
    return spark.read.parquet(f"{_two_branches(spark, sf_dir)[0]}/enriched")


# ------------------------------------------------------------------------------- complete tables
@register("iot_gold_kept", osql.IOT_GOLD)
def q_iot_gold_kept(spark, sf_dir):
    """Average weight per gender over all readings so far, by kept sums, published as a snapshot after
    each run of the silver stream."""
    from stratum.sources.files import infer_schema
    from stratum.streaming.buckets import ChangeTable, KeptSums
    from stratum.streaming.snapshots import Snapshots
    from stratum.streaming.sinks import append_stream
    root, csv = _iot_csv(spark, sf_dir)
    schema = infer_schema(spark, csv, "csv")
    append_stream(iot.bronze_stream(spark, csv, schema), f"{root}/bronze", f"{root}/ck_bronze").awaitTermination()
    bronze = spark.read.parquet(f"{root}/bronze")
    gold = Snapshots(spark, f"{root}/gold")
    target = ChangeTable(spark, f"{root}/silver", bronze.schema, ["id"], "timestamp")
    sums = KeptSums(spark, f"{root}/sums", {"gender": F.col("gender")}, F.col("weight"), {"gender": "string"})
    for half in (0, 1):
        bronze.filter(F.pmod(F.xxhash64("id"), F.lit(2)) == half).write.parquet(f"{root}/in/f{half}")
        target.append(iot.silver(_stream_in(spark, root, bronze.schema)), f"{root}/ck_silver")
        version = target.compact()
        if version is not None:
            sums.apply(target.deltas(version), version)
        gold.publish(sums.stored.read().filter("_rows > 0").select(
            "gender", (F.col("_sum").cast("double") / F.col("_values")).alias("avg_weight")))
    return _round(gold.read(), ["avg_weight"])


# ------------------------------------------------------------------------------- layout
URL_FILES = 16


@register("url_skipping", f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT url) AS BIGINT) AS urls, TRUE AS one_file_a_url FROM pages WHERE url IS NOT NULL""")
def q_url_skipping(spark, sf_dir):
    """Pages range-clustered by whole urls, which share long beginnings: how many files an equality
    predicate has to open, over all urls (on average two at most, as a range may end inside one)."""
    path = scratch_dir(spark, "url_skipping") + "/pages"
    pages = fx.table(spark, sf_dir, "pages").select("page_id", "url")
    layout.cluster_by_zorder(pages, ["url"], files=URL_FILES).write.parquet(path)
    stored = spark.read.parquet(path)
    stats = layout.file_stats(stored, ["url"])
    urls = stored.filter(F.col("url").isNotNull()).groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    opened = urls.join(stats, F.col("url").between(F.col("min_url"), F.col("max_url"))) \
        .groupBy("url").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("files"))
    return opened.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("urls"),
                      (F.avg("files") <= 2).alias("one_file_a_url"))


@register("clustered_dataset", osql.RETAIL_QUALITY)
def q_clustered_dataset(spark, sf_dir):
    """The quality dataset declared with clustering columns, in deliveries: each run's rows are laid out by
    customer and time, earlier runs' files stay as they are."""
    from stratum.streaming.datasets import Dataset, streaming_table
    root = scratch_dir(spark, "clustered")
    fx.retail_src(spark, sf_dir).write.parquet(f"{root}/feed")
    feed = spark.read.parquet(f"{root}/feed")
    cleaned = feed.drop("arrival")
    ds = Dataset("clustered_" + root.rsplit("-", 1)[-1], f"{root}/quality", drop_rules=retail.QUALITY_RULES,
                 cluster_by=["CustomerID", "InvoiceDatetime"])
    for i, (low, high) in enumerate(RETAIL_DELIVERIES):
        feed.filter(F.col("arrival").between(low, high)).drop("arrival").write.parquet(f"{root}/in/f{i:03d}")
        streaming_table(spark, ds, retail.shape_retail(_stream_in(spark, root, cleaned.schema)), f"{root}/ck")
    return spark.read.parquet(ds.path).select(*retail.QUALITY_COLUMNS)


@register("file_stats_bounds", """
SELECT CAST(count(*) AS BIGINT) AS rows, min(user_id) AS min_user_id, max(user_id) AS max_user_id,
       min(value) AS min_value, max(value) AS max_value, TRUE AS each_file_named FROM events""")
def q_file_stats_bounds(spark, sf_dir):
    """The per-file bounds of a Z-ordered table, together: they cover the whole table and every file."""
    path = scratch_dir(spark, "file_stats") + "/events"
    layout.cluster_by_zorder(fx.table(spark, sf_dir, "events"), ["user_id", "value"], files=8).write.parquet(path)
    stored = spark.read.parquet(path)
    stats = layout.file_stats(stored, ["user_id", "value"])
    return stats.agg(F.sum("rows").alias("rows"), F.min("min_user_id").alias("min_user_id"), F.max("max_user_id").alias("max_user_id"),
                     F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
                     (F.count_distinct("file") == F.lit(len(stored.inputFiles()))).alias("each_file_named"))


# ------------------------------------------------------------------------------- upserts
@register("upsert_evolved", """
WITH b AS (SELECT *, (dayofmonth(ts) - 1) // 10 AS blk FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY blk DESC, ts DESC, event_id DESC) AS n FROM b)
SELECT user_id, event_type, ts, CAST(event_id AS BIGINT) AS event_id, CASE WHEN blk >= 1 THEN value END AS reading FROM r WHERE n = 1""")
def q_upsert_evolved(spark, sf_dir):
    """Batches merged into a stored target whose schema grows: the first batch has a narrow id and no
    reading, later ones a wide id and the new column; rows of the first one have NULL there."""
    from stratum.streaming.upsert import UpsertTable
    root = scratch_dir(spark, "upsert_evolved")
    ev = fx.table(spark, sf_dir, "events")
    blk = ((F.dayofmonth("ts") - 1) / 10).cast("int")
    base = ev.select("user_id", "event_type", "ts", F.col("event_id").cast("int").alias("event_id"))
    table = UpsertTable(spark, f"{root}/view", ["user_id", "event_type"], base.schema, sink_id="evolved", on_multiple="latest",
                        sequence_by=["ts", "event_id"])
    for b in sorted(r[0] for r in ev.select(blk.alias("b")).distinct().collect()):
        batch = base if b == 0 else ev.select("user_id", "event_type", "ts", F.col("event_id").cast("long").alias("event_id"),
                                              F.col("value").alias("reading"))
        table.merge_batch(batch.filter(blk == b), int(b))
    return table.read()


# ------------------------------------------------------------------------------- hours
#: Days by which the events (January) are moved so that they span the autumn clock change of London.
MOVED_DAYS = 288


@register("recon_utc_hours", f"""
SELECT date_trunc('hour', ts + INTERVAL {MOVED_DAYS} DAY) AS utc_start,
       timezone('Europe/London', timezone('UTC', date_trunc('hour', ts + INTERVAL {MOVED_DAYS} DAY))) AS local_start,
       CAST(epoch(timezone('Europe/London', timezone('UTC', date_trunc('hour', ts + INTERVAL {MOVED_DAYS} DAY))))
            - epoch(date_trunc('hour', ts + INTERVAL {MOVED_DAYS} DAY)) AS INT) // 60 AS offset_minutes,
       CAST(count(*) AS BIGINT) AS count FROM events GROUP BY 1, 2, 3""")
def q_recon_utc_hours(spark, sf_dir):
    """Hourly counts across a clock change: the repeated local hour is two rows."""
    moved = fx.table(spark, sf_dir, "events").select(
        (F.col("ts").cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(MOVED_DAYS))).alias("ts"))
    return agg.count_by_local_hour(moved, "ts", "Europe/London")
