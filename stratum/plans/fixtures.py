"""Source feeds derived from the driver tables (one function per feed).

The driver tables hold no nulls and no text formats, so each feed re-expresses a table in the
shape a medallion flow ingests (CSV lines, message envelopes with XML bodies, nested JSON) and
injects its edge rows by fixed modulo rules on the table's own ids. Every feed is a Spark
transformation of the tables, so its size grows with theirs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import freed_shuffles
from stratum.sources.files import redistribute

# Edge-row rules of the derived feeds (modulo of the named id column).
RETAIL_NULL_INVOICE_MOD = 29      # l_orderkey  -> InvoiceNo NULL
RETAIL_NULL_CUSTOMER_MOD = 17     # o_custkey   -> CustomerID NULL
RETAIL_NULL_DATE_MOD = 31         # l_partkey   -> InvoiceDate NULL
RETAIL_BAD_DATE_MOD = 23          # l_partkey   -> InvoiceDate 'bad date'
ALERT_SECOND_EVENT_MOD = 11       # event_id    -> message carries a second Event
ALERT_SECOND_READING_MOD = 19     # event_id    -> message carries a reading of the next meter too
ALERT_NO_EVENT_MOD = 59           # event_id    -> first reading carries no Event
ALERT_LATE_MOD = 67               # event_id    -> message delivered one batch late
ALERT_FIVE_ARGS_MOD = 13          # event_id    -> sixth argument missing (no alert code)
ALERT_NO_MILLIS_MOD = 53          # event_id    -> event time written without millis
ALERT_MALFORMED_MOD = 97          # event_id    -> body cut short (malformed XML)
ALERT_REPLAY_MOD = 20             # event_id    -> message delivered twice (exact copy)
ALERT_EVENT_LAG_MOD = 600         # event time = receive time - (event_id % 600) s
CONNECTED_CUSTOMER_MOD = 3        # c_custkey   -> present in the connectivity table
JSON_NULL_ID_MOD = 37             # event_id    -> table_id missing
JSON_EXTRA_FIELD_USER_MOD = 10    # user_id     -> late records carry an undeclared field
JSON_EMPTY_ARRAY_USER_MOD = 25    # user_id % 25 = 1 -> one extra record with an empty array
JSON_RECORD_ID_BLOCK = 64         # at most 64 events per JSON record
IOT_NULL_WEIGHT_MOD = 41          # event_id    -> weight NULL
IOT_NULL_GENDER_MOD = 43          # event_id    -> gender NULL

# Event type -> alert code (6th argument). The lookup lists the first four.
ALERT_CODES = {"click": "1A01", "view": "1A02", "purchase": "2B01", "signup": "2B02", "error": "3C01"}
LOOKUP_EVENT_TYPES = ["click", "view", "purchase", "signup"]
# Mpan prefix by id % 4 (12 -> LPN, 19 -> SPN, 10 -> EPN, 99 -> Others).
MPAN_PREFIXES = ["12", "19", "10", "99"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _mpan(id_col: Column) -> Column:
    prefix = F.element_at(F.array(*[F.lit(p) for p in MPAN_PREFIXES]), (id_col % 4 + 1).cast("int"))
    return F.concat(prefix, F.lpad(id_col.cast("string"), 11, "0"))


# ---------------------------------------------------------------------------------------------
# Retail: order lines as invoice lines

def retail_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ nation (⟕ part) as retail CSV columns + arrival year."""
    # a narrow scan is dealt out by its few columns, before the texts are made
    li = redistribute(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                              "l_extendedprice", "l_shipdate"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    # the orders get their countries first: the many lines are then shuffled by order and part, not by customer too
    placed = (o.join(c.join(n, c.c_nationkey == n.n_nationkey), o.o_custkey == c.c_custkey)
               .select("o_orderkey", "o_custkey", "n_name"))
    j = (li.join(placed, li.l_orderkey == placed.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey, "left"))
    ship = F.col("l_shipdate")
    text = invoice_text(ship)
    pk = F.col("l_partkey")
    return j.select(
        F.when(F.col("l_orderkey") % RETAIL_NULL_INVOICE_MOD != 0,
               F.col("l_orderkey").cast("string")).alias("InvoiceNo"),
        pk.cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.col("l_quantity").cast("float").alias("Quantity"),
        F.when(pk % RETAIL_NULL_DATE_MOD == 0, F.lit(None).cast("string"))
         .when(pk % RETAIL_BAD_DATE_MOD == 0, F.lit("bad date"))
         .otherwise(text).alias("InvoiceDate"),
        F.col("l_extendedprice").cast("float").alias("UnitPrice"),
        F.when(F.col("o_custkey") % RETAIL_NULL_CUSTOMER_MOD != 0,
               F.col("o_custkey").cast("string")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
        F.year(ship).alias("arrival"),
    )


def invoice_text(ts: Column) -> Column:
    """'M/d/yy H:mm' from 2000 on, 'M/d/yyyy H:mm' before (a 2-digit year would pad to 20yy).

    Built from the date parts with integer arithmetic, not a date formatter: the text is rebuilt
    for every row of the feed, and the quality rules evaluate it again inside pushed-down filters.
    """
    y = F.year(ts)
    year = F.when(y >= 2000, F.lpad((y % 100).cast("string"), 2, "0")).otherwise(y.cast("string"))
    return F.concat(F.month(ts).cast("string"), F.lit("/"), F.dayofmonth(ts).cast("string"), F.lit("/"),
                    year, F.lit(" "), F.hour(ts).cast("string"), F.lit(":"),
                    F.lpad(F.minute(ts).cast("string"), 2, "0"))


RETAIL_CSV_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate",
                      "UnitPrice", "CustomerID", "Country"]
# The declared DDL schema of the retail CSV feed.
RETAIL_DDL = ("InvoiceNo STRING, StockCode STRING, Description STRING, Quantity FLOAT, "
              "InvoiceDate STRING, UnitPrice FLOAT, CustomerID STRING, Country STRING")


def land_retail_csv(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the retail feed as CSV files, one folder per arrival year (one Spark job)."""
    path = f"{root}/retail_csv"
    # no shuffle by the partition column: every task writes its rows to the few year folders, so
    # one year never lands in a single task and the folders keep one file per writing task
    with freed_shuffles(spark):
        write_retail_csv(retail_src(spark, sf_dir).select(*RETAIL_CSV_COLUMNS, "arrival"), path, ["arrival"])
    return path


def write_retail_csv(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Packed CSV files with a header. One task reads a packed file whole, so each holds a million rows at most."""
    rows.write.mode("overwrite").partitionBy(*partition_by).option("maxRecordsPerFile", 1_000_000) \
        .option("zlib.compress.level", "BEST_SPEED").csv(path, header=True, compression="gzip")


# ---------------------------------------------------------------------------------------------
# Voltage alerts: events as message-bus envelopes with XML bodies

def _arguments(values: list[Column]) -> Column:
    return F.concat(*[F.concat(F.lit("<argument><value>"), v, F.lit("</value></argument>")) for v in values])


def _reading(uid: Column, events: Column) -> Column:
    return F.concat(
        F.lit("<MeterReading><Meter><mRID>"), F.concat(F.lit("M"), F.lpad(uid.cast("string"), 8, "0")),
        F.lit("</mRID></Meter><ServiceDeliveryPoint><mRID>"), _mpan(uid), F.lit("</mRID></ServiceDeliveryPoint>"),
        events, F.lit("</MeterReading>"))


def alert_body(ev: DataFrame) -> Column:
    """The XML body text of the message for one event row."""
    eid, uid = F.col("event_id"), F.col("user_id")
    code = F.element_at(F.create_map(*[F.lit(x) for kv in ALERT_CODES.items() for x in kv]),
                        F.col("event_type"))
    lag = F.make_dt_interval(secs=(eid % ALERT_EVENT_LAG_MOD).cast("decimal(18,6)"))
    ev_ts = F.col("ts") - lag
    ev_text = F.when(eid % ALERT_NO_MILLIS_MOD == 0, F.date_format(ev_ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")) \
               .otherwise(_iso_millis(ev_ts))
    five = [F.lit(f"a{i}") for i in range(1, 6)]
    args = F.when(eid % ALERT_FIVE_ARGS_MOD == 0, _arguments(five)).otherwise(_arguments(five + [code]))
    event1 = F.concat(F.lit("<Event><timestamp>"), ev_text, F.lit("</timestamp>"), args, F.lit("</Event>"))
    ev2_text = _iso_millis(ev_ts + F.make_dt_interval(secs=F.lit(1)))
    event2 = F.when(eid % ALERT_SECOND_EVENT_MOD == 0,
                    F.concat(F.lit("<Event><timestamp>"), ev2_text, F.lit("</timestamp>"),
                             _arguments(five + [code]), F.lit("</Event>"))).otherwise(F.lit(""))
    events = F.when(eid % ALERT_NO_EVENT_MOD == 0, F.lit("")).otherwise(F.concat(event1, event2))
    event3 = F.concat(F.lit("<Event><timestamp>"), _iso_millis(ev_ts + F.make_dt_interval(secs=F.lit(2))),
                      F.lit("</timestamp>"), _arguments(five + [code]), F.lit("</Event>"))
    second = F.when(eid % ALERT_SECOND_READING_MOD == 0, _reading(uid + 1, event3)).otherwise(F.lit(""))
    end_text = _iso_millis(F.col("ts") + F.make_dt_interval(mins=F.lit(15)))
    xml = F.concat(
        F.lit("<Envelope><Body><MeterReadsReplyMessage><payload>"), _reading(uid, events), second,
        F.lit("<endTime>"), end_text,
        F.lit("</endTime></payload></MeterReadsReplyMessage></Body></Envelope>"))
    return F.when(eid % ALERT_MALFORMED_MOD == 0, F.substring(xml, 1, 120)).otherwise(xml)


ALERT_DELIVERY_DAYS = 10          # deliveries (micro-batches) cover 10 days of receive time


def alerts_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as (offset string, enqueuedTime, body binary, delivery).

    ``delivery`` numbers the micro-batch a message arrives in (by 10-day blocks of receive time; late
    messages in the next one);
    a replayed message is an exact copy delivered again in the next batch.
    """
    # a narrow scan is dealt out by its few columns, before the long bodies are made
    ev = redistribute(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"))
    late = (F.col("event_id") % ALERT_LATE_MOD == 0).cast("int")
    delivery = ((F.dayofmonth("ts") - 1) / ALERT_DELIVERY_DAYS).cast("int") + late
    replayed = F.col("event_id") % ALERT_REPLAY_MOD == 0
    ev = ev.withColumn("delivery", F.explode(F.when(replayed, F.array(delivery, delivery + 1)).otherwise(F.array(delivery))))
    return ev.select(F.col("event_id").cast("string").alias("offset"),
                     F.col("ts").alias("enqueuedTime"),
                     F.encode(alert_body(ev), "UTF-8").alias("body"),
                     "delivery")


# Header of the alert-code lookup CSV (names with spaces, as delivered).
LOOKUP_HEADER = ["Alert Code", "DESC_TEXT", "Alert Type", "Final Desc", "Phase", "Phase Number"]


def alert_lookup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert-code lookup, one row per event type in LOOKUP_EVENT_TYPES present in events."""
    types = (table(spark, sf_dir, "events").select("event_type").distinct()
             .filter(F.col("event_type").isin(LOOKUP_EVENT_TYPES)))
    et = F.col("event_type")
    code = F.element_at(F.create_map(*[F.lit(x) for kv in ALERT_CODES.items() for x in kv]), et)
    phase_no = (F.length(et) % 3 + 1).cast("string")
    return types.select(F.concat(F.lit("0x"), code).alias("Alert Code"),
                        F.concat(F.lit("Alert "), et).alias("DESC_TEXT"),
                        F.upper(et).alias("Alert Type"),
                        F.concat(et, F.lit(" alert")).alias("Final Desc"),
                        F.concat(F.lit("L"), phase_no).alias("Phase"),
                        phase_no.alias("Phase Number"))


def land_alert_lookup(spark: SparkSession, sf_dir: str, root: str) -> str:
    path = f"{root}/alertcodes_lookup"
    # one file: the lookup holds one row per alert code (bounded by the code list)
    alert_lookup_rows(spark, sf_dir).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def connectivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer connectivity: connected customers keyed by mpan."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % CONNECTED_CUSTOMER_MOD == 0)
    return c.select(_mpan(F.col("c_custkey")).alias("mpan"), F.col("c_name").alias("customer_name"),
                    F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation_key"))


# ---------------------------------------------------------------------------------------------
# JSON template: events packed as nested records

def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """{data:{field:[{table_id, other_column, last_reported}]}, last_updated[, source_system]} text,
    plus ``late`` (records from day 16 on, the only ones that may carry the undeclared field)."""
    ev = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    last_updated = (F.unix_timestamp(F.date_add(day, 1).cast("timestamp_ntz"))
                    + (F.col("user_id") % 3) * 43200)
    item = F.struct(F.when(F.col("event_id") % JSON_NULL_ID_MOD != 0,
                           F.col("event_id").cast("string")).alias("table_id"),
                    F.col("event_type").alias("other_column"),
                    F.unix_timestamp("ts").alias("last_reported"))
    late = F.dayofmonth(day) >= 16
    grouped = (ev.groupBy("user_id", day.alias("day"), (F.col("event_id") / JSON_RECORD_ID_BLOCK).cast("long").alias("blk"))
                 .agg(F.collect_list(item).alias("field"), F.first(last_updated).alias("last_updated"),
                      F.first(late).alias("late")))
    extra = F.when(F.col("late") & (F.col("user_id") % JSON_EXTRA_FIELD_USER_MOD == 0),
                   F.concat(F.lit("legacy-"), F.col("user_id").cast("string")))
    recs = grouped.select(F.to_json(F.struct(F.struct("field").alias("data"), "last_updated",
                                             extra.alias("source_system"))).alias("value"), "late")
    empties = (ev.filter(F.col("user_id") % JSON_EMPTY_ARRAY_USER_MOD == 1).groupBy("user_id")
                 .agg(F.max(F.unix_timestamp("ts")).alias("last_updated"))
                 .select(F.to_json(F.struct(F.struct(F.array().cast("array<struct<table_id:string,other_column:string,last_reported:bigint>>").alias("field")).alias("data"),
                                            "last_updated")).alias("value"), F.lit(True).alias("late")))
    return recs.unionByName(empties)


def land_json(spark: SparkSession, sf_dir: str, root: str) -> str:
    """JSON lines in two folders: early/ (schema sample) and late/ (may hold undeclared fields)."""
    path = f"{root}/json_raw"
    recs = json_records(spark, sf_dir)
    recs.write.mode("overwrite").partitionBy("late").text(path)
    return path


def other_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second JSON feed for change application: {data:{stuff:[{a,b}...]}, table_id, last_updated}."""
    ev = table(spark, sf_dir, "events")
    first = F.struct(F.col("user_id").cast("string").alias("a"), F.col("event_type").alias("b"))
    second = F.struct(F.col("user_id").cast("string").alias("a"), F.concat(F.col("event_type"), F.lit("_2")).alias("b"))
    stuff = F.when(F.col("event_id") % ALERT_SECOND_EVENT_MOD == 0, F.array(first, second)).otherwise(F.array(first))
    return ev.select(F.to_json(F.struct(F.struct(stuff.alias("stuff")).alias("data"),
                                        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("table_id"),
                                        F.unix_timestamp("ts").alias("last_updated"))).alias("value"))


# ---------------------------------------------------------------------------------------------
# IoT users

def iot_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User readings: userid, gender, age, height, weight, smoker (+ event time for late-data tests)."""
    ev = table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    return ev.select(
        uid.cast("int").alias("userid"),
        F.when(eid % IOT_NULL_GENDER_MOD != 0, F.col("event_type")).alias("gender"),
        (F.lit(18) + uid % 60).cast("int").alias("age"),
        (F.lit(150) + uid % 50).cast("int").alias("height"),
        F.when(eid % IOT_NULL_WEIGHT_MOD != 0, F.col("value")).alias("weight"),
        F.when(uid % 2 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("smoker"),
        F.col("ts").alias("event_ts"),
    )


IOT_CSV_COLUMNS = ["userid", "gender", "age", "height", "weight", "smoker"]


def land_iot_csv(spark: SparkSession, sf_dir: str, root: str) -> str:
    """The readings as CSV files sized by AQE (rebalance), so the file count grows with the data."""
    path = f"{root}/iot_csv"
    (iot_src(spark, sf_dir).select(*IOT_CSV_COLUMNS).hint("rebalance")
        .write.mode("overwrite").option("header", True).csv(path))
    return path
