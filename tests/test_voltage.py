import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.functions.xml import flatten_alerts, malformed_alerts
from stratum.operators.joins import with_region
from stratum.plans import voltage
from stratum.sources.envelope import ingest_envelope

ENV_SCHEMA = "offset string, enqueuedTime timestamp_ntz, body binary"


def _env(spark, rows):
    return spark.createDataFrame([(o, t, b.encode() if b is not None else None) for o, t, b in rows], ENV_SCHEMA)


def test_envelope_summer_winter_and_week_year(spark):
    rows = [("1", dt.datetime(2024, 7, 1, 10, 0), "x"), ("2", dt.datetime(2024, 1, 1, 10, 0), "y"),
            ("3", dt.datetime(2021, 12, 31, 23, 30), "z"), ("4", dt.datetime(2024, 10, 27, 0, 30), "w"),
            ("5", dt.datetime(2024, 10, 27, 1, 30), "v")]
    out = {r.Offset: r for r in ingest_envelope(_env(spark, rows)).collect()}
    assert out[1].ReceivedTime == dt.datetime(2024, 7, 1, 11, 0)        # BST: +1 h
    assert out[2].ReceivedTime == dt.datetime(2024, 1, 1, 10, 0)        # GMT
    assert out[3].ReceivedDate == "2021-12-31" and out[3].ReceivedYear == "2021"   # not week-year 2022
    assert out[3].ReceivedMonth == "12" and out[3].ReceivedDay == "31"
    # the autumn change repeats the 01:xx local hour
    assert out[4].ReceivedTime == dt.datetime(2024, 10, 27, 1, 30)
    assert out[5].ReceivedTime == dt.datetime(2024, 10, 27, 1, 30)
    assert out[1].Body == "x"


def _xml(events, meter="M1", mpan="1200000000001", end="2024-01-01T10:15:00.000Z", prefix=""):
    ev = "".join(f"<{prefix}Event><{prefix}timestamp>{ts}</{prefix}timestamp>"
                 + "".join(f"<{prefix}argument><{prefix}value>{a}</{prefix}value></{prefix}argument>" for a in args)
                 + f"</{prefix}Event>" for ts, args in events)
    return (f"<{prefix}Envelope><{prefix}Body><{prefix}MeterReadsReplyMessage><{prefix}payload><{prefix}MeterReading>"
            f"<{prefix}Meter><{prefix}mRID>{meter}</{prefix}mRID></{prefix}Meter>"
            f"<{prefix}ServiceDeliveryPoint><{prefix}mRID>{mpan}</{prefix}mRID></{prefix}ServiceDeliveryPoint>{ev}"
            f"</{prefix}MeterReading><{prefix}endTime>{end}</{prefix}endTime></{prefix}payload>"
            f"</{prefix}MeterReadsReplyMessage></{prefix}Body></{prefix}Envelope>")


SIX = ["a", "b", "c", "d", "e", "1A01"]


def test_flatten_edge_rows(spark):
    t = dt.datetime(2024, 1, 1, 10, 0)
    rows = [("1", t, _xml([("2024-01-01T09:59:00.123Z", SIX), ("2024-01-01T09:59:01.123Z", SIX)])),  # two events
            ("2", t, _xml([("2024-01-01T09:58:00.000Z", SIX[:5])])),                                   # no 6th arg
            ("3", t, _xml([("2024-01-01T09:57:00Z", SIX)])),                                           # no millis
            ("4", t, _xml([("2024-01-01T09:56:00.000Z", SIX)])[:70]),                                  # malformed
            ("5", t, None),                                                                            # null body
            ("6", t, "<Envelope><Body/></Envelope>")]                                                   # no match
    bronze = ingest_envelope(_env(spark, rows))
    flat = flatten_alerts(bronze, keep=["Offset"]).collect()
    by = {}
    for r in flat:
        by.setdefault(str(r.Offset), []).append(r)
    assert set(by) == {"1", "2", "3"}
    assert len(by["1"]) == 2 and {r.guid for r in by["1"]} == {"M1"}           # each event keeps its meter
    assert sorted(r.event_timestamp for r in by["1"]) == [dt.datetime(2024, 1, 1, 9, 59, 0, 123000),
                                                          dt.datetime(2024, 1, 1, 9, 59, 1, 123000)]
    assert by["1"][0].alert_code == "1A01" and by["1"][0].event_date == dt.date(2024, 1, 1)
    assert by["1"][0].event_hour == "09" and by["1"][0].end_time == dt.datetime(2024, 1, 1, 10, 15)
    assert by["2"][0].alert_code is None
    assert by["3"][0].event_timestamp is None and by["3"][0].event_year is None
    bad = {str(r.Offset) for r in malformed_alerts(bronze).collect()}
    assert "4" in bad and "6" in bad and "1" not in bad


def test_every_reading_and_readings_without_events(spark):
    t = dt.datetime(2024, 1, 1, 10, 0)
    two = _xml([("2024-01-01T09:59:00.123Z", SIX)])
    other = _xml([("2024-01-01T09:58:00.000Z", SIX)], meter="M2", mpan="1900000000002")
    reading = other[other.index("<MeterReading>"):other.index("<endTime>")]
    rows = [("1", t, two.replace("<endTime>", reading + "<endTime>")), ("2", t, _xml([])), ("3", t, "<Envelope/>")]
    bronze = ingest_envelope(_env(spark, rows))
    flat = flatten_alerts(bronze, keep=["Offset"]).collect()
    assert sorted((r.Offset, r.guid, r.alert_code) for r in flat if r.Offset == 1) == [(1, "M1", "1A01"), (1, "M2", "1A01")]
    padded = [r for r in flat if r.Offset == 2]
    assert [(r.guid, r.event_timestamp, r.alert_code) for r in padded] == [("M1", None, None)]
    assert padded[0].end_time == dt.datetime(2024, 1, 1, 10, 15)
    assert [r.Offset for r in malformed_alerts(bronze).collect()] == [3]


def test_region_case_prefixes(spark):
    df = spark.createDataFrame([("1200",), ("1900",), ("1000",), ("9900",), (None,), ("1",)], "mpan string")
    out = [r.dno for r in with_region(df).collect()]
    assert out == ["LPN", "SPN", "EPN", "Others", "Others", "Others"]


def test_lookup_strips_0x_everywhere(spark, tmp):
    path = f"{tmp}/lookup.csv"
    with open(path, "w") as f:
        f.write("Alert Code,DESC_TEXT,Alert Type,Final Desc,Phase,Phase Number\n0x1A01,d,t,f,L1,1\n0x0x2B,d,t,f,L2,2\n")
    out = voltage.alert_lookup(spark, path).collect()
    assert [r.alert_code for r in out] == ["1A01", "2B"]
    assert out[0].asDict() == {"alert_code": "1A01", "alert_desc": "d", "alert_type": "t",
                               "final_alert_desc": "f", "phase": "L1", "phase_number": "1"}


GOLD_SCHEMA = ("mpan string, event_timestamp timestamp_ntz, received_timestamp timestamp_ntz, v string, "
               "event_year string, event_month string, event_day string")


def _gold_rows(spark, rows):
    return spark.createDataFrame(rows, GOLD_SCHEMA)


def test_upsert_table_replay_and_republish(spark, tmp):
    t1, t2 = dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 2, 1)
    b0 = _gold_rows(spark, [("m1", t1, t1, "a", "2024", "01", "01"), ("m2", t2, t2, "b", "2024", "01", "02"),
                            (None, t1, t1, "n", "2024", "01", "01")])
    b1 = _gold_rows(spark, [("m1", t1, t1, "a2", "2024", "01", "01"), ("m3", None, t2, "c", None, None, None),
                            (None, t1, t1, "n", "2024", "01", "01")])
    from stratum.streaming.upsert import UpsertTable
    table = UpsertTable(spark, f"{tmp}/view", voltage.MERGE_KEYS, b0.schema, voltage.GOLD_PARTITION_BY, "s")
    m0 = table.merge_batch(b0, 0)
    assert m0["numTargetRowsInserted"] == 3
    m1 = table.merge_batch(b1, 1)
    assert (m1["numTargetRowsUpdated"], m1["numTargetRowsInserted"]) == (1, 2)
    assert table.merge_batch(b1, 1) is None                    # replayed batch id: skipped
    rows = sorted(((r.mpan, r.v) for r in table.read().collect()), key=repr)
    assert rows == sorted([("m1", "a2"), ("m2", "b"), ("m3", "c"), (None, "n"), (None, "n")], key=repr)
    # the untouched partition (day 02) was not rewritten, the NULL partition holds the NULL-time row
    parts = {r.event_day for r in table.read().collect()}
    assert parts == {"01", "02", None}
    versions = [r.version for r in table.log.read().orderBy("version").collect()]
    assert versions == [0, 1, 2]


def test_upsert_prunes_target_partitions(spark, tmp):
    from stratum.streaming.upsert import UpsertTable
    t1 = dt.datetime(2024, 1, 1, 1)
    b0 = _gold_rows(spark, [("m1", t1, t1, "a", "2024", "01", "01")])
    table = UpsertTable(spark, f"{tmp}/view", ["mpan"], b0.schema, ["event_day"], "s")
    table.merge_batch(b0, 0)
    src = _gold_rows(spark, [("m9", t1, t1, "z", "2024", "01", "05")])
    plan = table._touched(table.read(), src)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_day" in plan


def test_run_voltage_streams_equal_batch(spark, sf, tmp):
    from stratum.plans import fixtures as fx
    env = fx.alerts_envelope(spark, sf)
    env.write.partitionBy("delivery").parquet(f"{tmp}/env")
    schema = spark.read.parquet(f"{tmp}/env").drop("delivery").schema
    paths = voltage.run_voltage(spark, f"{tmp}/env", None, None, f"{tmp}/run", schema, view=False)
    b = spark.read.schema(voltage.bronze(env.drop("delivery")).schema).parquet(paths["bronze"])
    assert b.count() == env.count()
    assert b.schema["ReceivedMonth"].dataType.simpleString() == "string"
    h = spark.read.parquet(paths["history"])
    expected = voltage.flattened(voltage.bronze(env.drop("delivery")))
    cols = ["guid", "mpan", "event_timestamp", "alert_code", "end_time", "received_timestamp"]
    assert sorted(map(tuple, h.select(*cols).collect()), key=repr) == \
        sorted(map(tuple, expected.select(*cols).collect()), key=repr)


def test_kafka_shaped_envelope_with_instant_timestamps(spark):
    """A bus source gives TIMESTAMP instants; the UTC wall clock must not depend on the session zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(7, "<x/>")], "offset long, value string") \
            .withColumn("timestamp", F.expr("timestamp'2024-07-01 10:00:00Z'")) \
            .withColumn("value", F.encode("value", "UTF-8"))
        r = ingest_envelope(df, offset="offset", enqueued="timestamp", body="value").first()
        assert (r.Offset, r.Body, r.ReceivedDate) == (7, "<x/>", "2024-07-01")
        assert r.ReceivedTime == dt.datetime(2024, 7, 1, 11, 0)          # 10:00 UTC -> 11:00 BST
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _events_table(spark, tmp, n=60):
    e = spark.range(n)
    e.select(F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 06:00:00' + make_interval(0,0,0,cast(id % 30 as int))").alias("ts"),
             (F.col("id") % 7).alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.5).alias("value"),
             F.lit("{}").alias("props")).write.parquet(f"{tmp}/events.parquet")
    return tmp


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_count_parses_each_body_once(spark, tmp):
    spark.createDataFrame([("<Envelope/>", dt.datetime(2024, 1, 1))], "Body string, ReceivedTime timestamp_ntz") \
        .write.parquet(f"{tmp}/bronze")
    flat = voltage.flattened(spark.read.parquet(f"{tmp}/bronze").repartition(2))
    for df in (flat.agg(F.count(F.lit(1))), flat.select("mpan", "alert_code").distinct()):
        assert _optimized(df).count("from_xml") == 1


def test_envelopes_are_dealt_out_before_their_bodies_are_made(spark, tmp):
    from stratum.plans import fixtures as fx
    env = fx.alerts_envelope(spark, _events_table(spark, tmp, 100))
    assert _optimized(env).count("Relation [") == 1
    got = {(r.offset, r.delivery) for r in env.collect()}
    late = lambda i: (i % 30) // fx.ALERT_DELIVERY_DAYS + (i % fx.ALERT_LATE_MOD == 0)
    assert got == {(str(i), late(i) + k) for i in range(100) for k in ((0, 1) if i % fx.ALERT_REPLAY_MOD == 0 else (0,))}
    assert env.count() == 105


def test_streams_read_rows_that_were_flattened_once(spark, tmp):
    import glob
    from stratum.plans import incremental, registry
    from stratum.session import checkpoint_root
    sf_dir = _events_table(spark, tmp)
    spark.range(9).select(F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.lit("s").alias("c_mktsegment"),
                          F.lit(1).alias("c_nationkey")).write.parquet(f"{tmp}/customer.parquet")
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    flat = voltage.flattened(registry._bronze(spark, sf_dir))
    seen = set(glob.glob(f"{checkpoint_root(spark)}/stratum/*/flat"))
    kept, late = registry._deduped_stream(spark, sf_dir)
    assert rows(kept.unionByName(late)) == rows(flat.select(*registry.FLAT_COLS).distinct())
    history = incremental.q_stream_history(spark, sf_dir)
    assert rows(history) == rows(flat.select(*history.columns))
    stored = set(glob.glob(f"{checkpoint_root(spark)}/stratum/*/flat")) - seen
    assert len(stored) == 2 and all(rows(spark.read.parquet(p).select(*flat.columns)) == rows(flat) for p in stored)


def test_staged_folders_are_moved_into_the_table(spark, tmp):
    from stratum.sources.catalog import path_exists
    from stratum.streaming.upsert import UpsertTable
    t1, t2 = dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 2, 1)
    b0 = _gold_rows(spark, [("m1", t1, t1, "a", "2024", "01", "01"), ("m2", t2, t2, "b", "2024", "01", "02")])
    b1 = _gold_rows(spark, [("m1", t1, t1, "a2", "2024", "01", "01")])
    for name, parts in (("whole", []), ("parts", voltage.GOLD_PARTITION_BY)):
        new = lambda: UpsertTable(spark, f"{tmp}/{name}", voltage.MERGE_KEYS, b0.schema, parts, "s", partition_from_keys=True)  # noqa: E731,B023
        new().merge_batch(b0, 0)
        for fails in ("_move", "log"):          # before the move, then between it and the commit row
            table, batch = new(), (1 if fails == "_move" else 2)
            setattr(*((table, "_move") if fails == "_move" else (table.log, "append")), lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                table.merge_batch(b1, batch)
            assert new().merge_batch(b1, batch)["republished"] == 1 and new().merge_batch(b1, batch) is None
            assert sorted((r.mpan, r.v) for r in new().read().collect()) == [("m1", "a2"), ("m2", "b")]
        folder = f"{tmp}/{name}_staging/s-0"     # no second copy of the rows is left
        assert path_exists(spark, f"{folder}_published") and not path_exists(spark, f"{folder}/event_year=2024/event_month=01/event_day=01")
        assert parts or not path_exists(spark, folder)
