import datetime as dt


from stratum.plans import retail
from stratum.plans.fixtures import RETAIL_DDL
from stratum.sources.files import stream_table
from stratum.streaming.late import count_by_window_stream, dedupe_stream, drop_late, event_time
from stratum.streaming.sinks import append_stream, memory_stream, progress, stop_all


def _csv(spark, root, rows_by_file):
    for i, rows in enumerate(rows_by_file):
        df = spark.createDataFrame(rows, RETAIL_DDL)
        df.coalesce(1).write.option("header", True).csv(f"{root}/f{i}")


RETAIL_ROWS = [
    [("1", "s1", "d", 1.0, "1/2/11 3:04", 2.0, "c1", "UK"), ("2", "s2", "d", 2.0, "bad date", 2.0, "c1", "UK")],
    [("1", "s3", "d", 3.0, "1/3/11 3:04", 2.0, "c1", "UK"), (None, "s4", "d", 4.0, "1/3/11 3:04", 2.0, "c2", "FR")],
    [("1", "s5", "d", 5.0, "12/31/10 3:04", 2.0, "c1", "UK"), ("3", "s6", "d", 6.0, "2/3/2011 13:04", 2.0, "c3", "FR")],
]


def test_stream_equals_batch_and_rerun_is_noop(spark, tmp):
    _csv(spark, f"{tmp}/in", RETAIL_ROWS)
    src = retail.raw_retail_stream(spark, f"{tmp}/in", max_files=1)
    q = append_stream(retail.quality_retail(src), f"{tmp}/quality", f"{tmp}/ck", partition_by=["Country"])
    q.awaitTermination()
    # one file per trigger; the rule 'InvoiceNo IS NOT NULL' is pushed into the CSV scan, so the
    # reader already skips that row and counts 5 input rows, not 6
    counts = [p["numInputRows"] for p in progress(q)]
    assert len([c for c in counts if c]) == 3 and sum(counts) == 5
    batch = retail.quality_retail(spark.read.schema(RETAIL_DDL).option("header", True)
                                  .option("recursiveFileLookup", True).csv(f"{tmp}/in"))
    cols = retail.QUALITY_COLUMNS
    streamed = spark.read.parquet(f"{tmp}/quality").select(*cols)
    assert sorted(map(tuple, streamed.collect()), key=repr) == sorted(map(tuple, batch.select(*cols).collect()), key=repr)
    # same checkpoint again: nothing new is read or written
    again = append_stream(retail.quality_retail(retail.raw_retail_stream(spark, f"{tmp}/in", max_files=1)),
                          f"{tmp}/quality", f"{tmp}/ck", partition_by=["Country"])
    again.awaitTermination()
    assert spark.read.parquet(f"{tmp}/quality").count() == streamed.count()
    # keyed latest from the streamed table: the older 12/31/10 line arrives last and loses
    latest = retail.sales_all_countries(spark.read.parquet(f"{tmp}/quality"))
    got = {(r.CustomerID, r.InvoiceNo): r.StockCode for r in latest.collect()}
    assert got == {("c1", "1"): "s3", ("c3", "3"): "s6"}


def _events(spark, root, parts):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "id long, ts timestamp_ntz").coalesce(1).write.parquet(f"{root}/f{i}")
    return spark.readStream.schema("id long, ts timestamp_ntz").option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", True).parquet(root)


def test_watermark_alone_drops_nothing_and_late_rows_lag(spark, tmp):
    d = lambda day: dt.datetime(2024, 1, day)
    parts = [[(1, d(20))], [(2, d(5))], [(3, d(6)), (4, d(19) + dt.timedelta(hours=12))], [(5, d(2))]]
    src = event_time(_events(spark, f"{tmp}/in", parts), "ts")
    plain = memory_stream(src.withWatermark("ts", "1 day"), "wm_plain", "append", f"{tmp}/ck1")
    plain.awaitTermination()
    assert spark.table("wm_plain").count() == 5                      # no stateful operator: nothing dropped
    src2 = event_time(_events(spark, f"{tmp}/in2", parts), "ts")
    q = memory_stream(drop_late(src2, "ts", "1 day", ["id"]), "wm_late", "append", f"{tmp}/ck2")
    q.awaitTermination()
    # batch 1 is judged against no watermark yet; batch 2 against max(batch 0) - 1 day (inclusive)
    assert sorted(r.id for r in spark.table("wm_late").collect()) == [1, 2, 4]


def test_window_counts_and_dedupe_bound_state(spark, tmp):
    h = lambda hh, mm=0: dt.datetime(2024, 1, 1, hh, mm)
    parts = [[(1, h(0, 5)), (2, h(0, 10)), (2, h(0, 10))], [(3, h(1, 5))], [(4, h(3, 0))]]
    src = event_time(_events(spark, f"{tmp}/in", parts), "ts")
    q = memory_stream(count_by_window_stream(src, "ts", "1 hour", "10 minutes"), "win_app", "append", f"{tmp}/ck")
    q.awaitTermination()
    got = {str(r.start_time)[11:16]: r["count"] for r in spark.table("win_app").collect()}
    assert got.get("00:00") == 3                     # closed windows only (append mode)
    assert "03:00" not in got                        # the open tail is not emitted yet
    src2 = event_time(_events(spark, f"{tmp}/in2", parts), "ts")
    q2 = memory_stream(dedupe_stream(src2, ["id", "ts"], "ts", "1 hour"), "dd", "append", f"{tmp}/ck2")
    q2.awaitTermination()
    assert sorted(r.id for r in spark.table("dd").collect()) == [1, 2, 3, 4]


def test_late_unique_rows_reach_the_side_table(spark, tmp):
    from stratum.streaming.late import late_rows
    d = lambda day: dt.datetime(2024, 1, day)
    parts = [[(1, d(20)), (2, None)], [(3, d(21)), (1, d(20))], [(4, d(5)), (2, None), (5, d(21))]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "id long, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp}/in/f{i}")
        src = spark.readStream.schema("id long, ts timestamp_ntz").option("recursiveFileLookup", True).parquet(f"{tmp}/in")
        q = append_stream(dedupe_stream(event_time(src, "ts"), ["id", "ts"], "ts", "1 day"), f"{tmp}/out", f"{tmp}/ck")
        q.awaitTermination()
    kept = event_time(spark.read.parquet(f"{tmp}/out"), "ts")
    arrived = event_time(spark.read.option("recursiveFileLookup", True).schema("id long, ts timestamp_ntz").parquet(f"{tmp}/in"), "ts")
    assert sorted(r.id for r in kept.collect()) == [1, 3, 5]
    assert sorted(r.id for r in late_rows(arrived, kept, ["id", "ts"]).collect()) == [2, 4]
    # rows without an event time are not held in state
    assert max(s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]) <= 3


def test_stream_table_and_stop_all(spark, tmp):
    spark.range(10).write.parquet(f"{tmp}/t")
    df = stream_table(spark, f"{tmp}/t")
    q = df.writeStream.format("memory").queryName("st_all").trigger(processingTime="1 second").start()
    assert stop_all(spark) >= 1 and not q.isActive


def test_complete_mode_batch_function_replaces_table(spark, tmp):
    from stratum.streaming.sinks import overwrite_batch
    fn = overwrite_batch(f"{tmp}/gold")
    fn(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "gender string, avg_weight double"), 0)
    fn(spark.createDataFrame([("a", 1.5)], "gender string, avg_weight double"), 1)
    assert [tuple(r) for r in spark.read.parquet(f"{tmp}/gold").collect()] == [("a", 1.5)]


def test_declared_streaming_dataset_with_rules(spark, tmp):
    from stratum.streaming.datasets import Dataset, streaming_table
    spark.createDataFrame([(1, "x"), (None, "y"), (3, "zz")], "id long, s string").write.parquet(f"{tmp}/in")
    src = spark.readStream.schema("id long, s string").parquet(f"{tmp}/in")
    ds = Dataset("rules_ds", f"{tmp}/out", drop_rules={"has_id": "id IS NOT NULL"},
                 warn_rules={"short_s": "length(s) < 2"}, properties={"quality": "silver"})
    q = streaming_table(spark, ds, src, f"{tmp}/ck")
    assert sorted(r.id for r in spark.read.parquet(f"{tmp}/out").collect()) == [1, 3]
    m = [p["observedMetrics"] for p in q.recentProgress if p.get("observedMetrics")][0]["rules_ds_expectations"]
    assert (m["rows"], m["violations_has_id"], m["violations_short_s"]) == (3, 1, 1)
