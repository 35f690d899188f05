import datetime as dt

from stratum.operators.aggregates import count_by_window, reconcile, table_counts
from stratum.operators.reports import commit_report, merge_report
from stratum.streaming.upsert import COMMIT_SCHEMA


def test_count_by_window_and_reconcile(spark):
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    a = spark.createDataFrame([(t(0, 1),), (t(0, 59),), (t(2, 0),), (None,)], "ts timestamp_ntz")
    b = spark.createDataFrame([(t(0, 5),), (t(1, 0),)], "ts timestamp_ntz")
    ca = count_by_window(a, "ts")
    assert [(str(r.start_time), str(r.end_time), r["count"]) for r in ca.collect()] == [
        ("2024-01-01 00:00:00", "2024-01-01 01:00:00", 2), ("2024-01-01 02:00:00", "2024-01-01 03:00:00", 1)]
    rec = reconcile(ca, count_by_window(b, "ts"), "start_time", "a", "b").collect()
    assert [(r.start_time.hour, r.a, r.b, r.difference) for r in rec] == [(0, 2, 1, 1), (1, 0, 1, -1), (2, 1, 0, 1)]


def test_table_counts(spark):
    out = {r.table_name: r.row_count for r in table_counts({"x": spark.range(3), "y": spark.range(0)}).collect()}
    assert out == {"x": 3, "y": 0}


def test_commit_and_merge_reports(spark):
    now = dt.datetime(2024, 7, 1, 12, 0)
    log = spark.createDataFrame([
        ("s", 0, 0, now, "WRITE", {"numOutputRows": "10", "numOutputBytes": "2048"}),
        ("s", 1, 1, now, "MERGE", {"numOutputRows": "12", "numTargetRowsInserted": "2",
                                   "numTargetRowsUpdated": "3", "numTargetRowsDeleted": "0",
                                   "executionTimeMs": "1500", "scanTimeMs": "500", "rewriteTimeMs": "250"})],
        COMMIT_SCHEMA)
    c = commit_report(log).orderBy("version").collect()
    assert (c[0].num_rows_written, c[0].num_bytes_written) == (10, 2048)
    assert c[0].timestamp == dt.datetime(2024, 7, 1, 13, 0)            # UTC -> London (BST)
    m = merge_report(log).orderBy("version").collect()[1]
    assert (m.num_rows_inserted, m.num_rows_updated, m.num_rows_deleted, m.num_rows_written) == (2, 3, 0, 12)
    assert (m.execution_time_seconds, m.scan_time_seconds, m.rewrite_time_seconds) == (1.5, 0.5, 0.25)
    assert merge_report(log).orderBy("version").first().num_rows_inserted is None   # missing key: NULL
