"""Change tables, kept sums, snapshots, late splits, branches with lookups, growing schemas, text ranges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import aggregates as agg
from stratum.operators import layout
from stratum.operators.changes import apply_changes
from stratum.operators.schema import evolved
from stratum.streaming.buckets import ChangeTable, KeptSums, folders
from stratum.streaming.snapshots import Snapshots

SCHEMA = "k string, seq int, grp string, v float"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _sums(spark, path):
    return KeptSums(spark, path, {"grp": F.col("grp")}, F.col("v"), {"grp": "string"}, buckets=4)


def test_change_table_and_sums_equal_the_recompute(spark, tmp):
    rnd = random.Random(3)
    made = [(rnd.choice(["a", "b", "c", "d", "e", None]), rnd.choice([1, 2, 3, 4, 5, 6, None]), rnd.choice(["x", "y", "z", None]),
             rnd.choice([0.1, 0.2, 2.5, None])) for _ in range(60)]
    schema = spark.createDataFrame([], SCHEMA).schema
    table = ChangeTable(spark, f"{tmp}/t", schema, ["k"], "seq", buckets=4)
    sums = _sums(spark, f"{tmp}/sums")
    came = []
    for i, part in enumerate([made[:20], made[20:40], made[:25], made[40:]]):   # late, newer and repeated rows
        came += part
        table.append(spark.createDataFrame(part, SCHEMA))
        want = _rows(apply_changes(None, spark.createDataFrame(came, SCHEMA), "k", "seq"))
        assert _rows(table.read()) == want            # before compaction, by merge on read
        if i == 1:
            continue                                   # two generations are merged at once later
        version = table.compact()
        assert _rows(table.read()) == want and table.pending() == []
        assert sums.apply(table.deltas(version), version) and not sums.apply(table.deltas(version), version)
        full = spark.createDataFrame(want, SCHEMA).groupBy("grp").agg(F.sum(F.col("v").cast("decimal(38,6)")).cast("double"))
        assert _rows(sums.read()) == _rows(full)
    assert table.compact() is None                     # nothing is pending


def test_only_touched_buckets_are_rewritten_and_old_versions_go_by_age(spark, tmp):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = ChangeTable(spark, f"{tmp}/t", schema, ["k"], "seq", buckets=8)
    table.append(spark.createDataFrame([(c, 1, "x", 1.0) for c in "abcdefghijklmnop"], SCHEMA))
    first = table.compact()
    table.append(spark.createDataFrame([("a", 2, "y", 2.0)], SCHEMA))
    second = table.compact()
    layout_ = table.base.layout()
    assert list(layout_.values()).count(second) == 1 and set(layout_.values()) == {first, second}
    assert _rows(table.deltas(second)) == [(-1, "a", 1, "x", 1.0), (1, "a", 2, "y", 2.0)]
    reader = table.read()                              # planned before the next version
    table.append(spark.createDataFrame([("a", 3, "z", 3.0)], SCHEMA))
    third = table.compact()
    assert ("a", 2, "y", 2.0) in _rows(reader)
    assert table.vacuum(older_than_hours=1) == [] and table.vacuum(older_than_hours=0) == [second]
    assert table.base.layout() and ("a", 3, "z", 3.0) in _rows(table.read()) and table.read().count() == 16
    assert table.generations() == [] or max(table.generations()) <= third
    table.append(spark.createDataFrame([("q", 1, "x", 1.0)], SCHEMA))     # numbers go on after a vacuum
    assert table.compact() == third + 1 and table.read().count() == 17


def test_streamed_changes_take_new_files_only_and_survive_a_lost_run(spark, tmp):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = ChangeTable(spark, f"{tmp}/t", schema, ["k"], "seq", buckets=4)
    src = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{tmp}/in")
    for i, rows in enumerate([[("a", 1, "x", 1.0), ("b", 1, "x", 1.0)], [("a", 0, "w", 9.0)], [("c", 5, "y", 2.0)]]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp}/in/f{i}")
        q = table.append(src(), f"{tmp}/ck")
        assert sum(p["numInputRows"] for p in q.recentProgress) == len(rows)
    assert len(table.pending()) == 3
    # a version that broke off has no marker: it is written anew
    spark.createDataFrame([("zz", 1, "x", 1.0)], SCHEMA).write.parquet(f"{tmp}/t/base/version=2/_bucket=0")
    want = [("a", 1, "x", 1.0), ("b", 1, "x", 1.0), ("c", 5, "y", 2.0)]
    assert _rows(table.read()) == want and table.compact() == 2 and _rows(table.read()) == want
    table.append(src(), f"{tmp}/ck")                   # nothing new came
    assert table.compact() is None and _rows(table.read()) == want


def test_retail_second_run_reads_only_what_is_new(spark, tmp):
    from stratum.plans import retail
    head = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    lines = [["1,s,d,2,1/2/11 3:04,1.5,c1,UK", "2,s,d,3,1/2/11 3:05,1.5,c2,FR", ",s,d,3,1/2/11 3:05,1.5,c2,XX"],
             ["1,s,d,5,1/3/11 3:04,1.5,c1,DE", "1,s,d,9,1/1/11 3:04,1.5,c1,ES", "2,s,d,3,1/2/11 3:05,1.5,c2,FR"]]
    got = []
    for i, part in enumerate(lines):
        spark.createDataFrame([(head + "\n".join(part),)], "value string").coalesce(1).write.text(f"{tmp}/csv/f{i}")
        t = retail.run_retail(spark, f"{tmp}/csv", f"{tmp}/run", f"inc_{i}_{tmp.rsplit('-', 1)[-1]}")
        target = t.target(spark)
        got.append((target.base.versions(), t.read(spark, "retail_sales_all_countries").count()))
    assert got == [([0], 2), ([0, 1], 2)]
    assert _rows(target.deltas(1).select("_sign", "InvoiceNo", "Country", "Quantity")) == [(-1, "1", "UK", 2.0), (1, "1", "DE", 5.0)]
    assert target.base._finished.keys() == {0, 1} or target.base.layout()
    latest = retail.sales_all_countries(spark.read.parquet(t.paths["quality_retail"]))
    for name, fn in (("sales_by_day", retail.sales_by_day), ("sales_by_country", retail.sales_by_country),
                     ("top_ten_customers", retail.top_ten_customers)):
        assert _rows(t.read(spark, name)) == _rows(fn(latest)), name
    assert _rows(t.read(spark, "distinct_countries_retail")) == [("DE",), ("ES",), ("FR",), ("UK",)]
    assert len(folders(spark, t.paths["sales_by_day"], "snapshot")) == 2


def test_a_reader_sees_a_whole_table_during_the_swap(spark, tmp):
    name = "snap_" + tmp.rsplit("-", 1)[-1]
    table = Snapshots(spark, f"{tmp}/gold", name, comment="it's gold", properties={"quality": "gold"})
    with pytest.raises(FileNotFoundError):
        table.read()
    table.publish(spark.range(5).toDF("id"))
    old = spark.table(name)                            # planned on the first snapshot
    spark.range(100, 103).toDF("id").write.parquet(f"{tmp}/gold/snapshot=1/part")   # a write that broke off
    assert spark.table(name).count() == 5 and table.read().count() == 5
    table.publish(spark.range(7, 9).toDF("id"))
    assert old.count() == 5 and _rows(spark.table(name)) == [(7,), (8,)] == _rows(table.read())
    assert table.vacuum(older_than_hours=1) == [] and len(table.vacuum(older_than_hours=0)) == 2
    assert _rows(spark.table(name)) == [(7,), (8,)]


def test_published_complete_batches(spark, tmp):
    from stratum.streaming.sinks import publish_batch
    table = Snapshots(spark, f"{tmp}/gold")
    fn = publish_batch(table)
    fn(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "gender string, avg_weight double"), 0)
    before = table.read()
    fn(spark.createDataFrame([("a", 1.5)], "gender string, avg_weight double"), 1)
    assert _rows(table.read()) == [("a", 1.5)] and before.count() == 2


def test_late_rows_are_split_in_the_streams_own_pass(spark, tmp):
    from stratum.streaming.late import LateSplit
    d = lambda day, micros=0: dt.datetime(2024, 1, day, 0, 0, 0, micros)
    parts = [[(1, d(20)), (2, None)], [(3, d(5)), (4, d(19)), (5, d(25, 7))], [(6, d(24, 6)), (7, d(24, 7)), (3, d(5))]]
    split = LateSplit(spark, f"{tmp}/out", "ts", "1 day")
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "id long, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp}/in/f{i}")
        src = spark.readStream.schema("id long, ts timestamp_ntz").option("recursiveFileLookup", True).parquet(f"{tmp}/in")
        if i == 2:   # the metrics of the last run were lost: the maximum comes from the rows
            rows_of_first = split.metrics().filter("batch_id = 0").collect()
            spark.createDataFrame(rows_of_first, split.METRICS).write.mode("overwrite").parquet(split.metrics_path)
        split.run(src, f"{tmp}/ck")
    assert sorted(r.id for r in split.kept().collect()) == [1, 4, 5, 7]
    assert sorted(r.id for r in split.side().collect()) == [2, 3, 3, 6]
    assert split.kept().count() + split.side().count() == sum(map(len, parts))
    q = split.run(spark.readStream.schema("id long, ts timestamp_ntz").option("recursiveFileLookup", True).parquet(f"{tmp}/in"), f"{tmp}/ck")
    assert sum(p["numInputRows"] for p in q.recentProgress) == 0


def test_branches_join_the_lookup_as_it_is(spark, tmp):
    from stratum.streaming.enrich import Branch, run_branches
    def branches():
        read = lambda: spark.read.schema("code string, name string").parquet(f"{tmp}/lookup")
        return [Branch("plain", f"{tmp}/plain", lambda s: s, {}),
                Branch("inner", f"{tmp}/inner", lambda s, l: s.join(l, "code"), {"l": read}),
                Branch("left", f"{tmp}/left", lambda s, l: s.join(l, "code", "left_outer"), {"l": read})]
    for i, (rows, lookup) in enumerate([([(1, "a"), (2, "b")], [("a", "A")]), ([(3, "b"), (4, "c"), (5, None)], [("a", "A2"), ("b", "B")])]):
        spark.createDataFrame(rows, "id long, code string").write.mode("append").parquet(f"{tmp}/src")
        spark.createDataFrame(lookup, "code string, name string").write.mode("overwrite").parquet(f"{tmp}/lookup")
        run_branches(spark, f"{tmp}/src", "id long, code string", branches(), f"{tmp}/ck", one_by_one=bool(i))
    assert spark.read.parquet(f"{tmp}/plain").count() == 5
    assert _rows(spark.read.parquet(f"{tmp}/inner").select("id", "name")) == [(1, "A"), (3, "B")]
    assert _rows(spark.read.parquet(f"{tmp}/left").select("id", "name")) == \
        sorted([(1, "A"), (2, None), (3, "B"), (4, None), (5, None)], key=repr)


def test_rule_metrics_are_kept_as_rows(spark, tmp):
    from stratum.streaming.datasets import Dataset, rule_metrics, streaming_table
    ds = Dataset("rm_" + tmp.rsplit("-", 1)[-1], f"{tmp}/out", drop_rules={"has_id": "id IS NOT NULL"}, warn_rules={"short": "length(s) < 2"})
    assert rule_metrics(spark, ds).count() == 0
    for i, rows in enumerate([[(1, "x"), (None, "yy")], [(3, "zz"), (4, None), (5, "a")]]):
        spark.createDataFrame(rows, "id long, s string").coalesce(1).write.parquet(f"{tmp}/in/f{i}")
        src = spark.readStream.schema("id long, s string").option("recursiveFileLookup", True).parquet(f"{tmp}/in")
        streaming_table(spark, ds, src, f"{tmp}/ck")
    assert _rows(rule_metrics(spark, ds).select("rule", "batch_id", "rows", "violations")) == [
        ("has_id", 0, 2, 1), ("has_id", 1, 3, 0), ("short", 0, 2, 1), ("short", 1, 3, 2)]


def test_clustered_dataset_lays_out_new_runs_only(spark, tmp):
    from stratum.streaming.datasets import Dataset, streaming_table
    ds = Dataset("cl_" + tmp.rsplit("-", 1)[-1], f"{tmp}/out", drop_rules={"has_id": "id IS NOT NULL"}, cluster_by=["id"], cluster_files=4)
    files = []
    for i in range(2):
        spark.range(400).select(F.when(F.col("id") != 7, F.col("id") * 37 % 400 + 400 * i).alias("id"), F.lit("x").alias("s")) \
            .write.parquet(f"{tmp}/in/f{i}")
        src = spark.readStream.schema("id long, s string").option("recursiveFileLookup", True).parquet(f"{tmp}/in")
        streaming_table(spark, ds, src, f"{tmp}/ck")
        files.append(set(spark.read.parquet(ds.path).inputFiles()))
    assert files[0] < files[1] and len(files[1]) == 8
    stored = spark.read.parquet(ds.path)
    assert stored.count() == 798 and spark.table(ds.name).count() >= 399
    assert layout.files_overlapping(layout.file_stats(stored, ["id"]), "id", 555).count() == 1


def test_narrow_scans_are_dealt_out_by_bytes(spark, tmp):
    from stratum.sources.files import redistribute, scan_bytes
    spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s")).coalesce(1).write.parquet(f"{tmp}/t")
    df = spark.read.parquet(f"{tmp}/t")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    dealt = redistribute(df)
    assert scan_bytes(df) > 4 << 20 and "Exchange" in plan(dealt)
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert "Exchange" not in plan(redistribute(df, task_bytes=1 << 30)) and redistribute(df, width=3).rdd.getNumPartitions() == 3
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")       # a wide scan is left as it is
        assert "Exchange" not in plan(redistribute(df))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    stream = spark.readStream.schema("id long").parquet(f"{tmp}/t")
    assert redistribute(stream).isStreaming


# ------------------------------------------------------------------------------------ upsert table
def _table(spark, path, schema, **kw):
    from stratum.streaming.upsert import UpsertTable
    return UpsertTable(spark, path, ["k"], schema, **kw)


def test_upsert_keeps_equal_rows_and_new_columns(spark, tmp):
    b = spark.createDataFrame([(None, 1), (None, 1), ("a", 2)], "k string, v int")
    t = _table(spark, f"{tmp}/t", b.schema)
    t.merge_batch(b, 0)
    assert _rows(t.read()) == sorted([("a", 2), (None, 1), (None, 1)], key=repr)
    t.merge_batch(spark.createDataFrame([("b", 1 << 40, "new")], "k string, v long, extra string"), 1)
    again = _table(spark, f"{tmp}/t", b.schema)          # opened with the old schema
    assert again.schema == t.schema and dict(again.read().dtypes) == {"k": "string", "v": "bigint", "extra": "string"}
    assert ("b", 1 << 40, "new") in _rows(again.read()) and ("a", 2, None) in _rows(again.read())
    again.merge_batch(spark.createDataFrame([("a", 7)], "k string, v int"), 2)   # a column that doesn't come
    assert ("a", 7, None) in _rows(again.read()) and ("b", 1 << 40, "new") in _rows(again.read())
    with pytest.raises(TypeError):
        again.merge_batch(spark.createDataFrame([("a", "text")], "k string, v string"), 3)


def test_evolved_schemas_widen_by_name(spark):
    s = lambda ddl: spark.createDataFrame([], ddl).schema
    assert evolved(s("a int, b float, c decimal(5,2)"), s("c decimal(7,1), d string, a long")).simpleString() == \
        "struct<a:bigint,b:float,c:decimal(8,2),d:string>"
    with pytest.raises(TypeError):
        evolved(s("a string"), s("a int"))


def test_a_fresh_checkpoint_loses_no_batch(spark, tmp):
    sc = spark.sparkContext
    b = lambda k: spark.createDataFrame([(k, 1)], "k string, v int")
    t = _table(spark, f"{tmp}/t", b("a").schema)
    try:
        sc.setLocalProperty("sql.streaming.queryId", "query-1")
        assert t.merge_batch(b("a"), 0) is not None and t.merge_batch(b("a"), 0) is None   # a replay
        sc.setLocalProperty("sql.streaming.queryId", "query-2")
        assert t.merge_batch(b("c"), 0) is not None                                           # a new query's first batch
    finally:
        sc.setLocalProperty("sql.streaming.queryId", None)
    assert _rows(t.read()) == [("a", 1), ("c", 1)]


def test_a_key_that_moves_to_another_partition_is_stored_once(spark, tmp):
    ddl = "k string, v int, p string"
    t = _table(spark, f"{tmp}/t", spark.createDataFrame([], ddl).schema, partition_by=["p"])
    t.merge_batch(spark.createDataFrame([("a", 1, "x/1"), ("b", 1, "y"), ("c", 1, "y")], ddl), 0)
    t.merge_batch(spark.createDataFrame([("a", 2, "y"), ("b", 2, None)], ddl), 1)
    assert _rows(t.read()) == sorted([("a", 2, "y"), ("b", 2, None), ("c", 1, "y")], key=repr)


# ------------------------------------------------------------------------------------ layout, hours
def test_texts_of_one_beginning_let_files_be_skipped(spark, tmp):
    head = "https://www.example.com/catalogue/items/"
    df = spark.range(4000).select("id", F.concat(F.lit(head), F.lpad((F.col("id") * 7919 % 4000).cast("string"), 6, "0")).alias("url"),
                                  F.unhex(F.lpad(F.hex(F.col("id") * 31 % 4000), 8, "0")).alias("raw"))
    df = df.unionByName(spark.createDataFrame([(5000, None, None), (5001, "", bytearray())], "id long, url string, raw binary"))
    layout.cluster_by_zorder(df, ["url"], 8).write.parquet(f"{tmp}/u")
    layout.cluster_by_zorder(df, ["url", "raw"], 16).write.parquet(f"{tmp}/z")
    for path, cols, most in (("u", ["url"], 2), ("z", ["url", "raw"], 10)):
        stored = spark.read.parquet(f"{tmp}/{path}")
        assert _rows(stored.select("id")) == _rows(df.select("id"))
        stats = layout.file_stats(stored, cols)
        for c in cols:
            probe = stored.filter(f"id = 1234").first()[c]
            assert 1 <= layout.files_overlapping(stats, c, probe).count() <= most, (path, c)


def test_hours_across_both_clock_changes(spark):
    times = [dt.datetime(2024, 10, 26, 23, 30), dt.datetime(2024, 10, 27, 0, 10), dt.datetime(2024, 10, 27, 0, 50), dt.datetime(2024, 10, 27, 1, 20),
             dt.datetime(2024, 3, 31, 0, 15), dt.datetime(2024, 3, 31, 1, 15), None]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    got = [(r.local_start.strftime("%m-%d %H"), r.offset_minutes, r["count"])
           for r in agg.count_by_local_hour(df, "ts", "Europe/London").collect()]
    assert got == [("03-31 00", 0, 1), ("03-31 02", 60, 1), ("10-27 00", 60, 1), ("10-27 01", 60, 2), ("10-27 01", 0, 1)]


def test_a_version_written_in_turns_is_whole_or_not_there(spark, tmp, monkeypatch):
    from stratum.streaming import buckets
    monkeypatch.setattr(buckets, "TURN_BYTES", 1)
    schema = spark.createDataFrame([], SCHEMA).schema
    table = ChangeTable(spark, f"{tmp}/t", schema, ["k"], "seq", buckets=4)
    first = [(c, 1, "x", 1.0) for c in "abcdefgh"] + [(None, 1, "x", 1.0)]
    table.append(spark.createDataFrame(first, SCHEMA))
    turns, write = [], buckets.BucketFolders.write
    monkeypatch.setattr(buckets.BucketFolders, "write", lambda self, df, *a, **k: (turns.append(k), write(self, df, *a, **k)) and None)
    assert table.compact() == 0 and len(turns) == len(table.base.layout()) > 1
    second = [("a", 2, "y", 2.0), ("b", 0, "y", 2.0), ("h", 1, "z", 1.0), (None, 3, "y", 4.0), ("n", 1, "y", 1.0)]
    table.append(spark.createDataFrame(second, SCHEMA))

    def breaks(self, df, version, first=True, last=True):
        if not first:
            raise OSError("broke off")
        write(self, df, version, first, last)
    want = _rows(apply_changes(None, spark.createDataFrame(first + second, SCHEMA), "k", "seq"))
    with monkeypatch.context() as m:
        m.setattr(buckets.BucketFolders, "write", breaks)
        with pytest.raises(OSError):
            table.compact()
    again = ChangeTable(spark, f"{tmp}/t", schema, ["k"], "seq", buckets=4)
    assert again.base.versions() == [0] and again.pending() == [1] and _rows(again.read()) == want
    assert again.compact() == 1 and _rows(again.read()) == want and again.base.versions() == [0, 1]
    assert _rows(again.deltas(1)) == _rows(spark.createDataFrame(
        [(-1, "a", 1, "x", 1.0), (1, "a", 2, "y", 2.0), (-1, "h", 1, "x", 1.0), (1, "h", 1, "z", 1.0),
         (-1, None, 1, "x", 1.0), (1, None, 3, "y", 4.0), (1, "n", 1, "y", 1.0)], "_sign int, " + SCHEMA))


def test_retail_runs_keep_only_what_is_current(spark, tmp):
    from stratum.plans import retail
    head = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    lines = [["1,s,d,2,1/2/11 3:04,1.5,c1,UK", "2,s,d,3,1/2/11 3:05,1.5,c2,FR", "3,s,d,1,1/2/11 3:05,1.5,c3,FR"],
             ["1,s,d,5,1/3/11 3:04,1.5,c1,DE", "1,s,d,9,1/1/11 3:04,1.5,c1,ES"], ["2,s,d,3,1/2/11 3:05,1.5,c2,FR"], []]
    for i, part in enumerate(lines):
        spark.createDataFrame([(head + "\n".join(part),)], "value string").coalesce(1).write.text(f"{tmp}/csv/f{i}")
        t = retail.run_retail(spark, f"{tmp}/csv", f"{tmp}/run", f"cur_{i}_{tmp.rsplit('-', 1)[-1]}", keep_hours=0)
        latest = retail.sales_all_countries(spark.read.parquet(t.paths["quality_retail"]))
        assert _rows(t.read(spark, "retail_sales_all_countries")) == _rows(latest)
        for name, fn in (("sales_by_day", retail.sales_by_day), ("sales_by_country", retail.sales_by_country),
                         ("top_ten_customers", retail.top_ten_customers)):
            assert _rows(t.read(spark, name)) == _rows(fn(latest)), (i, name)
            assert len(folders(spark, t.paths[name], "snapshot")) == 1
        target = t.target(spark)
        assert target.generations() == [] and target.pending() == []
        assert set(target.base.versions()) == set(target.base.layout().values()) | {max(target.base.versions())}
    assert _rows(t.read(spark, "distinct_countries_retail")) == [("DE",), ("ES",), ("FR",), ("UK",)]


def test_retail_deliveries_leave_no_landed_copies(spark, tmp):
    import os

    from stratum.plans import incremental
    from stratum.session import checkpoint_root
    from tests.test_retail import _small_tables
    _small_tables(spark, tmp)
    base = f"{checkpoint_root(spark)}/stratum".removeprefix("file:")
    before = set(os.listdir(base))
    assert _rows(incremental.q_retail_kept_by_country(spark, tmp)) == [("DE", 4.0), ("FR", 3.0)]
    root, = [f"{base}/{d}" for d in set(os.listdir(base)) - before if d.startswith("retail_incremental-")]
    # lines without a date are in no delivery
    assert not [d for n in ("feed", "csv") for d in os.listdir(f"{root}/{n}") if d in ("delivery=0", "delivery=1", "delivery=2")]
    assert spark.read.parquet(f"{root}/tables/raw_retail").count() == 6      # the second delivery brings 1998 again
    assert incremental.q_retail_changes_target(spark, tmp).count() == 2
