import random

import pytest
from pyspark.sql import functions as F

from stratum.operators.changes import (DuplicateKeysError, apply_changes, latest_per_key,
                                       merge_upsert, merge_upsert_tagged, retention)

SCHEMA = "k string, seq int, v string"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_late_older_change_does_not_overwrite(spark):
    target = spark.createDataFrame([("a", 5, "new")], SCHEMA)
    late = spark.createDataFrame([("a", 3, "old"), ("b", 1, "x")], SCHEMA)
    assert _rows(apply_changes(target, late, "k", "seq")) == [("a", 5, "new"), ("b", 1, "x")]


def test_null_sequence_sorts_lowest_and_ties_are_total(spark):
    df = spark.createDataFrame([("a", None, "z"), ("a", 1, "p"), ("a", 1, "q"), ("b", None, "m")], SCHEMA)
    assert _rows(latest_per_key(df, "k", "seq")) == [("a", 1, "q"), ("b", None, "m")]


def test_apply_changes_independent_of_arrival_order_and_split(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("abcdef"), rnd.randint(0, 9), rnd.choice("xyz")) for _ in range(80)]
    expected = _rows(latest_per_key(spark.createDataFrame(rows, SCHEMA), "k", "seq"))
    for _ in range(3):
        rnd.shuffle(rows)
        cut = sorted(rnd.sample(range(1, len(rows)), 3))
        parts = [rows[i:j] for i, j in zip([0] + cut, cut + [len(rows)])]
        target = None
        for p in parts:
            target = apply_changes(target, spark.createDataFrame(p, SCHEMA), "k", "seq")
            target = spark.createDataFrame(target.collect(), SCHEMA)
        assert _rows(target) == expected


def test_merge_upsert_null_keys_never_match(spark):
    target = spark.createDataFrame([("a", 1, "t"), (None, 1, "tn")], SCHEMA)
    source = spark.createDataFrame([("a", 2, "s"), (None, 2, "sn"), ("c", 1, "c")], SCHEMA)
    out = _rows(merge_upsert(target, source, ["k"]))
    assert out == sorted([("a", 2, "s"), (None, 1, "tn"), (None, 2, "sn"), ("c", 1, "c")], key=repr)
    tagged = merge_upsert_tagged(target, source, ["k"])
    assert _rows(tagged.drop("_merge_action")) == out
    acts = {(r.k, r.v): r._merge_action for r in tagged.collect()}
    assert acts[("a", "s")] == "update" and acts[("c", "c")] == "insert"
    assert acts[(None, "sn")] == "insert" and acts[(None, "tn")] == "keep"


def test_merge_upsert_ambiguous_source(spark):
    target = spark.createDataFrame([("a", 1, "t")], SCHEMA)
    source = spark.createDataFrame([("a", 2, "s1"), ("a", 3, "s2")], SCHEMA)
    with pytest.raises(DuplicateKeysError):
        merge_upsert(target, source, ["k"], on_multiple="error")
    assert _rows(merge_upsert(target, source, ["k"], on_multiple="latest", sequence_by="seq")) == [("a", 3, "s2")]
    assert len(_rows(merge_upsert(target, source, ["k"], on_multiple="all"))) == 2


def test_merge_keys_stay_unique(spark):
    rnd = random.Random(3)
    target = spark.createDataFrame([(str(i), i, "t") for i in range(30)], SCHEMA)
    source = spark.createDataFrame([(str(rnd.randint(0, 60)), 0, "s") for _ in range(20)], SCHEMA).dropDuplicates(["k"])
    out = merge_upsert(target, source, ["k"])
    assert out.count() == out.select("k").distinct().count()


def test_retention_months_between(spark):
    df = spark.createDataFrame([("2024-01-14",), ("2024-01-15",), ("2024-03-01",), (None,)], "d string") \
        .withColumn("d", F.to_date("d"))
    kept = [r.d.isoformat() if r.d else None for r in retention(df, "d", 3, as_of="2024-04-15").collect()]
    assert sorted(kept, key=repr) == sorted(["2024-01-15", "2024-03-01", None], key=repr)
    ts = spark.createDataFrame([("2024-01-14 23:00:00",), ("2024-01-15 10:00:00",)], "t string") \
        .withColumn("t", F.col("t").cast("timestamp_ntz"))
    kept = retention(ts, "t", 3, as_of="2024-04-15 00:00:00", kind="timestamp").collect()
    assert [str(r.t) for r in kept] == ["2024-01-15 10:00:00"]


def test_incremental_apply_changes_equals_batch(spark, tmp):
    from stratum.streaming.upsert import UpsertTable
    rnd = random.Random(11)
    rows = [(rnd.choice("abcdefgh"), rnd.randint(0, 9), rnd.choice("xyz")) for _ in range(60)]
    expected = _rows(apply_changes(None, spark.createDataFrame(rows, SCHEMA), "k", "seq"))
    rnd.shuffle(rows)
    table = None
    for i in range(0, len(rows), 15):
        batch = spark.createDataFrame(rows[i:i + 15], SCHEMA)
        if table is None:
            table = UpsertTable(spark, f"{tmp}/t", ["k"], batch.schema, sink_id="ac",
                                on_multiple="latest", sequence_by=["seq"])
        table.merge_batch(batch, i)
    assert _rows(table.read()) == expected
    tagged = merge_upsert_tagged(spark.createDataFrame([("a", 5, "new")], SCHEMA),
                                 spark.createDataFrame([("a", 3, "old")], SCHEMA), ["k"], sequence_by="seq")
    r = tagged.first()
    assert (r.v, r._merge_action) == ("new", "keep")          # an older late change loses


def test_apply_changes_is_idempotent(spark, tmp):
    from stratum.streaming.upsert import UpsertTable
    b = spark.createDataFrame([("a", 2, "x"), ("b", 1, "y"), ("a", 1, "z")], SCHEMA)
    t = UpsertTable(spark, f"{tmp}/t", ["k"], b.schema, sink_id="ac", on_multiple="latest", sequence_by=["seq"])
    t.merge_batch(b, 0)
    once = _rows(t.read())
    assert t.merge_batch(b, 0) is None                     # same batch id: skipped
    m = t.merge_batch(b, 1)                                # same rows again under a new id
    assert _rows(t.read()) == once and m["numTargetRowsInserted"] == 0


def test_merge_of_shared_keys_is_stable(spark):
    b = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), (None, 2, "n")], SCHEMA)
    t = b.limit(0)
    for n in (3, 4, 5):                                        # only the NULL key is added each time
        t = spark.createDataFrame(merge_upsert_tagged(t, b, ["k"]).drop("_merge_action").collect(), SCHEMA)
        assert t.count() == n and t.filter("k = 'a'").count() == 2
