import uuid


from stratum.operators.schema import merge_schemas, read_merged
from stratum.sources.catalog import (describe, register_table, reset_tables, table_exists,
                                     vacuum_snapshots)
from stratum.sources.files import empty_like, from_rows
from stratum.streaming.datasets import Dataset, create_target, live_table, streaming_table


def test_register_only_after_first_commit(spark, tmp):
    name = f"t_{uuid.uuid4().hex[:8]}"
    assert not table_exists(spark, f"{tmp}/t") and not register_table(spark, name, f"{tmp}/t")
    spark.range(5).write.parquet(f"{tmp}/t")
    assert register_table(spark, name, f"{tmp}/t") and spark.table(name).count() == 5
    info = {r.col_name: r.data_type for r in describe(spark, name).collect()}
    assert "Location" in info


def test_declared_datasets_carry_comment_and_tier(spark, tmp):
    db = f"db_{uuid.uuid4().hex[:8]}"
    reset_tables(spark, db, ["gold"])
    try:
        src = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "k string, v int")
        ds = Dataset("gold", f"{tmp}/gold", comment="summary table", properties={"quality": "gold"},
                     drop_rules={"has_v": "v IS NOT NULL"})
        out = live_table(spark, ds, src)
        assert sorted(r.k for r in out.collect()) == ["a", "c"]
        props = {r.col_name: r.data_type for r in describe(spark, "gold").collect()}
        assert props.get("Comment") == "summary table" and "quality" in props.get("Table Properties", "")
        # temporary streaming dataset: handed on, not written
        spark.range(3).write.parquet(f"{tmp}/in")
        stream = spark.readStream.schema("id long").parquet(f"{tmp}/in")
        tmpds = streaming_table(spark, Dataset("scratch_view", temporary=True), stream)
        assert tmpds.isStreaming and not table_exists(spark, f"{tmp}/scratch_view")
        # declared empty target
        create_target(spark, Dataset("target", f"{tmp}/target"), src.schema)
        assert spark.table("target").count() == 0
    finally:
        spark.sql("USE default")


def test_empty_like_and_from_rows(spark):
    df = from_rows(spark, [{"a": 1, "b": "x"}])
    e = empty_like(df)
    assert e.schema == df.schema and e.count() == 0


def test_merge_schemas_and_read_merged(spark, tmp):
    a = spark.createDataFrame([(1, "x")], "id long, s string")
    b = spark.createDataFrame([(2, "y", 5.0)], "id long, s string, extra double")
    m = merge_schemas(a, b)
    assert m.columns == ["id", "s", "extra"] and m.filter("id = 1").first().extra is None
    a.write.parquet(f"{tmp}/p0")
    b.write.parquet(f"{tmp}/p1")
    r = read_merged(spark, f"{tmp}/p0", f"{tmp}/p1")
    assert set(r.columns) == {"id", "s", "extra"} and r.count() == 2


def test_vacuum_snapshots(spark, tmp):
    for v in ["v=0", "v=1", "v=2"]:
        spark.range(1).write.parquet(f"{tmp}/snap/{v}")
    assert vacuum_snapshots(spark, f"{tmp}/snap", keep={"v=2"}) == []      # too young
    removed = vacuum_snapshots(spark, f"{tmp}/snap", keep={"v=2"}, older_than_hours=0)
    assert sorted(removed) == ["v=0", "v=1"] and table_exists(spark, f"{tmp}/snap/v=2")


def test_delete_expired_equals_the_filter(spark, tmp):
    from pyspark.sql import functions as F
    from stratum.functions.datetime import with_time_parts
    from stratum.operators.changes import retention
    from stratum.sources.catalog import delete_expired, overwrite_table, read_partitioned
    # a row every five hours over five months, some without a time
    df = spark.range(720).select("id", F.when(F.col("id") % 50 != 7, F.expr(
        "timestamp_ntz'2024-01-01 01:00:00' + make_interval(0, 0, 0, 0, cast(id * 5 as int))")).alias("t"))
    df = with_time_parts(df, "t", "e").drop("e_date", "e_hour")
    parts = ["e_year", "e_month", "e_day"]
    # fractions of months expire within a day
    for n, (months, as_of) in enumerate([(3, "2024-05-15 00:00:00"), (2.3, "2024-05-31 13:00:00"), (0, "2025-01-01 00:00:00"),
                                         (90, "2024-05-15 00:00:00")]):
        path = f"{tmp}/r{n}"
        overwrite_table(df, path, parts)
        done = delete_expired(spark, path, df.schema, "t", parts, months, as_of, "timestamp")
        expected = sorted(r.id for r in retention(df, "t", months, as_of, "timestamp").collect())
        assert sorted(r.id for r in read_partitioned(spark, path, df.schema).collect()) == expected
        assert (done["rewritten"] == 1) == (months == 2.3) and (done["dropped"] == 0) == (months == 90)
        again = delete_expired(spark, path, df.schema, "t", parts, months, as_of, "timestamp")
        assert again["dropped"] == 0
