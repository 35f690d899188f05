from pyspark.sql import functions as F

from stratum.operators import layout


def _multiset(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_zorder_and_compact_keep_rows(spark, sf, tmp):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    layout.cluster_by_zorder(ev, ["user_id", "value"], 8).write.parquet(f"{tmp}/z")
    z = spark.read.parquet(f"{tmp}/z")
    assert _multiset(z.select(*ev.columns)) == _multiset(ev)
    ev.repartition(32).write.parquet(f"{tmp}/small")
    layout.compact(spark.read.parquet(f"{tmp}/small")).write.parquet(f"{tmp}/c")
    c = spark.read.parquet(f"{tmp}/c")
    assert _multiset(c.select(*ev.columns)) == _multiset(ev)
    assert c.inputFiles().__len__() < 32


def test_zorder_makes_point_predicates_selective(spark, sf, tmp):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    ev.repartition(8).write.parquet(f"{tmp}/rr")
    layout.cluster_by_zorder(ev, ["user_id", "value"], 8).write.parquet(f"{tmp}/z")

    def overlap(path, col, v):
        stats = layout.file_stats(spark.read.parquet(path), ["user_id", "value"])
        return layout.files_overlapping(stats, col, v).count(), stats.count()

    med = ev.agg(F.percentile_approx("user_id", 0.5).alias("u"), F.percentile_approx("value", 0.5).alias("v")).first()
    for col, v in [("user_id", med.u), ("value", med.v)]:
        rr, n_rr = overlap(f"{tmp}/rr", col, v)
        zz, n_z = overlap(f"{tmp}/z", col, v)
        assert rr == n_rr                     # round-robin files all overlap
        assert zz < n_z                       # clustered files let most be skipped


def test_table_files(spark, tmp):
    spark.range(100).repartition(4).write.parquet(f"{tmp}/t")
    rep = layout.table_files(spark.read.parquet(f"{tmp}/t")).collect()
    assert len(rep) == 4 and sum(r.rows for r in rep) == 100 and all(r.bytes > 0 for r in rep)


def test_zorder_takes_text_dates_and_ntz(spark, tmp):
    df = spark.range(200).select("id", F.when(F.col("id") % 9 != 0, F.concat(F.lit("n"), F.col("id") % 7)).alias("name"),
                                 F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,id)").alias("ts"),
                                 F.expr("date'2024-01-01' + cast(id as int)").alias("day"), (F.col("id") % 2 == 0).alias("flag"))
    layout.cluster_by_zorder(df, ["name", "ts", "day", "flag"], 4).write.parquet(f"{tmp}/z")
    assert _multiset(spark.read.parquet(f"{tmp}/z")) == _multiset(df)
    spread = layout.file_stats(spark.read.parquet(f"{tmp}/z"), ["ts"])
    assert layout.files_overlapping(spread, "ts", df.first().ts).count() < 4


def test_file_count_follows_bytes(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    assert layout.file_count(ev, 1 << 40) == 1 and layout.file_count(ev, 1024) > layout.file_count(ev, 4096) > 1


def test_sort_cluster_ranges_do_not_overlap(spark, tmp):
    layout.sort_cluster(spark.range(1000).withColumn("v", F.col("id") * 7 % 1000), "v", 4).write.parquet(f"{tmp}/s")
    stats = sorted((r.min_v, r.max_v) for r in layout.file_stats(spark.read.parquet(f"{tmp}/s"), ["v"]).collect())
    assert all(a[1] < b[0] for a, b in zip(stats, stats[1:]))


def test_prefix_case_custom_mapping(spark):
    from stratum.operators.joins import prefix_case
    df = spark.createDataFrame([("ab1",), ("cd2",), (None,)], "x string")
    out = [r.y for r in df.select(prefix_case("x", {"ab": "A", "cd": "C"}, "other").alias("y")).collect()]
    assert out == ["A", "C", "other"]


def test_file_count_of_packed_rows_follows_their_plain_size(spark, tmp):
    spark.range(20_000).select(F.lit("a").alias("a"), F.lit(1.0).alias("b")).coalesce(1).write.parquet(f"{tmp}/p")
    packed = spark.read.parquet(f"{tmp}/p")
    assert layout.file_count(packed, 1 << 16) >= 5           # a few hundred bytes are stored
    layout.cluster_by_zorder(packed, ["b"], bits=2).write.parquet(f"{tmp}/z")
    assert spark.read.parquet(f"{tmp}/z").count() == 20_000


def test_file_count_follows_the_length_of_packed_texts(spark, tmp):
    spark.range(2_000).select("id", F.expr("repeat('a', 1000)").alias("a.b"), F.expr("map('k', array(repeat('b', 1000)))").alias("m"),
                              F.lit(None).cast("string").alias("n")).coalesce(1).write.parquet(f"{tmp}/p")
    packed = spark.read.parquet(f"{tmp}/p")
    assert 4 <= layout.file_count(packed, 1 << 20) <= 5      # 4.2 MB of rows, a few KB stored
    assert layout.file_count(packed.drop("m"), 1 << 20) == layout.file_count(packed.drop("a.b"), 1 << 20) == 3
    assert layout.file_count(packed.filter("id < 0").select("id"), 1 << 40) == 1


def test_zorder_cuts_a_value_that_most_rows_share(spark, tmp, monkeypatch):
    monkeypatch.setattr(layout.file_count, "__defaults__", (1 << 16,))
    df = spark.range(4_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("u"), F.expr("map('k', id)").alias("m.m"))
    layout.cluster_by_zorder(df, ["u"]).write.parquet(f"{tmp}/z")
    stored = spark.read.parquet(f"{tmp}/z")
    rows = [r["rows"] for r in layout.table_files(stored).collect()]
    assert len(rows) >= 4 and sum(rows) == 4_000 and max(rows) < 2_000      # 3,600 rows have no u
    assert sorted(r.id for r in stored.select("id").collect()) == list(range(4_000))
    assert layout.files_overlapping(layout.file_stats(stored, ["u"]), "u", 2000).count() == 1
