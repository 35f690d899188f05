from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.operators.quality import (expect, expect_or_drop, expectation_counts, quarantine,
                                       split_by_rules)

RULES = {"has_a": "a IS NOT NULL", "small_b": "b < 10"}


def _df(spark, rows):
    return spark.createDataFrame(rows, "a string, b int")


def test_null_counts_as_violation(spark):
    df = _df(spark, [("x", 1), (None, 1), ("y", None), ("z", 20)])
    assert [r.a for r in expect_or_drop(df, RULES).collect()] == ["x"]


def test_warn_keeps_rows_and_counts(spark):
    df = _df(spark, [("x", 1), (None, 1), ("y", None), ("z", 20)])
    kept, obs = expect(df, RULES)
    assert kept.count() == 4
    assert obs.get == {"violations_has_a": 1, "violations_small_b": 2, "rows": 4}
    row = expectation_counts(df, RULES).first()
    assert (row.rows, row.violations_has_a, row.violations_small_b) == (4, 1, 2)


def test_quarantine_is_literal_predicate(spark):
    df = _df(spark, [("x", 1), (None, 1), ("y", 20)])
    assert quarantine(df, "a IS NULL").count() == 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["p", "q"])),
                          st.one_of(st.none(), st.integers(-5, 30))), max_size=30))
def test_split_is_a_true_complement(spark, rows):
    df = _df(spark, rows)
    good, bad = split_by_rules(df, RULES)
    g = sorted(map(tuple, good.collect()), key=repr)
    b = bad.collect()
    assert len(g) + len(b) == len(rows)
    assert sorted(g + [(r.a, r.b) for r in b], key=repr) == sorted(rows, key=repr)
    for r in b:
        assert r.failed_rules and set(r.failed_rules) <= set(RULES)
        assert ("has_a" in r.failed_rules) == (r.a is None)


def test_warn_metrics_on_a_stream(spark, tmp):
    from stratum.streaming.sinks import memory_stream
    spark.createDataFrame([("x", 1), (None, 2), ("z", 30)], "a string, b int").write.parquet(f"{tmp}/in")
    src = spark.readStream.schema("a string, b int").parquet(f"{tmp}/in")
    df, name = expect(src, RULES, name="stream_rules")
    q = memory_stream(df, "warn_stream")
    q.awaitTermination()
    m = [p["observedMetrics"][name] for p in q.recentProgress if p.get("observedMetrics")][0]
    assert (m["rows"], m["violations_has_a"], m["violations_small_b"]) == (3, 1, 1)
    assert spark.table("warn_stream").count() == 3
