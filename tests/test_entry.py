"""The driver contract on the smoke scale: entry runs, every query has a stable schema, and a few
fast queries agree with their DuckDB oracle."""

import duckdb

import __spark_entry__ as entry

FAST = ["retail_quality", "apply_changes_latest", "retail_sales_by_country", "voltage_silver",
        "region_case", "json_apply_changes", "cols_lower", "recon_history_event", "retention_delete"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["Country", "TotalSales"]


def test_every_query_has_oracle_or_is_listed():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    own = set(q) - set(entry.llm.QUERIES if entry.llm else {})
    assert own - set(o) == {"file_report", "zorder_overlap"}


def _digest(pdf):
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from oracle_check import digest
    return digest(pdf)[:3]


def test_fast_queries_match_oracle(spark, sf):
    con = duckdb.connect()
    for t in ["nation", "customer", "part", "orders", "lineitem", "events"]:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in FAST:
        got = entry.queries()[name](spark, sf).toPandas()
        exp = con.sql(entry.oracle_sql()[name]).df()
        assert _digest(got) == _digest(exp), name
