"""Summary aggregates and hourly reconciliation.

Every aggregate here is a plain ``groupBy().agg()``: Spark plans a partial aggregate before the
shuffle, so only one row per (partition, group) crosses the network whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def avg_by_key(df: DataFrame, key: str | Sequence[str], cols: str | Sequence[str],
               names: Sequence[str] | None = None, order: Sequence | None = None) -> DataFrame:
    """Average of one or several columns per key, optionally ordered."""
    cols = _as_list(cols)
    names = list(names) if names else [f"avg_{c}" for c in cols]
    out = df.groupBy(*_as_list(key)).agg(*[F.avg(c).alias(n) for c, n in zip(cols, names)])
    return out.orderBy(*order) if order else out


def sum_by_period(df: DataFrame, ts: str, unit: str, col: str, period_name: str = "Date",
                  total_name: str = "TotalSales") -> DataFrame:
    """SUM(col) per truncated period (``date_trunc(unit, ts)``), ordered by period."""
    return (df.groupBy(F.date_trunc(unit, F.col(ts)).alias(period_name))
              .agg(F.sum(col).alias(total_name))
              .orderBy(period_name))


def sum_by_key(df: DataFrame, key: str | Sequence[str], col: str,
               total_name: str = "TotalSales", descending: bool = True) -> DataFrame:
    """SUM(col) per key, ordered by the total (descending by default)."""
    out = df.groupBy(*_as_list(key)).agg(F.sum(col).alias(total_name))
    return out.orderBy(F.col(total_name).desc() if descending else F.col(total_name))


def top_k_by_sum(df: DataFrame, key: str, col: str, k: int = 10,
                 total_name: str = "TotalSales") -> DataFrame:
    """The k keys with the largest SUM(col); ties broken by key ascending so the set is defined.

    Planned as partial/final hash aggregate + TakeOrderedAndProject: each task keeps only its
    own top k, the driver merges k rows per task.
    """
    return (df.groupBy(key).agg(F.sum(col).alias(total_name))
              .orderBy(F.col(total_name).desc(), F.col(key).asc())
              .limit(k))


def distinct_values(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    return df.select(*_as_list(cols)).distinct()


def count_by_window(df: DataFrame, ts: str, size: str = "1 hour", slide: str | None = None,
                    start_name: str = "start_time", end_name: str = "end_time",
                    count_name: str = "count") -> DataFrame:
    """Row count per tumbling (or sliding) time window, with start/end unpacked, ordered."""
    w = F.window(ts, size, slide or size)
    return (df.groupBy(w.alias("window")).agg(F.count(F.lit(1)).alias(count_name))
              .orderBy("window")
              .select(F.col("window.start").alias(start_name), F.col("window.end").alias(end_name),
                      count_name))


def count_by_local_hour(df: DataFrame, utc_ts: str, tz: str, count_name: str = "count") -> DataFrame:
    """Row count per hour of a UTC time, shown with the hour's local beginning and its offset in minutes.

    Hours are told by their UTC instant, so the hour that a clock change repeats is two rows with one
    local name, and the hour that it skips has none.
    """
    utc = F.date_trunc("hour", F.col(utc_ts).cast("timestamp_ntz")).cast("timestamp_ntz")
    hours = df.filter(F.col(utc_ts).isNotNull()).groupBy(utc.alias("utc_start")).agg(F.count(F.lit(1)).alias(count_name))
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), "utc_start")
    minutes = F.timestamp_diff("MINUTE", F.col("utc_start"), F.col("local_start"))
    return hours.withColumn("local_start", local) \
        .select("utc_start", "local_start", minutes.cast("int").alias("offset_minutes"), count_name).orderBy("utc_start")


def reconcile(a: DataFrame, b: DataFrame, on: str | Sequence[str] = "start_time",
              a_name: str = "count_a", b_name: str = "count_b", count_col: str = "count") -> DataFrame:
    """Full outer join of two per-period counts with the difference (missing side counts as 0)."""
    on = _as_list(on)
    left = a.select(*on, F.col(count_col).alias(a_name))
    right = b.select(*on, F.col(count_col).alias(b_name))
    j = left.join(right, on=on, how="full_outer")
    return (j.withColumns({a_name: F.coalesce(a_name, F.lit(0)), b_name: F.coalesce(b_name, F.lit(0))})
             .withColumn("difference", F.col(a_name) - F.col(b_name))
             .orderBy(*on))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per named table with its row count, computed as one Spark job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
