"""Enrichment joins and the prefix case expression.

No broadcast hint is forced: the planner broadcasts a side only when its size estimate (file sizes
for a scan) is under ``spark.sql.autoBroadcastJoinThreshold`` — in batch, where AQE re-checks with
runtime sizes, and in every streaming micro-batch — and otherwise shuffles both sides (sort-merge
join, skewed partitions split by AQE). A small lookup is broadcast; a large dimension is not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join a (possibly streaming) frame with a static dimension on shared key column(s)."""
    return df.join(dim, on=on, how=how)


def prefix_case(col: str, mapping: Mapping[str, str], default: str, length: int = 2) -> Column:
    """CASE on the first ``length`` characters of a string; NULL input gets the default."""
    head = F.substring(F.col(col), 1, length)
    expr = None
    for prefix, value in mapping.items():
        expr = (F.when(head == prefix, F.lit(value)) if expr is None
                else expr.when(head == prefix, F.lit(value)))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def with_region(df: DataFrame, col: str = "mpan", mapping: Mapping[str, str] | None = None,
                default: str = "Others", name: str = "dno") -> DataFrame:
    from stratum.plans.voltage import DNO_PREFIXES
    return df.withColumn(name, prefix_case(col, DNO_PREFIXES if mapping is None else mapping, default))


def strip_text(col: str, pattern: str) -> Column:
    """Remove every match of a regex (unanchored), e.g. a '0x' code prefix."""
    return F.regexp_replace(F.col(col), pattern, "")
