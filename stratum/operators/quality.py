"""Row-level expectations: warn, drop, quarantine, and the true good/bad split (Q1-Q5).

A rule set is a mapping ``name -> predicate`` where the predicate is a SQL string or a Column.
A row *passes* a rule only when the predicate is TRUE; NULL counts as a violation.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, "str | Column"]


def _pred(p: str | Column) -> Column:
    return F.expr(p) if isinstance(p, str) else p


def passes(p: str | Column) -> Column:
    """TRUE iff the predicate is TRUE (NULL -> FALSE)."""
    return F.coalesce(_pred(p), F.lit(False))


def all_pass(rules: Rules) -> Column:
    return reduce(lambda a, b: a & b, [passes(p) for p in rules.values()], F.lit(True))


def expect(df: DataFrame, rules: Rules, name: str = "expectations") -> tuple[DataFrame, Observation | str]:
    """Warn-only expectations: rows are kept and the violations of each rule are counted.

    The counts are gathered by ``observe`` while the result is produced (no extra pass over the
    data). Batch: read them from the returned ``Observation`` (``.get``) after an action. Stream: the
    metrics are named ``name`` in every micro-batch's ``query.lastProgress['observedMetrics']``
    (the name is returned instead of an Observation).
    """
    metrics = [F.count_if(~passes(p)).alias(f"violations_{k}") for k, p in rules.items()]
    metrics.append(F.count(F.lit(1)).alias("rows"))
    if df.isStreaming:
        return df.observe(name, *metrics), name
    obs = Observation(name)
    return df.observe(obs, *metrics), obs


def expectation_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """The same violation counts as a one-row DataFrame (a distributed aggregate)."""
    cols = [F.count(F.lit(1)).alias("rows")]
    cols += [F.count_if(~passes(p)).alias(f"violations_{k}") for k, p in rules.items()]
    return df.agg(*cols)


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep a row iff every rule is TRUE."""
    return df.filter(all_pass(rules))


def quarantine(df: DataFrame, bad: str | Column) -> DataFrame:
    """Keep the rows meeting a 'bad' predicate (literal predicate, as declared)."""
    return df.filter(passes(bad))


def failed_rules(rules: Rules) -> Column:
    """array<string> of the names of the rules a row violates (empty when it passes all)."""
    flags = [F.when(~passes(p), F.lit(k)) for k, p in rules.items()]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def split_by_rules(df: DataFrame, rules: Rules, col: str = "failed_rules") -> tuple[DataFrame, DataFrame]:
    """(good, bad) as a true complement; bad rows carry the names of the failed rules."""
    tagged = df.withColumn(col, failed_rules(rules))
    good = tagged.filter(F.size(col) == 0).drop(col)
    bad = tagged.filter(F.size(col) > 0)
    return good, bad
