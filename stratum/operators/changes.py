"""Keyed change application, merge upsert, dedupe and retention.

All of these are shuffles on the key columns and nothing else. ``latest_per_key`` aggregates
``max(struct(sequence, ...))`` instead of ranking with ``row_number()`` over a window: the partial
(map-side) aggregate collapses a hot key to one row per input partition before the shuffle, so a
key holding a third of the table costs no more shuffle than any other key. (A struct buffer is
planned as a sort-based aggregate; it spills like any sort and needs no per-key memory.)
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def latest_per_key(df: DataFrame, keys: str | Sequence[str], sequence_by: str | Sequence[str],
                   tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the greatest ``sequence_by``; ties go to the remaining columns, descending.

    The order is total: (sequence..., tie_break..., every other column in frame order). A NULL
    sequence sorts lowest, so a row with a known sequence always wins over one without.
    """
    keys, seq = _as_list(keys), _as_list(sequence_by)
    rest = [c for c in df.columns if c not in keys and c not in seq]
    order = seq + [c for c in (tie_break or []) if c in rest]
    order += [c for c in rest if c not in order]
    packed = F.max(F.struct(*[F.col(c) for c in order])).alias("_latest")
    return (df.groupBy(*keys).agg(packed)
              .select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in order])
              .select(*df.columns))


def apply_changes(target: DataFrame | None, changes: DataFrame, keys: str | Sequence[str],
                  sequence_by: str | Sequence[str]) -> DataFrame:
    """Type-1 apply-changes: per key keep the row with the greatest sequence over target ∪ changes.

    An older change arriving late never overwrites a newer stored row, because the stored row
    competes on the same sequence. The result does not depend on arrival order or batch split.
    """
    both = changes if target is None else target.unionByName(changes, allowMissingColumns=True)
    return latest_per_key(both, keys, sequence_by)


class DuplicateKeysError(ValueError):
    pass


def merge_upsert(target: DataFrame, source: DataFrame, keys: str | Sequence[str],
                 on_multiple: str = "error", sequence_by: str | Sequence[str] | None = None,
                 check: bool = True) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *, as a DataFrame.

    Result = source ∪ (target rows whose key is not in source). Keys compare with ``=``, so a NULL
    key never matches: such target rows are kept and such source rows inserted.

    ``on_multiple``: several source rows with one key are ambiguous. ``"error"`` raises
    (after a distributed check), ``"latest"`` keeps the latest by ``sequence_by`` (else by all
    columns), ``"all"`` inserts them all.
    """
    keys = _as_list(keys)
    if on_multiple == "latest":
        non_null = F.lit(True)
        for k in keys:
            non_null = non_null & F.col(k).isNotNull()
        source = (latest_per_key(source.filter(non_null), keys, sequence_by or [])
                  .unionByName(source.filter(~non_null)))
    elif on_multiple == "error" and check:
        dup = (source.dropna(subset=keys).groupBy(*keys).count().filter("count > 1").limit(1).collect())
        if dup:
            raise DuplicateKeysError(f"several source rows share key {dup[0].asDict()}")
    keep = target.join(source.select(*keys).dropna(), on=keys, how="left_anti")
    return source.unionByName(keep, allowMissingColumns=True)


def merge_upsert_tagged(target: DataFrame, source: DataFrame, keys: str | Sequence[str],
                        action_col: str = "_merge_action",
                        sequence_by: str | Sequence[str] | None = None) -> DataFrame:
    """The same MERGE, each row tagged 'update', 'insert' or 'keep'.

    All target rows whose key is in the source give way to the source's rows of that key, so applying a
    batch again leaves the table as it is, also where several rows share a key. NULL keys match
    nothing and go around the joins.

    With ``sequence_by`` it is apply-changes instead: a matched key takes the source row only if
    its (sequence, other columns) is greater than the stored row's, in the total order of
    ``latest_per_key``; an older change arriving late leaves the stored row ('keep').
    """
    names = _as_list(keys)
    known = F.lit(True)
    for k in names:
        known = known & F.col(k).isNotNull()
    source = source.select(*target.columns)
    around = source.filter(~known).withColumn(action_col, F.lit("insert")) \
        .unionByName(target.filter(~known).withColumn(action_col, F.lit("keep")))
    source, target = source.filter(known), target.filter(known)
    if sequence_by:
        return _apply_tagged(target, source, names, action_col, sequence_by).unionByName(around)
    had = target.select(*names).distinct().withColumn(action_col, F.lit("update"))
    taken = source.join(had, names, "left").select(*source.columns, F.coalesce(action_col, F.lit("insert")).alias(action_col))
    kept = target.join(source.select(*names), names, "left_anti").select(*target.columns, F.lit("keep").alias(action_col))
    return taken.unionByName(kept).unionByName(around)


def _apply_tagged(target: DataFrame, source: DataFrame, keys: list[str], action_col: str,
                  sequence_by: str | Sequence[str]) -> DataFrame:
    cols = [c for c in target.columns]
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_s"))
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t"))
    cond = None
    for k in keys:
        e = F.col(f"_s_{k}") == F.col(f"_t_{k}")
        cond = e if cond is None else cond & e
    j = s.join(t, on=cond, how="full_outer")
    has_s = F.coalesce(F.col("_s"), F.lit(False))
    has_t = F.coalesce(F.col("_t"), F.lit(False))
    seq = _as_list(sequence_by)
    order = seq + [c for c in cols if c not in keys and c not in seq]
    newer = F.struct(*[F.col(f"_s_{c}") for c in order]) > F.struct(*[F.col(f"_t_{c}") for c in order])
    take_s = has_s & (~has_t | newer)
    out = [F.when(take_s, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in cols]
    action = (F.when(take_s & has_t, F.lit("update")).when(take_s, F.lit("insert"))
               .otherwise(F.lit("keep")))
    return j.select(*out, action.alias(action_col))


def dedupe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop duplicate rows on a column subset (any one row per group survives)."""
    return df.dropDuplicates(list(cols) if cols else None)


def _as_of_col(as_of: object | None, kind: str) -> Column:
    if as_of is None:
        return F.current_date() if kind == "date" else F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (dt.date, dt.datetime)):
        return F.lit(as_of)
    return F.lit(as_of).cast("date" if kind == "date" else "timestamp")


def months_old(col: Column, as_of: object | None, kind: str = "date") -> Column:
    return F.months_between(_as_of_col(as_of, kind), col)


def retention(df: DataFrame, col: str, months: float = 3, as_of: object | None = None,
              kind: str = "date") -> DataFrame:
    """Rows that survive ``DELETE ... WHERE months_between(as_of, col) > months``.

    A row whose age is unknown (NULL) is kept, as DELETE would keep it.
    """
    old = months_old(F.col(col), as_of, kind) > F.lit(months)
    return df.filter(~F.coalesce(old, F.lit(False)))
