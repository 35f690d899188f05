"""Data layout jobs: multi-column clustering (Z-order), compaction, per-file statistics.

Parquet row-group min/max statistics do the data skipping at read time; these jobs make them
selective by co-locating similar rows in the same files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Size of a data file that layout jobs aim at.
FILE_BYTES = 128 << 20
#: What a sort holds of a row besides its values: header, Z-value and buckets, pointers.
ROW_BYTES = 64
#: Rows and bytes of the sample that the bounds of text columns are taken from.
SAMPLE_ROWS, SAMPLE_BYTES = 50_000, 32 << 20


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _plain_bytes(df: DataFrame) -> int:
    """About the bytes that a sort holds for the frame's rows: ROW_BYTES each, 8 a column, texts by their own length
    and nested values by that of their JSON. One pass, which reads only the columns of these two kinds."""
    size = F.lit(ROW_BYTES + 8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        c, kind = _col(f.name), f.dataType.typeName()
        if _is_text(df, f.name) or kind in ("array", "map", "struct", "variant"):
            text = c if _is_text(df, f.name) else F.to_json(c)
            size = size + F.coalesce(F.octet_length(text), F.lit(0))
    return df.agg(F.sum(size)).first()[0] or 0


def file_count(df: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """Files to write for the frame's size: the planner's statistics, or the plain size of its rows where that is
    more. Stored columns may be packed many times over, while the task that sorts a file holds whole rows."""
    stored = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, -(-max(stored, _plain_bytes(df)) // file_bytes))


def _rank(df: DataFrame, col: str) -> Column:
    """An order-preserving number for a column of numbers, dates, timestamps (with or without zone, by
    microseconds) or booleans."""
    kind, c = df.schema[col].dataType.typeName(), F.col(col)
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("int").cast("double") if kind == "boolean" else c.cast("double")


def _is_text(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() in ("string", "binary", "varchar", "char")


def _as_text(df: DataFrame, col: str) -> Column:
    """Text in the order of its bytes; binary values as hex, which keeps their order."""
    return F.hex(col) if df.schema[col].dataType.typeName() == "binary" else F.col(col).cast("string")


def _text_bounds(df: DataFrame, cols: Sequence[str], bits: int) -> dict[str, list[str]]:
    """Per column, up to 2^bits - 1 ascending values that cut a sample of its whole values evenly.

    One pass takes the sample of all columns; its rows (SAMPLE_ROWS) and bytes (SAMPLE_BYTES) are bounded
    whatever the size of the table or of its values.
    """
    size = F.lit(0)
    for c in cols:
        size = size + F.coalesce(F.octet_length(_as_text(df, c)), F.lit(0))
    rows, total = df.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    share = min(1.0, SAMPLE_ROWS / max(1, rows), SAMPLE_BYTES / max(1, total or 0))
    sample = df.select(*[_as_text(df, c).alias(c) for c in cols])
    sample = sample if share == 1.0 else sample.sample(share, seed=7)
    found = sample.agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in cols]).first()
    out = {}
    for c in cols:
        values, n = found[c], 1 << bits
        out[c] = sorted({values[len(values) * i // n] for i in range(1, n)}, key=lambda v: v.encode()) if values else []
    return out


def _text_bucket(col: Column, bounds: list[str], bits: int) -> Column:
    """How many bounds are not above the value, stretched over [0, 2^bits): a binary search over the
    whole value. NULL is 0."""
    if not bounds:
        return F.lit(0).cast("long")
    steps, n = [1 << i for i in reversed(range(len(bounds).bit_length()))], len(bounds)
    values = F.lit(bounds)
    at = F.aggregate(F.lit(steps), F.lit(0), lambda i, step: F.when(
        F.coalesce(F.get(values, i + step - 1) <= col, F.lit(False)), i + step).otherwise(i))
    return F.coalesce(F.floor(at * F.lit(float(((1 << bits) - 1) / n))).cast("long"), F.lit(0))


def _quantile_buckets(df: DataFrame, cols: Sequence[str], bits: int, relative_error: float) -> DataFrame:
    """Rank-bucket every column into [0, 2^bits): numbers by approximate quantile bounds (JVM binary search),
    text by bounds of whole values.

    One pass computes the bounds of all columns of a kind together; only 2^bits bounds per column reach the
    plan, whatever the table size. NULLs get the last bucket of numbers, the first of text.
    """
    from pyspark.ml.feature import QuantileDiscretizer
    text = [c for c in cols if _is_text(df, c)]
    out = df
    if text:
        bounds = _text_bounds(df, text, bits)
        out = out.withColumns({f"__zb_{c}": _text_bucket(_as_text(df, c), bounds[c], bits) for c in text})
    cols = [c for c in cols if c not in text]
    if not cols:
        return out
    src = [f"__zsrc_{c}" for c in cols]
    out = out.withColumns({s: _rank(df, c) for s, c in zip(src, cols)})
    qd = QuantileDiscretizer(numBuckets=1 << bits, inputCols=src, outputCols=[f"__zb_{c}" for c in cols],
                             relativeError=relative_error, handleInvalid="keep")
    model = qd.fit(out)
    out = model.transform(out).drop(*src)
    for c, splits in zip(cols, model.getSplitsArray()):
        # a low-cardinality column gets fewer buckets than asked for: stretch its bucket index over
        # the full bit range, or its bits would all sit at the bottom of the interleaved key
        n = max(1, len(splits) - 1)
        scaled = F.floor(F.col(f"__zb_{c}") * F.lit(float(1 << bits) / n)).cast("long")
        out = out.withColumn(f"__zb_{c}", F.least(scaled, F.lit((1 << bits) - 1)))
    return out


def _row_hash(df: DataFrame) -> Column:
    """A hash of all columns that Spark can hash."""
    return F.xxhash64(*[_col(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def zorder_value(cols: Sequence[str], bits: int) -> Column:
    """Interleave the bits of the per-column buckets: bit i of column j -> bit i*n + j."""
    n = len(cols)
    z = F.lit(0).cast("long")
    for i in range(bits):
        for j, c in enumerate(cols):
            bit = F.shiftright(F.col(f"__zb_{c}"), i).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, i * n + j))
    return z


def cluster_by_zorder(df: DataFrame, cols: Sequence[str], files: int | None = None, bits: int | None = None,
                      relative_error: float = 0.001) -> DataFrame:
    """Rows range-partitioned into ``files`` partitions by Z-value and sorted within each. By default there are as
    many as the size asks for, and rows of one Z-value may go to several, by a hash of the whole row: else a value
    that most rows share would put them into one task, however large the table is."""
    cols = list(cols)
    ranges = ["__z"] if files else ["__z", _row_hash(df)]
    files = files or file_count(df)
    bits = bits or max(1, min(10, 62 // len(cols)))
    b = _quantile_buckets(df, cols, bits, relative_error)
    z = b.withColumn("__z", zorder_value(cols, bits))
    return (z.repartitionByRange(files, *ranges).sortWithinPartitions("__z")
             .drop("__z", *[f"__zb_{c}" for c in cols]))


def sort_cluster(df: DataFrame, col: str, files: int) -> DataFrame:
    """One clustering column: the Z-order degenerates to a range sort."""
    return df.repartitionByRange(files, col).sortWithinPartitions(col)


def compact(df: DataFrame) -> DataFrame:
    """Rebalance into evenly sized partitions (AQE advisory size) before a rewrite: merges small
    files and splits large ones without counting the rows first."""
    return df.hint("rebalance")


def table_files(df: DataFrame) -> DataFrame:
    """One row per data file of a file-based frame: path, rows, bytes."""
    return (df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
              .groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.first("bytes").alias("bytes")))


def file_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per-file min / max of the given columns (what file-level data skipping consults)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(*aggs)


def files_overlapping(stats: DataFrame, col: str, value) -> DataFrame:
    """Files whose [min, max] of ``col`` contains ``value`` (the files a point predicate must read)."""
    v = F.lit(value)
    return stats.filter((F.col(f"min_{col}") <= v) & (F.col(f"max_{col}") >= v))
