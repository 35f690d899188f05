"""Batch and streaming file sources.

Streaming sources always carry an explicit schema (inferred once from a bounded sample, or given
as a StructType / DDL string): a file stream never re-infers per batch, and a fixed schema lets
the parquet / CSV reader prune columns and push filters exactly as in batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Schema = "StructType | str"


def read_csv(spark: SparkSession, path: str | list[str], schema: Schema | None = None,
             header: bool = True, sampling_ratio: float | None = None, **options) -> DataFrame:
    """CSV batch read with a header; types inferred unless a schema is given."""
    r = spark.read.option("header", header)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
        if sampling_ratio:
            r = r.option("samplingRatio", sampling_ratio)
    return r.options(**options).csv(path)


def infer_schema(spark: SparkSession, path: str | list[str], fmt: str = "csv",
                 sampling_ratio: float = 1.0, **options) -> StructType:
    """Infer a schema once and keep only the schema.

    Every file is read (a distributed pass), so a value or a column that only some file holds counts;
    ``sampling_ratio`` below 1 is the caller's own choice to look at fewer rows.
    """
    r = spark.read.options(**options).option("samplingRatio", sampling_ratio)
    if fmt == "csv":
        r = r.option("header", options.get("header", True)).option("inferSchema", True)
    return r.format(fmt).load(path).schema


def stream_files(spark: SparkSession, path: str, fmt: str, schema: Schema,
                 max_files: int | None = None, **options) -> DataFrame:
    """An append stream over files landing under ``path``.

    The checkpoint of the consuming query remembers processed files, so every file is read once.
    """
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        r = r.option("header", options.pop("header", True))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.options(**options).load(path)


def stream_table(spark: SparkSession, path: str, schema: Schema | None = None,
                 max_files: int | None = None, fmt: str = "parquet", **options) -> DataFrame:
    """Stream an upstream table written by another query.

    The file source only ever lists *new* files, so deletes upstream (retention) are never
    replayed downstream; ``ignoreMissingFiles`` lets a batch skip a file deleted after listing.
    """
    if schema is None:
        schema = spark.read.format(fmt).options(**options).load(path).schema
    r = spark.readStream.format(fmt).schema(schema).option("ignoreMissingFiles", True).options(**options)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


#: Bytes of input that make a task of their own when a narrow scan is dealt out.
TASK_BYTES = 1 << 18


def scan_bytes(df: DataFrame) -> int:
    """Bytes of the files and tables that a frame reads (the planner's sizes of its leaves; no job)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def redistribute(df: DataFrame, task_bytes: int = TASK_BYTES, width: int | None = None) -> DataFrame:
    """Deal rows out before heavy work per row (P17), to a task per ``task_bytes`` of input, at most as many
    as run at once. A scan that is as wide by its own splits is left as it is, so at scale nothing is
    shuffled; ``width`` sets the number of partitions outright (streams have no size to go by)."""
    if width:
        return df.repartition(width)
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores, size = spark.sparkContext.defaultParallelism, scan_bytes(df)
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    wanted = min(cores, -(-size // task_bytes))
    return df.repartition(wanted) if wanted > 1 and size < cores * split else df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Snapshot read of a table."""
    return spark.read.format(fmt).options(**options).load(path)


def read_lookup(spark: SparkSession, path: str, schema: Schema,
                renames: Mapping[str, str] | None = None, **options) -> DataFrame:
    """CSV lookup with an explicit schema (headers may hold spaces) and renames."""
    df = spark.read.option("header", True).options(**options).schema(schema).csv(path)
    return df.withColumnsRenamed(dict(renames)) if renames else df


def with_input_file(df: DataFrame, name: str = "inputFileName") -> DataFrame:
    """Add the path of the file each row came from (S7); works on batch and stream."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def from_rows(spark: SparkSession, rows: Iterable[Mapping], schema: Schema | None = None) -> DataFrame:
    """Small in-memory rows -> DataFrame (S14; tests and dimension seeds)."""
    from pyspark.sql import Row
    return spark.createDataFrame([Row(**r) for r in rows], schema=schema)


def empty_like(df: DataFrame) -> DataFrame:
    """An empty DataFrame with another's schema."""
    return df.sparkSession.createDataFrame([], df.schema)


def path_query(spark: SparkSession, sql: str, **paths: str) -> DataFrame:
    """Run SQL that names tables by path, e.g. ``FROM parquet.`{bronze}```."""
    return spark.sql(sql.format(**{k: v for k, v in paths.items()}))
