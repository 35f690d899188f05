"""Table registration and housekeeping on path-based parquet tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.operators.changes import months_old, retention


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with what it holds; False if there is none."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def table_exists(spark: SparkSession, path: str) -> bool:
    """A committed table: a batch write leaves ``_SUCCESS``, the stream file sink ``_spark_metadata``."""
    return path_exists(spark, f"{path}/_SUCCESS") or path_exists(spark, f"{path}/_spark_metadata")


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                    dynamic: bool = False, max_records_per_file: int | None = None,
                    optimize_write: bool = False) -> None:
    """Batch overwrite (whole table, or only the partitions present in ``df`` when dynamic).

    ``optimize_write`` rebalances rows by the partition columns first (AQE sizes the output and
    splits a hot partition), so each folder gets a few well-sized files instead of one small file
    per task.
    """
    if optimize_write and partition_by:
        df = df.hint("rebalance", *partition_by)
    # the mode is set on every write, so the session default never changes what is replaced
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def create_target(spark: SparkSession, path: str, schema: StructType,
                  partition_by: Sequence[str] | None = None) -> None:
    """An empty table with a declared schema (the bootstrap of a keyed target)."""
    overwrite_table(spark.createDataFrame([], schema), path, partition_by)


def read_partitioned(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a table with its declared schema, so partition values keep their declared types."""
    return spark.read.schema(schema).parquet(path)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> bool:
    """CREATE TABLE IF NOT EXISTS ... LOCATION, once the location holds committed data (no polling).

    Returns False when nothing has been committed yet; call again after the first batch.
    """
    if not table_exists(spark, path):
        return False
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    if fmt == "parquet":
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.sql(f"MSCK REPAIR TABLE {name}")
    return True


def reset_tables(spark: SparkSession, schema: str, names: Sequence[str]) -> None:
    """CREATE SCHEMA IF NOT EXISTS; USE it; DROP TABLE IF EXISTS each name."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    spark.sql(f"USE {schema}")
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def delete_expired(spark: SparkSession, path: str, schema: StructType, col: str, date_parts: Sequence[str],
                   months: float = 3, as_of: object | None = None, kind: str = "date") -> dict[str, int]:
    """DELETE FROM a stored table WHERE months_between(as_of, col) > months.

    The table is partitioned by ``date_parts``, the (year, month, day) strings of ``col``. Folders of
    expired days are dropped without reading them; a day that expires in part is rewritten; all other
    folders, that of unknown dates included, stay as they are. Doing it again changes nothing.
    """
    fs, root = _fs(spark, path)
    if path_exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} belongs to a stream's file log: its files can't be rewritten")
    glob = root.suffix("/" + "/".join(f"{c}=*" for c in date_parts))
    folders = [st.getPath().toString() for st in fs.globStatus(glob)]   # one per day
    days = [(f, *[p.partition("=")[2] for p in f.split("/")[-len(date_parts):]]) for f in folders]
    days = [d for d in days if all(v.isdigit() for v in d[1:])]
    if not days:
        return {"dropped": 0, "rewritten": 0}
    names = [f"p{i}" for i in range(len(date_parts))]
    first = F.concat_ws("-", *names).cast("date").cast("timestamp")
    last = first if kind == "date" else first + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MICROSECOND")
    ages = spark.createDataFrame(days, ", ".join(f"{n} string" for n in ["folder", *names])) \
        .select("*", (months_old(first, as_of, kind) > months).alias("old"),
                (months_old(last, as_of, kind) > months).alias("all_old")).collect()
    done = {"dropped": 0, "rewritten": 0}
    for day in ages:
        if not day.old:
            continue
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(day.folder)
        if not day.all_old:
            part = read_partitioned(spark, path, schema)
            for c, n in zip(date_parts, names):
                part = part.filter(F.col(c) == F.lit(day[n]))
            staged = f"{path}_retention-{uuid.uuid4().hex[:8]}"
            overwrite_table(retention(part, col, months, as_of, kind), staged, date_parts)
            rest = read_partitioned(spark, staged, schema)
            none_left = rest.isEmpty()
            if not none_left:
                overwrite_table(rest, path, date_parts, dynamic=True)
                done["rewritten"] += 1
            fs.delete(_fs(spark, staged)[1], True)
            if not none_left:
                continue
        fs.delete(folder, True)
        done["dropped"] += 1
    return done


def vacuum_snapshots(spark: SparkSession, root: str, keep: set[str], older_than_hours: float = 168) -> list[str]:
    """Delete snapshot / staging folders under ``root`` that are not in ``keep`` and were last changed
    over ``older_than_hours`` ago, so that a running job's folder stays (C6)."""
    fs, p = _fs(spark, root)
    removed = []
    if not fs.exists(p):
        return removed
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        aged = time.time() - st.getModificationTime() / 1000 >= older_than_hours * 3600
        if st.isDirectory() and name not in keep and aged:
            fs.delete(st.getPath(), True)
            removed.append(name)
    return removed
