"""A keyed parquet table updated by MERGE-style upserts, one micro-batch at a time.

Per batch:

1. dedupe the batch, if ``dedupe_cols`` are given; new columns widen the table's schema (``evolved``);
2. read only the target partitions the batch touches, by a semi-join on the partition columns. Where they
   don't derive from a merge key (``partition_from_keys``), the partitions that hold the batch's keys are looked
   up too, so that a key that moves is stored once;
3. merge, tagging every row update / insert / keep, and write the
   touched partitions to a staging folder; the tag counts come from an ``Observation`` on that write;
4. put the staged folders in the place of just those partitions of the table (where keys may move between
   partitions, by a dynamic overwrite from the staged copy);
5. append one commit row (sink id, batch id, version, metrics) to the table's commit log.

A replayed batch id that is already committed by the same streaming query is skipped; a query that starts
anew, on a fresh checkpoint, has an id of its own and its batches count from 0 again. A batch that failed after staging is
re-published from its staged copy, so partitions are never recomputed from a half-written target.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (LongType, MapType, StringType, StructField, StructType,
                               TimestampNTZType)

from stratum.operators.changes import dedupe, latest_per_key, merge_upsert_tagged
from stratum.operators.schema import evolved
from stratum.sources.catalog import _fs, overwrite_table, path_exists, table_exists

COMMIT_SCHEMA = StructType([
    StructField("sink_id", StringType()),
    StructField("batch_id", LongType()),
    StructField("version", LongType()),
    StructField("timestamp", TimestampNTZType()),
    StructField("operation", StringType()),
    StructField("operationMetrics", MapType(StringType(), StringType())),
])


class CommitLog:
    """Append-only parquet log: one row per committed write (the table history). One writer."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._version: int | None = None
        self._committed: set | None = None     # (sink_id, batch_id) pairs; loaded once, one writer

    def read(self) -> DataFrame:
        if not table_exists(self.spark, self.path):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(self.path)

    def committed(self, sink_id: str, batch_id: int) -> bool:
        if self._committed is None:
            self._committed = {(r.sink_id, r.batch_id) for r in
                               self.read().select("sink_id", "batch_id").collect()}
        return (sink_id, int(batch_id)) in self._committed

    def schema(self) -> StructType | None:
        """The table's schema as the last commit that changed it has it."""
        last = self.read().select("version", F.col("operationMetrics")["schema"].alias("s")) \
            .filter("s IS NOT NULL").agg(F.max_by("s", "version")).first()[0]
        return StructType.fromJson(json.loads(last)) if last else None

    def next_version(self) -> int:
        if self._version is None:
            v = self.read().agg(F.max("version")).first()[0]
            self._version = -1 if v is None else int(v)
        return self._version + 1

    def append(self, sink_id: str, batch_id: int, operation: str, metrics: dict) -> int:
        version = self.next_version()
        row = (sink_id, int(batch_id), version, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
               operation, {k: str(v) for k, v in metrics.items()})
        self.spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        self._version = version
        if self._committed is not None:
            self._committed.add((sink_id, int(batch_id)))
        return version


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a folder, from the file system's content summary (no data is read)."""
    if not path_exists(spark, path):
        return 0
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def append_batch(df: DataFrame, path: str, log: CommitLog, sink_id: str, batch_id: int,
                 partition_by: Sequence[str] | None = None) -> dict | None:
    """Append one batch to a table and record rows / bytes written in its commit log.

    At-least-once: a failure between the write and the commit row re-appends on replay. Streams
    that need exactly-once appends use the file sink (``append_stream``).
    """
    if log.committed(sink_id, batch_id):
        return None
    spark = df.sparkSession
    before = folder_bytes(spark, path)
    obs = Observation(f"append_{sink_id}_{int(batch_id)}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    metrics = {"numOutputRows": obs.get["rows"], "numOutputBytes": folder_bytes(spark, path) - before}
    log.append(sink_id, batch_id, "WRITE", metrics)
    return metrics


class UpsertTable:
    """Keyed table updated per micro-batch. ``on_multiple="latest"`` with ``sequence_by`` gives
    apply-changes semantics (C1 on a stream): per key the greatest sequence wins, also against the
    stored row, so late, older changes never overwrite newer ones."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: StructType,
                 partition_by: Sequence[str] | None = None, sink_id: str = "upsert",
                 dedupe_cols: Sequence[str] | None = None, on_multiple: str = "all",
                 sequence_by: Sequence[str] | None = None, partition_from_keys: bool = False):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.schema, self.partition_by = schema, list(partition_by or [])
        self.sink_id, self.dedupe_cols = sink_id, dedupe_cols
        self.on_multiple, self.sequence_by = on_multiple, sequence_by
        self.partition_from_keys = partition_from_keys or set(self.partition_by) <= set(self.keys)
        self.log = CommitLog(spark, f"{path}_commits")
        if path_exists(spark, path) and (stored := self.log.schema()):
            self.schema = evolved(stored, schema)
        self.staging = f"{path}_staging"

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def ensure(self) -> None:
        # a dynamic partition overwrite leaves no _SUCCESS at the root: the folder is the marker
        if not path_exists(self.spark, self.path):
            overwrite_table(self.spark.createDataFrame([], self.schema), self.path, self.partition_by)
            self.log.append(self.sink_id, -1, "CREATE TABLE", {"numOutputRows": 0})

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _touched(self, target: DataFrame, source: DataFrame) -> DataFrame:
        """Target rows in the partitions the batch writes to; rows of a NULL partition always.

        A semi join on the partition columns, whatever the number of partitions of a batch.
        """
        if not self.partition_by:
            return target
        no_value = F.lit(False)
        for c in self.partition_by:
            no_value = no_value | F.col(c).isNull()
        parts = source.select(*self.partition_by)
        if not self.partition_from_keys:
            had = target.join(source.select(*self.keys).dropna().distinct(), self.keys, "left_semi")
            parts = parts.unionByName(had.select(*self.partition_by))
        parts = parts.filter(~no_value).distinct()
        return target.filter(~no_value).join(parts, self.partition_by, "left_semi").select(*target.columns) \
            .unionByName(target.filter(no_value))

    def _source(self, batch: DataFrame) -> DataFrame:
        missing = [f for f in self.schema.fields if f.name not in batch.columns]
        src = batch.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f in missing
                             else F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        if self.dedupe_cols:
            src = dedupe(src, self.dedupe_cols)
        if self.on_multiple == "latest":
            nn = F.lit(True)
            for k in self.keys:
                nn = nn & F.col(k).isNotNull()
            src = latest_per_key(src.filter(nn), self.keys, self.sequence_by or []).unionByName(src.filter(~nn))
        return src

    def merge_batch(self, batch: DataFrame, batch_id: int) -> dict | None:
        """foreachBatch function: upsert one micro-batch (idempotent per streaming query and batch id)."""
        t0 = time.time()
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        sink = f"{self.sink_id}@{query}" if query else self.sink_id
        if self.log.committed(sink, batch_id):
            return None
        grown = evolved(self.schema, batch.schema)
        new_schema, self.schema = (grown, grown) if grown != self.schema else (None, self.schema)
        staged_path = f"{self.staging}/{sink}-{int(batch_id)}"
        metrics: dict = {}
        published = path_exists(self.spark, f"{staged_path}_published")
        if not published and not table_exists(self.spark, staged_path):
            self.ensure()
            # the batch is evaluated once: written to staging, then read for partitions and merge
            src_path = f"{staged_path}_source"
            src = self._source(batch)
            overwrite_table(src, src_path)
            source = self.spark.read.schema(self.schema).parquet(src_path)
            target = self._touched(self.read(), source)
            merged = merge_upsert_tagged(target, source, self.keys,
                                         sequence_by=self.sequence_by if self.on_multiple == "latest" else None)
            obs = Observation(f"merge_{self.sink_id}_{int(batch_id)}")
            a = F.col("_merge_action")
            tracked = merged.observe(obs, F.count_if(a == "update").alias("upd"),
                                     F.count_if(a == "insert").alias("ins"),
                                     F.count(F.lit(1)).alias("out"))
            overwrite_table(tracked.drop("_merge_action"), staged_path, self.partition_by)
            m = obs.get
            metrics.update(numSourceRows=m["upd"] + m["ins"], numTargetRowsUpdated=m["upd"],
                           numTargetRowsInserted=m["ins"], numTargetRowsDeleted=0,
                           numOutputRows=m["out"], scanTimeMs=int((time.time() - t0) * 1000))
        else:
            metrics["republished"] = 1
        if new_schema:
            metrics["schema"] = new_schema.json()
        t2 = time.time()
        if self.partition_by and not self.partition_from_keys:
            staged = self.spark.read.schema(self.schema).parquet(staged_path)
            overwrite_table(staged, self.path, self.partition_by, dynamic=True)
            self._drop_emptied(staged, self.spark.read.schema(self.schema).parquet(f"{staged_path}_source"))
        elif not published:
            self._move(staged_path)
        metrics.update(rewriteTimeMs=int((time.time() - t2) * 1000),
                       executionTimeMs=int((time.time() - t0) * 1000))
        self.log.append(sink, batch_id, "MERGE", metrics)
        return metrics

    def _move(self, staged_path: str) -> None:
        """Put the staged folders in the table's place, without copying their rows. A folder is moved whole: after
        a failure those that are still staged are moved, and the mark at the end tells that none is left."""
        fs, staged = _fs(self.spark, staged_path)
        made = lambda p: _fs(self.spark, p)[1]
        if self.partition_by:
            found = fs.globStatus(staged.suffix("/" + "/".join(f"{c}=*" for c in self.partition_by)))
            ends = ["/".join(st.getPath().toString().split("/")[-len(self.partition_by):]) for st in found]
            moves = [(st.getPath(), made(f"{self.path}/").suffix(f"/{end}")) for st, end in zip(found, ends)]
        else:
            moves = [(staged, made(self.path))]
        for src, dst in moves:
            fs.delete(dst, True)
            fs.mkdirs(dst.getParent())
            if not fs.rename(src, dst):
                raise OSError(f"{src} could not be moved to {dst}")
        fs.create(made(f"{staged_path}_published"), True).close()

    def _drop_emptied(self, staged: DataFrame, source: DataFrame) -> None:
        """Delete the folders that all keys have moved out of: of the partitions that hold keys of the batch,
        those without a row in the new copy. A dynamic overwrite leaves such folders as they were."""
        had = self.read().join(source.select(*self.keys).dropna().distinct(), self.keys, "left_semi") \
            .select(*self.partition_by).distinct()
        now = staged.select(*self.partition_by).distinct()
        same = [had[c].eqNullSafe(now[c]) for c in self.partition_by]
        path_of = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        for r in had.join(now, same, "left_anti").collect():   # folders, at most as many as the batch's keys lay in
            folder = "/".join(path_of(c, None if r[c] is None else str(r[c])) for c in self.partition_by)
            fs, p = _fs(self.spark, f"{self.path}/{folder}")
            fs.delete(p, True)
