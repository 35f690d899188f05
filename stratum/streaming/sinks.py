"""Streaming sinks.

* ``append_stream``  - append to a parquet table through the file sink: exactly-once via the sink's
  own commit log and the query checkpoint; optionally partitioned.
* ``complete_stream`` - complete-mode aggregates replace the table each trigger (foreachBatch): a new
  snapshot folder becomes the table when it is finished, so readers always see a whole one.
* ``upsert_stream``   - keyed upsert per micro-batch (foreachBatch + ``UpsertTable.merge_batch``).

``foreachBatch`` makes PySpark start its Py4J callback server on the driver; the per-batch
functions are ordinary functions of (DataFrame, batch_id), so they are also driven directly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def _trigger(writer, trigger: dict | None):
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(**trigger)


def append_stream(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] | None = None,
                  trigger: dict | None = None, fmt: str = "parquet", query_name: str | None = None,
                  max_records_per_file: int | None = None, compression: str | None = None) -> StreamingQuery:
    """Append a stream to a table at ``path`` (K1, K3). Default trigger: availableNow; default codec: the session's."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if compression:
        w = w.option("compression", compression)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start(path)


def overwrite_batch(path: str, partition_by: Sequence[str] | None = None) -> Callable[[DataFrame, int], None]:
    """Per-batch function replacing the table with the batch's (complete) result."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return fn


def publish_batch(table) -> Callable[[DataFrame, int], None]:
    """Per-batch function that makes the batch's (complete) result the next snapshot of ``table``."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        table.publish(batch)
    return fn


def complete_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                    name: str | None = None) -> StreamingQuery:
    """Complete-mode aggregate stream whose table (``Snapshots(path)``) is replaced every trigger (K2)."""
    from stratum.streaming.snapshots import Snapshots
    w = (df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
           .foreachBatch(publish_batch(Snapshots(df.sparkSession, path, name))))
    return _trigger(w, trigger).start()


def upsert_stream(df: DataFrame, table, checkpoint: str, trigger: dict | None = None,
                  output_mode: str = "update") -> StreamingQuery:
    """Keyed upsert of every micro-batch into an ``UpsertTable``."""
    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
           .foreachBatch(table.merge_batch))
    return _trigger(w, trigger).start()


def memory_stream(df: DataFrame, name: str, output_mode: str = "append",
                  checkpoint: str | None = None) -> StreamingQuery:
    """Run a stream to completion into the in-memory table ``name`` (tests, small results)."""
    w = df.writeStream.format("memory").queryName(name).outputMode(output_mode).trigger(availableNow=True)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


def observed(query: StreamingQuery, name: str) -> list[dict]:
    """The metrics observed under ``name`` in each micro-batch of a run, with its batch id, in order.

    Spark keeps ``spark.sql.streaming.numRecentProgressUpdates`` of them; a run of more batches is told
    by its missing ids rather than by silently smaller sums.
    """
    rows = {}
    for p in query.recentProgress:
        if p["numInputRows"] and (m := (p.get("observedMetrics") or {}).get(name)) is not None:
            rows[p["batchId"]] = {"batch_id": p["batchId"], **(m.asDict() if hasattr(m, "asDict") else dict(m))}
    ids = [p["batchId"] for p in query.recentProgress]
    kept = int(query._jsq.sparkSession().conf().get("spark.sql.streaming.numRecentProgressUpdates", "100")) \
        if hasattr(query, "_jsq") else 100
    if ids and len(ids) >= kept:
        raise RuntimeError(f"the run has {kept} or more progress updates: raise "
                           "spark.sql.streaming.numRecentProgressUpdates to keep all its metrics")
    return [rows[b] for b in sorted(rows)]


def progress(query: StreamingQuery) -> list[dict]:
    """Rows read per trigger and observed metrics, from the query's recent progress."""
    return [{"batchId": p.get("batchId"), "numInputRows": p.get("numInputRows"),
             "observedMetrics": p.get("observedMetrics")} for p in query.recentProgress]


def stop_all(spark: SparkSession) -> int:
    """Stop every active streaming query of the session."""
    n = 0
    for q in spark.streams.active:
        q.stop()
        n += 1
    return n
