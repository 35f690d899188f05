"""Event-time state bounding and late data.

``withWatermark`` on its own drops nothing; rows are dropped as late only by a stateful operator
that uses the watermark. The watermark of micro-batch k is (max event time of batches < k) - delay,
so the first batch never drops anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_time(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ): cast an NTZ event time for streaming."""
    return df.withColumn(name or col, F.col(col).cast("timestamp"))


def drop_late(df: DataFrame, ts: str, delay: str, key: Sequence[str]) -> DataFrame:
    """Drop rows older than the watermark; everything else passes once.

    ``key`` must identify a row (e.g. an event id): the within-watermark dedupe on it keeps state
    only for ``delay`` of event time and drops nothing but late rows.
    """
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def dedupe_stream(df: DataFrame, cols: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Streaming dedupe on columns that include the event time; state is evicted by the watermark.

    Rows without an event time would never be evicted, so they go around the operator; they and the
    rows behind the watermark are found by ``late_rows``.
    """
    cols = list(cols)
    if ts not in cols:
        raise ValueError("the dedupe columns must include the event-time column to bound state")
    return df.filter(F.col(ts).isNotNull()).withWatermark(ts, delay).dropDuplicates(cols)


def late_rows(arrived: DataFrame, kept: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Side table of a streaming dedupe, as a batch: the distinct rows that arrived but are not among those
    kept (behind the watermark, or without an event time). NULLs compare as equal."""
    cols = list(cols)
    a, k = arrived.dropDuplicates(cols), kept.select(*[F.col(c).alias(f"_kept_{c}") for c in cols])
    same = F.lit(True)
    for c in cols:
        same = same & a[c].eqNullSafe(k[f"_kept_{c}"])
    return a.join(k, same, "left_anti")


class LateSplit:
    """Rows split by a carried maximum in the stream's own pass.

    A row is late if its event time lies more than ``delay`` before the largest event time that earlier
    runs have seen, or if it has none. Both sides are written by the one append sink, as folders
    ``_late=false`` and ``_late=true`` of one table, so that together they hold every row exactly once; counts
    and maximum are observed in that pass and kept as one row per micro-batch (``metrics``). Nothing that
    came before is read again. The maximum is that of a run's beginning: micro-batches of one run are
    judged alike.
    """

    METRICS = "batch_id long, rows long, late long, max_ts timestamp"

    def __init__(self, spark, path: str, ts: str, delay: str):
        self.spark, self.path, self.ts, self.delay = spark, path, ts, delay

    @property
    def metrics_path(self) -> str:
        return f"{self.path}_metrics"

    def metrics(self) -> DataFrame:
        """(batch_id, rows, late, max_ts): what each micro-batch brought."""
        from stratum.sources.catalog import table_exists
        if not table_exists(self.spark, self.metrics_path):
            return self.spark.createDataFrame([], self.METRICS)
        return self.spark.read.schema(self.METRICS).parquet(self.metrics_path).dropDuplicates(["batch_id"])

    def carried(self, checkpoint: str):
        """The largest event time of earlier runs, in microseconds. If a run ended before its metrics were kept, the kept
        rows are asked."""
        from stratum.sources.catalog import _fs, table_exists
        micros = F.max(F.unix_micros("max_ts")).alias("m")
        known = self.metrics().agg(F.max("batch_id").alias("b"), micros).first()
        fs, p = _fs(self.spark, f"{checkpoint}/commits")
        done = [int(st.getPath().getName()) for st in fs.listStatus(p)
                if st.getPath().getName().isdigit()] if fs.exists(p) else []
        if done and table_exists(self.spark, self.path) and (known["b"] is None or max(done) > known["b"]):
            return self.spark.read.parquet(self.path).agg(F.max(F.unix_micros(self.ts))).first()[0]
        return known["m"]

    def run(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None):
        """Split what is new in the stream; returns the query."""
        from stratum.streaming.sinks import append_stream, observed
        stream = event_time(stream, self.ts)
        top = self.carried(checkpoint)
        late = F.lit(False) if top is None \
            else F.col(self.ts) < F.timestamp_micros(F.lit(top)) - F.expr(f"INTERVAL {self.delay}")
        tagged = stream.withColumn("_late", F.coalesce(late & F.col(self.ts).isNotNull(), F.lit(True))
                                   | F.col(self.ts).isNull())
        tagged = tagged.observe("late_split", F.count(F.lit(1)).alias("rows"), F.count_if("_late").alias("late"),
                                F.max(F.unix_micros(self.ts)).alias("max_micros"))  # a time would be told by the second
        q = append_stream(tagged, self.path, checkpoint, ["_late"], trigger)
        q.awaitTermination()
        rows = [(m["batch_id"], m["rows"], m["late"], m["max_micros"]) for m in observed(q, "late_split")]
        # micro-batches without rows (they only advance watermarks) are told by their ids alone
        seen = {r[0] for r in rows}
        rows += [(x["batchId"], 0, 0, None) for x in q.recentProgress if x["batchId"] not in seen]
        if rows:
            made = self.spark.createDataFrame(rows, "batch_id long, rows long, late long, max_micros long")
            made.select("batch_id", "rows", "late", F.timestamp_micros("max_micros").alias("max_ts")).coalesce(1) \
                .write.mode("append").parquet(self.metrics_path)
        return q

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).withColumn("_late", F.col("_late").cast("boolean"))

    def kept(self) -> DataFrame:
        return self.read().filter(~F.col("_late")).drop("_late")

    def side(self) -> DataFrame:
        return self.read().filter("_late").drop("_late")


def count_by_window_stream(df: DataFrame, ts: str, size: str = "1 hour", delay: str = "1 hour",
                           slide: str | None = None) -> DataFrame:
    """Windowed counts on a stream: append mode emits each window once the watermark passes it."""
    w = F.window(ts, size, slide or size)
    return (df.withWatermark(ts, delay).groupBy(w.alias("window"))
              .agg(F.count(F.lit(1)).alias("count"))
              .select(F.col("window.start").alias("start_time"), F.col("window.end").alias("end_time"), "count"))
