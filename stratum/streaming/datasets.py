"""Declared datasets: a name, a comment, quality-tier properties and a partitioning attached to a
streaming or complete table (K6-K9).

A declaration is metadata on top of the sinks: the table is written by ``append_stream`` (streaming),
as the next snapshot folder (complete) or not at all (temporary: the DataFrame is handed to the next node).
What the rules of a streaming dataset counted in each micro-batch is kept as rows (``rule_metrics``);
once the location holds committed data it is registered in the session catalog with its comment and
properties (``CREATE TABLE ... COMMENT ... TBLPROPERTIES``). Execution order is the caller's code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from stratum.operators.quality import expect, expect_or_drop

METRICS_SCHEMA = "dataset string, rule string, batch_id long, rows long, violations long"


@dataclass
class Dataset:
    name: str
    path: str | None = None
    comment: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)
    partition_by: Sequence[str] = ()
    drop_rules: Mapping[str, str] = field(default_factory=dict)
    warn_rules: Mapping[str, str] = field(default_factory=dict)
    temporary: bool = False
    cluster_by: Sequence[str] = ()     # new files are laid out by these columns
    cluster_files: int | None = None   # files of a run; by default as many as its size asks for
    compression: str | None = None     # codec of a streaming dataset's files; by default the session's

    def apply_rules(self, df: DataFrame):
        """Warn rules are counted (observation), drop rules filter. Returns (df, observation|None)."""
        obs = None
        rules = {**self.drop_rules, **self.warn_rules}
        if rules:
            df, obs = expect(df, rules, name=f"{self.name}_expectations")
        if self.drop_rules:
            df = expect_or_drop(df, self.drop_rules)
        return df, obs


def _register(spark: SparkSession, ds: Dataset) -> bool:
    from stratum.sources.catalog import table_exists
    if ds.temporary or not ds.path or not table_exists(spark, ds.path):
        return False
    props = ", ".join(f"'{k}' = '{v}'" for k, v in ds.properties.items())
    comment = ds.comment.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ds.name} USING parquet LOCATION '{ds.path}' "
              f"COMMENT '{comment}'" + (f" TBLPROPERTIES ({props})" if props else ""))
    if ds.partition_by or ds.cluster_by:
        spark.sql(f"MSCK REPAIR TABLE {ds.name}")
    return True


def streaming_table(spark: SparkSession, ds: Dataset, df: DataFrame, checkpoint: str | None = None,
                    trigger: dict | None = None):
    """Run a declared streaming dataset; a temporary one is returned unmaterialised (K6, K8)."""
    from stratum.streaming.sinks import append_stream
    out, observation = ds.apply_rules(df)
    if ds.temporary:
        return out
    if ds.cluster_by:
        return _clustered_table(spark, ds, out, checkpoint or f"{ds.path}_checkpoint", trigger, observation)
    q = append_stream(out, ds.path, checkpoint or f"{ds.path}_checkpoint", ds.partition_by, trigger,
                      query_name=ds.name, compression=ds.compression)
    q.awaitTermination()
    if observation:
        _keep_metrics(spark, ds, q, observation)
    _register(spark, ds)
    return q


RUN = "_run"


def _clustered_table(spark: SparkSession, ds: Dataset, out: DataFrame, checkpoint: str, trigger, observation):
    """A streaming dataset with clustering columns: arrivals are appended as they come, then a job lays
    out the runs that aren't laid out yet, ``<path>/_run=<n>``, and only those. A job that broke off is done
    anew by the next run."""
    from stratum.operators.layout import cluster_by_zorder
    from stratum.sources.catalog import _fs, table_exists
    from stratum.streaming.buckets import folders
    from stratum.streaming.sinks import append_stream
    arrivals, schema = f"{ds.path}_arrivals", out.schema
    q = append_stream(out.withColumn(RUN, F.lit(max(folders(spark, arrivals, RUN), default=-1) + 1)), arrivals, checkpoint,
                      [RUN], trigger, query_name=ds.name, compression=ds.compression)
    q.awaitTermination()
    if observation:
        _keep_metrics(spark, ds, q, observation)
    if not table_exists(spark, arrivals):
        return q
    came = spark.read.schema(StructType([*schema.fields, StructField(RUN, IntegerType())])).parquet(arrivals)
    for n in folders(spark, arrivals, RUN):
        done = f"{ds.path}/{RUN}={n}"
        if table_exists(spark, done):
            continue
        new = came.filter(F.col(RUN) == n).drop(RUN)
        w = cluster_by_zorder(new, ds.cluster_by, ds.cluster_files).write.mode("overwrite") \
            .option("partitionOverwriteMode", "static")
        w = w.option("compression", ds.compression) if ds.compression else w
        (w.partitionBy(*ds.partition_by) if ds.partition_by else w).parquet(done)
        fs, p = _fs(spark, f"{ds.path}/_SUCCESS")
        fs.create(p, True).close()     # the table holds a finished run
    _register(spark, ds)
    return q


def _keep_metrics(spark: SparkSession, ds: Dataset, q, name: str) -> None:
    """Append what each micro-batch of a run counted: one row per rule and batch."""
    from stratum.streaming.sinks import observed
    rows = [(ds.name, rule, m["batch_id"], m["rows"], m[f"violations_{rule}"])
            for m in observed(q, name) for rule in {**ds.drop_rules, **ds.warn_rules}]
    if rows:
        spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{ds.path}_rule_metrics")


def rule_metrics(spark: SparkSession, ds: Dataset) -> DataFrame:
    """(dataset, rule, batch_id, rows, violations): one row per rule and micro-batch (Q1, K6). A batch that
    came again after a failure counts once."""
    from stratum.sources.catalog import table_exists
    path = f"{ds.path}_rule_metrics"
    if not table_exists(spark, path):
        return spark.createDataFrame([], METRICS_SCHEMA)
    return spark.read.schema(METRICS_SCHEMA).parquet(path).dropDuplicates(["dataset", "rule", "batch_id"])


def live_table(spark: SparkSession, ds: Dataset, df: DataFrame) -> DataFrame:
    """Create or refresh a declared complete dataset from a batch query (K7): its next snapshot."""
    out, _ = ds.apply_rules(df)
    table = snapshots(spark, ds)
    table.publish(out)
    return table.read()


def snapshots(spark: SparkSession, ds: Dataset):
    """The snapshot folders of a declared complete dataset."""
    from stratum.streaming.snapshots import Snapshots
    return Snapshots(spark, ds.path, ds.name, ds.comment, dict(ds.properties), ds.partition_by)


def create_target(spark: SparkSession, ds: Dataset, schema) -> None:
    """Declare an empty target for change application (K9)."""
    from stratum.sources.catalog import create_target as _create
    _create(spark, ds.path, schema, ds.partition_by)
    _register(spark, ds)
