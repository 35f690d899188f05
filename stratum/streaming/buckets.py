"""Keyed tables kept in bucket folders: changes are appended, the newest row of a key is found on read,
compaction rewrites the touched buckets only, and sums follow by signed differences (C1, K4, K9, A3-A6).

Folders of a table::

    changes/_generation=<g>/_bucket=<b>/    rows as a stream brought them, one generation per run (append-only)
    appended/generation=<g>/_bucket=<b>/    the same for rows appended by a batch
    base/version=<g>/_bucket=<b>/           newest row per key, for the buckets that generation g touched

A bucket's rows are those of its newest finished version, so a reader sees whole buckets while a new
version is written, and a version that didn't finish is written anew. Applying a generation again changes
nothing, as a row competes with its own copy. Old versions and applied generations go by age (``vacuum``).

All work is plain Spark jobs: one shuffle on the key per compaction, over the touched buckets. The driver
lists folders (buckets x kept versions) and never holds rows.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from stratum.operators.changes import latest_per_key
from stratum.sources.catalog import _fs, table_exists

BUCKET, GENERATION = "_bucket", "_generation"
#: Stored bytes that are merged at a time: the shuffles of a merge, several times as large, are limited by it.
TURN_BYTES = 1 << 28


def folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the folders ``<name>=<number>`` under a path."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    found = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    return sorted(int(f.partition("=")[2]) for f in found if f.startswith(f"{name}=") and f.partition("=")[2].isdigit())


def stored_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


class BucketFolders:
    """Rows of a table by version and bucket; a bucket's rows are those of its newest finished version."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int,
                 compression: str | None = None):
        self.spark, self.path, self.schema, self.compression = spark, path, schema, compression
        self.keys, self.buckets = list(keys), buckets
        self._finished: dict[int, list[int]] = {}   # a finished version never changes

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        return [v for v in folders(self.spark, self.path, "version") if self.finished(v)]

    def finished(self, version: int) -> bool:
        return version in self._finished or table_exists(self.spark, self.folder(version))

    def folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def layout(self) -> dict[int, int]:
        """bucket -> its newest finished version."""
        out = {}
        for v in self.versions():
            if v not in self._finished:
                self._finished[v] = folders(self.spark, self.folder(v), BUCKET)
            out.update(dict.fromkeys(self._finished[v], v))
        return out

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        layout = self.layout()
        wanted = layout if buckets is None else [b for b in buckets if b in layout]
        paths = [f"{self.folder(layout[b])}/{BUCKET}={b}" for b in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, df: DataFrame, version: int, first: bool = True, last: bool = True) -> None:
        """A version: all rows of each bucket that ``df`` has rows of. It may be written in turns, each with
        buckets of its own; the last one finishes it, and a first one begins it anew."""
        w = df.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET) \
            .write.mode("overwrite" if first else "append").option("partitionOverwriteMode", "static") \
            .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(last).lower())
        w = w.option("compression", self.compression) if self.compression else w
        w.partitionBy(BUCKET).parquet(self.folder(version))

    def vacuum(self, older_than_hours: float = 168) -> list[int]:
        """Delete versions of which no bucket is current and that are older than this (a reader's grace)."""
        current, gone = set(self.layout().values()), []
        fs, _ = _fs(self.spark, self.path)
        for v in self.versions():
            _, p = _fs(self.spark, self.folder(v))
            if v not in current and v != max(self.versions()) \
                    and time.time() - fs.getFileStatus(p).getModificationTime() / 1000 >= older_than_hours * 3600:
                fs.delete(p, True)
                self._finished.pop(v, None)
                gone.append(v)
        return gone


class ChangeTable:
    """Type-1 change target: per key the row with the greatest ``sequence_by`` (ties as in
    ``latest_per_key``) over all changes that ever came, in any order and any number of copies. NULL keys
    are a key like any other."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str],
                 sequence_by: str | Sequence[str], buckets: int = 16, compression: str | None = None):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, list(keys)
        self.compression = compression
        seq = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
        names = schema.fieldNames()
        self.sequence_by = seq
        self.order = seq + [c for c in names if c not in self.keys and c not in seq]
        was = StructType([StructField(c, schema[c].dataType) for c in self.order])
        stored = StructType([*[StructField(c, schema[c].dataType) for c in names],
                             StructField("_was", was), StructField("_changed", BooleanType())])
        self.base = BucketFolders(spark, f"{path}/base", stored, self.keys, buckets, compression)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def generations(self) -> list[int]:
        return sorted({*folders(self.spark, f"{self.path}/changes", GENERATION),
                       *folders(self.spark, f"{self.path}/appended", "generation")})

    def pending(self) -> list[int]:
        """Generations that no finished version holds."""
        done = max(self.base.versions(), default=-1)
        return [g for g in self.generations() if g > done]

    def append(self, changes: DataFrame, checkpoint: str | None = None, trigger: dict | None = None):
        """Append changes as a new generation. A stream takes what its checkpoint hasn't seen; should a
        run be cut off, its rows come again with the next one, which changes nothing. Returns the streaming
        query, None for a batch."""
        from stratum.streaming.sinks import append_stream
        number = max([*self.generations(), *self.base.versions(), -1]) + 1
        rows = changes.select(*self.columns).withColumn(BUCKET, self.base.bucket())
        if changes.isStreaming:
            q = append_stream(rows.withColumn(GENERATION, F.lit(number)), f"{self.path}/changes", checkpoint,
                              [GENERATION, BUCKET], trigger, compression=self.compression)
            q.awaitTermination()
            return q
        w = rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET)
        w = w.option("compression", self.compression) if self.compression else w
        w.parquet(f"{self.path}/appended/generation={number}")
        return None

    def _changes(self, generations: Iterable[int]) -> DataFrame | None:
        """The committed rows of some generations with their bucket; only their folders are read."""
        numbers, whole = list(generations), [*self.schema.fields, StructField(BUCKET, IntegerType())]
        parts = [self.spark.read.schema(StructType(whole)).parquet(f"{self.path}/appended/generation={g}")
                 for g in numbers if table_exists(self.spark, f"{self.path}/appended/generation={g}")]
        if numbers and table_exists(self.spark, f"{self.path}/changes"):
            stream = self.spark.read.schema(StructType([*whole, StructField(GENERATION, IntegerType())])) \
                .parquet(f"{self.path}/changes")
            parts.append(stream.filter(F.col(GENERATION).isin(numbers)).drop(GENERATION))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def read(self) -> DataFrame:
        """Merge on read: the newest row of each key over the base and the pending generations."""
        base, changes = self.base.read().select(*self.columns), self._changes(self.pending())
        if changes is None:
            return base
        return latest_per_key(base.unionByName(changes.select(*self.columns)), self.keys, self.sequence_by)

    def _turns(self, touched: Iterable[int], generations: Iterable[int]) -> list[list[int]]:
        """The touched buckets in turns of about ``TURN_BYTES`` of stored rows, old and new, at least one bucket each."""
        layout, turns, held = self.base.layout(), [], 0
        came = [f"{self.path}/{f}={g}" for g in generations for f in (f"changes/{GENERATION}", "appended/generation")]
        for b in touched:
            old = [self.base.folder(layout[b])] if b in layout else []
            size = sum(stored_bytes(self.spark, f"{p}/{BUCKET}={b}") for p in [*came, *old])
            if not turns or held + size > TURN_BYTES:
                turns.append([])
                held = 0
            turns[-1].append(b)
            held += size
        return turns

    def compact(self) -> int | None:
        """Merge the pending generations into the buckets that they touch, a turn of buckets after the other.
        Returns the new version."""
        pending = self.pending()
        changes = self._changes(pending)
        if changes is None:
            return None
        touched = sorted(r[0] for r in changes.select(BUCKET).distinct().collect())  # at most the number of buckets
        if not touched:
            return None   # nothing was committed
        turns = self._turns(touched, pending)
        for i, some in enumerate(turns):
            new = changes if len(turns) == 1 else changes.filter(F.col(BUCKET).isin(some))
            self.base.write(self._merged(some, new), pending[-1], first=i == 0, last=i == len(turns) - 1)
        return pending[-1]

    def _merged(self, buckets: Iterable[int], changes: DataFrame) -> DataFrame:
        """The newest row of each key of some buckets, with the one before if it changed."""
        old = self.base.read(buckets).select(*self.columns)
        row = F.struct(*self.order)
        merged = old.withColumn("_had", F.lit(True)).unionByName(changes.select(*self.columns).withColumn("_had", F.lit(False))) \
            .groupBy(*self.keys).agg(F.max(row).alias("_now"), F.max(F.when(F.col("_had"), row)).alias("_was"))
        changed = F.col("_was").isNull() | (F.col("_now") > F.col("_was"))
        return merged.select(*[F.col(c) if c in self.keys else F.col(f"_now.{c}").alias(c) for c in self.columns],
                             F.when(changed, F.col("_was")).alias("_was"), changed.alias("_changed"))

    def deltas(self, version: int) -> DataFrame:
        """What a version changed, as signed rows: the old row of a key with ``_sign`` -1, the new one with 1."""
        if not self.base.finished(version):
            raise ValueError(f"version {version} isn't finished")
        rows = self.spark.read.schema(self.base.schema).parquet(self.base.folder(version)).filter("_changed")
        now = F.struct(F.lit(1).alias("_sign"), *self.columns)
        was = F.struct(F.lit(-1).alias("_sign"), *[F.col(c) if c in self.keys else F.col(f"_was.{c}").alias(c)
                                                   for c in self.columns])
        return rows.select(F.explode(F.when(F.col("_was").isNull(), F.array(now)).otherwise(F.array(now, was))).alias("_r")) \
            .select("_r.*")

    def changes(self, version: int) -> DataFrame:
        """The rows, as they came, of the generations that a version merged."""
        before = max((v for v in self.base.versions() if v < version), default=-1)
        rows = self._changes([g for g in self.generations() if before < g <= version])
        if rows is None:
            raise ValueError(f"the changes of version {version} are gone")
        return rows.select(*self.columns)

    def vacuum(self, older_than_hours: float = 168) -> list[int]:
        """Delete applied generations and superseded versions that are older than this."""
        done = max(self.base.versions(), default=-1)
        fs, _ = _fs(self.spark, self.path)
        for g in self.generations():
            # files that a stream's log still names are not opened: generations up to ``done`` are never asked for
            for _, p in (_fs(self.spark, f"{self.path}/{f}={g}") for f in (f"changes/{GENERATION}", "appended/generation")):
                if g <= done and fs.exists(p) and time.time() - fs.getFileStatus(p).getModificationTime() / 1000 >= older_than_hours * 3600:
                    fs.delete(p, True)
        return self.base.vacuum(older_than_hours)


class KeptSums:
    """SUM(value) per group, kept up by signed rows: only the buckets of touched groups are rewritten.

    Sums are decimals, so adding and taking away again leaves nothing behind; they are shown as doubles.
    A group is shown while it has rows, and its sum is NULL while all its values are, as SUM has it.
    """

    DECIMAL = "decimal(38,6)"

    def __init__(self, spark: SparkSession, path: str, groups: dict[str, Column], value: Column | None,
                 types: dict[str, str], buckets: int = 16, total_name: str = "TotalSales"):
        self.spark, self.groups, self.value, self.total_name = spark, groups, value, total_name
        schema = ", ".join(f"`{c}` {types[c]}" for c in groups) + f", _sum {self.DECIMAL}, _values long, _rows long"
        self.stored = BucketFolders(spark, path, StructType.fromDDL(schema), list(groups), buckets)

    def applied(self, version: int) -> bool:
        """Versions are added in order, so one below the newest was, even if its folder is gone."""
        return version <= max(self.stored.versions(), default=-1)

    def apply(self, deltas: DataFrame, version: int) -> bool:
        """Add the signed rows of a version; one that was added before is left out."""
        if self.applied(version):
            return False
        sign, names = F.col("_sign"), list(self.groups)
        value = F.lit(None).cast(self.DECIMAL) if self.value is None else self.value.cast(self.DECIMAL)
        new = deltas.select(*[c.alias(n) for n, c in self.groups.items()], value.alias("_v"), "_sign") \
            .groupBy(*names).agg(F.sum(F.when(sign < 0, -F.col("_v")).otherwise(F.col("_v"))).cast(self.DECIMAL).alias("_sum"),
                                 F.sum(F.when(F.col("_v").isNotNull(), sign).otherwise(0)).alias("_values"),
                                 F.sum(sign).alias("_rows"))
        # the groups that a version touches are written first: they tell the buckets, and are summed once
        parts = f"{self.stored.path}_parts/version={version}"
        new.write.mode("overwrite").parquet(parts)
        new = self.spark.read.schema(self.stored.schema).parquet(parts)
        touched = [r[0] for r in new.select(self.stored.bucket().alias("b")).distinct().collect()]
        old = self.stored.read(touched)
        add = lambda c, t: F.sum(F.coalesce(F.col(c), F.lit(0).cast(t))).cast(t).alias(c)
        both = old.unionByName(new).groupBy(*names).agg(add("_sum", self.DECIMAL), add("_values", "long"), add("_rows", "long"))
        self.stored.write(both, version)   # empty groups stay, so that a bucket is never left to an older version
        fs, p = _fs(self.spark, parts)
        fs.delete(p, True)
        return True

    def read(self) -> DataFrame:
        out = self.stored.read().filter("_rows > 0")
        total = [] if self.value is None else [F.when(F.col("_values") > 0, F.col("_sum").cast("double")).alias(self.total_name)]
        return out.select(*self.groups, *total)

    def vacuum(self, older_than_hours: float = 168) -> list[int]:
        return self.stored.vacuum(older_than_hours)
