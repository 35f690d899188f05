"""Complete tables as snapshot folders.

A new result is written aside, ``<path>/snapshot=<n>``, and becomes the table when it is finished: by
path the newest finished snapshot counts, and a catalog table's location is pointed at it. Readers of the
one before keep their whole files until ``vacuum`` takes snapshots away by age; a write that breaks off
leaves the table as it was.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stratum.sources.catalog import _fs, table_exists
from stratum.streaming.buckets import folders


class Snapshots:
    def __init__(self, spark: SparkSession, path: str, name: str | None = None, comment: str = "",
                 properties: dict[str, str] | None = None, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.name = spark, path, name
        self.comment, self.properties, self.partition_by = comment, dict(properties or {}), list(partition_by)

    def finished(self) -> list[int]:
        return [n for n in folders(self.spark, self.path, "snapshot") if table_exists(self.spark, self.folder(n))]

    def folder(self, n: int) -> str:
        return f"{self.path}/snapshot={n}"

    def current(self) -> str | None:
        """The folder of the newest finished snapshot."""
        done = self.finished()
        return self.folder(done[-1]) if done else None

    def publish(self, df: DataFrame) -> str:
        """Write a snapshot aside, then make it the table."""
        n = max(folders(self.spark, self.path, "snapshot"), default=-1) + 1
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (w.partitionBy(*self.partition_by) if self.partition_by else w).parquet(self.folder(n))
        if self.name:
            self._point()
        return self.folder(n)

    def _point(self) -> None:
        props = ", ".join(f"'{k}' = '{v}'" for k, v in self.properties.items())
        comment = self.comment.replace("'", "\\'")
        if not self.spark.catalog.tableExists(self.name):
            self.spark.sql(f"CREATE TABLE {self.name} USING parquet LOCATION '{self.current()}' COMMENT '{comment}'"
                           + (f" TBLPROPERTIES ({props})" if props else ""))
        else:
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{self.current()}'")
        if self.partition_by:
            self.spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")
        self.spark.sql(f"REFRESH TABLE {self.name}")

    def read(self) -> DataFrame:
        if self.current() is None:
            raise FileNotFoundError(f"{self.path} has no finished snapshot")
        return self.spark.read.parquet(self.current())

    def vacuum(self, older_than_hours: float = 168) -> list[str]:
        """Delete all but the current snapshot that were last changed longer ago than this."""
        gone, fs = [], _fs(self.spark, self.path)[0]
        for n in folders(self.spark, self.path, "snapshot"):
            folder = self.folder(n)
            _, p = _fs(self.spark, folder)
            if folder != self.current() and time.time() - fs.getFileStatus(p).getModificationTime() / 1000 >= older_than_hours * 3600:
                fs.delete(p, True)
                gone.append(folder)
        return gone
