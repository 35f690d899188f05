"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import stratum
from stratum.session import scratch_dir

#: Prefix of working columns, so that they can't clash with a caller's extra columns.
TMP = "__llm_"


#: Bytes of an Arrow batch that a Python worker is handed, so that long texts don't add up.
BATCH_BYTES = 8 << 20


def ready(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per context (as spark-submit --py-files would), and
    batches of bounded size."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if getattr(sc, "_llm_shipped", False):
        return
    package = Path(stratum.__file__).parent
    archive = f"{tempfile.mkdtemp(prefix='llm-package-')}/{package.name}_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(archive)  # the driver serves it; executors needn't see this folder
    sc._llm_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch area and read it back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, name)}/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table made by ``stored`` that no later step reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for f in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def released(spark: SparkSession) -> None:
    """Let Spark's context cleaner drop the shuffle files of finished steps of an iteration."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the value as text, modulo n; null stays null."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(n)


def complete_groups(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Re-cut a partition's batches, sorted by ``key``, so that no group spans two of them.

    A group must fit in memory; callers split groups that can grow with the data beforehand.
    """
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        last = (batch[key] == batch[key].iloc[-1]).all(axis=1).to_numpy()
        cut = len(batch) - int(last[::-1].argmin()) if not last.all() else 0
        if cut == 0:
            if rest and (rest[0][key].iloc[-1] != batch[key].iloc[0]).any():
                yield pd.concat(rest, ignore_index=True)
                rest = []
            rest.append(batch)
            continue
        yield pd.concat([*rest, batch.iloc[:cut]], ignore_index=True)
        rest = [batch.iloc[cut:]]
    if rest:
        yield pd.concat(rest, ignore_index=True)


def map_groups(df: DataFrame, key: list[str], partitions: int,
               fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
               order: list[str] | None = None) -> DataFrame:
    """``fn`` over frames of whole groups: many small groups share one call, unlike applyInPandas."""
    def run(batches):
        for frame in complete_groups(batches, key):
            yield fn(frame)

    dealt = df.repartition(partitions, *key).sortWithinPartitions(*key, *(order or []))
    return dealt.mapInPandas(run, schema)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
