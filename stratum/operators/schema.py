"""Schema evolution on write and read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType, StructField, StructType, TimestampNTZType)

_WHOLE = [ByteType(), ShortType(), IntegerType(), LongType()]


def merge_schemas(*frames: DataFrame) -> DataFrame:
    """By-name union; a column missing from a frame is NULL there, new columns are appended."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Read parquet files written with different (compatible) schemas as one super-schema."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def wider(a: DataType, b: DataType) -> DataType:
    """The type that holds the values of both without loss; files of the narrower one read as it."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if {a, b} == {FloatType(), DoubleType()} or (DoubleType() in (a, b) and (a in _WHOLE[:3] or b in _WHOLE[:3])):
        return DoubleType()
    if {a, b} == {DateType(), TimestampNTZType()}:
        return TimestampNTZType()
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale, whole = max(a.scale, b.scale), max(a.precision - a.scale, b.precision - b.scale)
        if scale + whole <= 38:
            return DecimalType(scale + whole, scale)
    raise TypeError(f"no type holds both {a.simpleString()} and {b.simpleString()} without loss")


def evolved(stored: StructType, arriving: StructType) -> StructType:
    """The stored schema grown by name: its columns in place, each as wide as either side needs, then the new
    columns. A column that doesn't arrive stays (its new rows have NULL there)."""
    own = {f.name: f for f in stored.fields}
    out = [StructField(f.name, wider(f.dataType, arriving[f.name].dataType) if f.name in arriving.fieldNames() else f.dataType)
           for f in stored.fields]
    return StructType(out + [StructField(f.name, f.dataType) for f in arriving.fields if f.name not in own])
