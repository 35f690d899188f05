"""Column-level helpers: renames, constant metadata, ingest stamps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lowercase_all_column_names(df: DataFrame) -> DataFrame:
    """Rename every column to lower case; values, order and types are kept."""
    return df.toDF(*[c.lower() for c in df.columns])


def uppercase_all_column_names(df: DataFrame) -> DataFrame:
    """Rename every column to upper case; values, order and types are kept."""
    return df.toDF(*[c.upper() for c in df.columns])


def add_metadata(df: DataFrame, field_dict: Mapping[str, object]) -> DataFrame:
    """Append one constant column per dict entry, in dict order."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in field_dict.items()})


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns by a {old: new} map; unknown names are ignored (as withColumnRenamed does)."""
    return df.withColumnsRenamed(dict(mapping))


def uuid_hex() -> Column:
    """A random 32-hex-character id per row, computed JVM-side."""
    return F.regexp_replace(F.expr("uuid()"), "-", "")


def stamp_ingest(df: DataFrame, id_col: str = "id", ts_col: str = "timestamp") -> DataFrame:
    """Add a random row id and the ingest time (one value per query / micro-batch)."""
    return df.withColumns({id_col: uuid_hex(), ts_col: F.current_timestamp()})
