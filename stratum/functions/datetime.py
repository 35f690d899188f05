"""Date/time clean-up expressions (F1-F16), all JVM-side built-ins.

ANSI mode is on by default in Spark 4, so every step that the declared SQL relied on to yield NULL
on bad input uses the null-safe variant: ``get`` for array indexing, ``try_cast`` / ``try_to_timestamp``
for parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text layouts the pipelines read and write.
ISO_MILLIS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
DATE = "yyyy-MM-dd"


def split_invoice_datetime(col: str = "InvoiceDate") -> dict[str, Column]:
    """'M/d/yy H:mm' (or a 4-digit year) -> clean 'yyyy-MM-dd', 'HH:mm' and a timestamp.

    Two-digit years are padded with '20'; one-digit day, month and hour are zero-padded; a time
    with seconds is cut to HH:mm (``lpad`` truncates). Anything unparseable gives NULLs.
    """
    parts = F.split(F.col(col), " ")
    date_parts = F.split(F.get(parts, 0), "/")
    raw_time = F.get(parts, 1)
    clean_date = F.concat(F.lpad(F.get(date_parts, 2), 4, "20"), F.lit("-"),
                          F.lpad(F.get(date_parts, 0), 2, "0"), F.lit("-"),
                          F.lpad(F.get(date_parts, 1), 2, "0"))
    clean_time = F.lpad(raw_time, 5, "0")
    stamp = F.concat(clean_date, F.lit(" "), clean_time).try_cast("timestamp_ntz")
    return {"date": clean_date, "time": clean_time, "InvoiceDatetime": stamp}


def parse_utc_millis(col: str | Column) -> Column:
    """ISO-8601 text with millis and a 'Z' suffix -> TIMESTAMP_NTZ holding the UTC wall clock.

    Input without millis does not match the layout and yields NULL (no job failure).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(ISO_MILLIS_Z)).cast("timestamp_ntz")


def utc_to_local(col: str | Column, tz: str = "Europe/London") -> Column:
    """UTC wall clock -> local wall clock of ``tz`` (TIMESTAMP_NTZ; independent of the session zone)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), c.cast("timestamp_ntz"))


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds_to_ts(col: str | Column) -> Column:
    """Epoch seconds (long) -> TIMESTAMP_NTZ holding the UTC wall clock, whatever the session zone."""
    c = F.col(col) if isinstance(col, str) else col
    return _epoch_ntz() + F.make_dt_interval(secs=c.cast("decimal(18,6)"))


def ntz_to_epoch_seconds(col: str | Column) -> Column:
    """TIMESTAMP_NTZ read as UTC -> epoch seconds (long); NTZ input is not shifted by the zone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_timestamp(c.cast("timestamp_ntz"))


def with_time_parts(df: DataFrame, ts: str, prefix: str) -> DataFrame:
    """Add <prefix>_date (date) and <prefix>_year/_month/_day/_hour (strings) from a timestamp."""
    return df.withColumns({
        f"{prefix}_date": F.to_date(F.col(ts)),
        f"{prefix}_year": F.date_format(ts, "yyyy"),
        f"{prefix}_month": F.date_format(ts, "MM"),
        f"{prefix}_day": F.date_format(ts, "dd"),
        f"{prefix}_hour": F.date_format(ts, "HH"),
    })
