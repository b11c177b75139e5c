"""Date functions: ISO text -> zone-less timestamp, date keys, calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ts(text: Column) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ. An offset or 'Z' is dropped and the wall
    clock kept; empty or unparsable text -> NULL."""
    return F.nullif(py_strip_ws(text), F.lit("")).try_cast("timestamp_ntz")


def py_strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def time_key(d: Column) -> Column:
    """yyyymmdd integer key of a date."""
    return F.date_format(d, "yyyyMMdd").cast("int")


def calendar_columns(d: Column) -> list[Column]:
    return [time_key(d).alias("time_key"), d.alias("date"),
            F.month(d).cast("int").alias("month"),
            F.quarter(d).cast("int").alias("quarter"),
            F.year(d).cast("int").alias("year")]
