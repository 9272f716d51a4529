"""Dated index names and zone-independent time values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# Date suffix of an index name, and the split of a name into base and suffix.
DATE_SUFFIX = "yyyyMMdd"
NAME_PATTERN = r"^(.*?)(\d+)$"


def utc_wall_clock(df: DataFrame, column: str) -> Column:
    """The column as a zone-free timestamp in UTC."""
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        return F.col(column)
    instant = F.col(column).cast("timestamp")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def utc_millis(df: DataFrame, column: str) -> Column:
    """Milliseconds since the epoch, the same in every session time zone."""
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        seconds = F.expr(
            f"cast(cast(`{column}` - timestamp_ntz'1970-01-01 00:00:00' as interval second) as decimal(20,6))"
        )
        return F.floor(seconds * 1000).cast("long")
    return F.unix_millis(F.col(column).cast("timestamp"))


def dated_name(df: DataFrame, base: str, column: str, pattern: str = DATE_SUFFIX) -> Column:
    """``base`` followed by the formatted UTC time of ``column``."""
    return F.concat(F.lit(base), F.date_format(utc_wall_clock(df, column), pattern))


def base_of(name: Column, pattern: str = NAME_PATTERN) -> Column:
    """The name without its numeric suffix; empty when the name has none."""
    return F.regexp_extract(name, pattern, 1)


def suffix_of(name: Column, pattern: str = NAME_PATTERN) -> Column:
    """The numeric suffix, null when the name has none."""
    return F.nullif(F.regexp_extract(name, pattern, 2), F.lit("")).cast("long")
