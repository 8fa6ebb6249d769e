"""Dates and calendar buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: the text form of every timestamp in the input files.
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def as_date(df: DataFrame, name: str) -> Column:
    """Calendar date of a timestamp, date or text column; null for null. Unreadable text fails the job."""
    value = df[name]
    if isinstance(df.schema[name].dataType, StringType):
        read = F.try_to_timestamp(value, F.lit(TEXT_FORMAT))
        unreadable = F.raise_error(F.concat(F.lit(f"{name} holds no time: "), value))
        value = F.when(value.isNull() | read.isNotNull(), read).otherwise(unreadable)
    return F.to_date(value)


def days_between(start: Column, end: Column) -> Column:
    return F.date_diff(end, start)


def month_start(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "MM")


def month_label(month: Column) -> Column:
    """Jan ... Dec for 1 ... 12."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMM")


def _on_or_after(df: DataFrame, name: str, day: Column) -> Column:
    """Compares the stored value in its own type, so that a fixed day reaches the Parquet scan."""
    kind = df.schema[name].dataType
    if isinstance(kind, StringType):
        return as_date(df, name) >= day
    return df[name] >= day.cast(kind)


def on_or_after(df: DataFrame, name: str, day: str) -> Column:
    """True from one day (``yyyy-MM-dd``) on."""
    return _on_or_after(df, name, F.lit(day).cast("date"))


def in_year(df: DataFrame, name: str, year: int | Column, *, partition: str | None = None) -> Column:
    """True for rows of one calendar year, as a range; ``year(ts) = y`` would not reach the scan.

    ``partition`` names a year column the table may be partitioned by. Its neighbour years are read
    too, since the year was cut in the time zone of the job that wrote the table.
    """
    first, following = (
        F.lit(f"{y:04d}-01-01").cast("date") if isinstance(y, int) else F.make_date(y, F.lit(1), F.lit(1))
        for y in (year, year + 1)
    )
    wanted = _on_or_after(df, name, first) & ~_on_or_after(df, name, following)
    if partition in df.columns:
        wanted &= df[partition].between(year - 1, year + 1)
    return wanted


def year_before_last(df: DataFrame, name: str) -> Column:
    """Last full year: the one before the year of the newest row (a scalar subquery)."""
    return df.agg((F.year(F.max(as_date(df, name))) - 1).alias("year")).scalar()
