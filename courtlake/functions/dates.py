"""Dates and seasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.functions.numbers import ColumnLike, _col

# Fixed value: a season runs from this month to the month before it next year.
SEASON_START_MONTH = 10

# Formats tried in turn by the lenient parser.
LENIENT_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyyMMdd",
                   "MM/dd/yyyy", "yyyy/MM/dd", "MMM d, yyyy")


def season_of_date(day: ColumnLike) -> Column:
    """First calendar year of the season a date belongs to."""
    d = _col(day).cast("date")
    return F.when(F.month(d) >= SEASON_START_MONTH, F.year(d)).otherwise(F.year(d) - 1)


def season_of_id(season_id: ColumnLike) -> Column:
    """Season year in the last four characters of a season id (``22023`` -> 2023)."""
    text = _col(season_id).cast("string")
    return F.right(text, F.lit(4)).cast("int")


def parse_date(text: ColumnLike, fmt: str = "yyyyMMdd") -> Column:
    """Text of one fixed format to a date, else null."""
    c = _col(text)
    # Text without the digits of a year would fail by an exception, which costs more than the look.
    readable = F.when(c.rlike("[0-9]"), c) if "yyyy" in fmt else c
    return F.try_to_timestamp(readable, F.lit(fmt)).cast("date")


def parse_date_lenient(text: ColumnLike, formats: tuple[str, ...] = LENIENT_FORMATS) -> Column:
    """The first of several formats that reads the text, else null."""
    return F.coalesce(*[parse_date(text, fmt) for fmt in formats])


def date_sequence(bounds: DataFrame, start: ColumnLike, end: ColumnLike,
                  name: str = "game_date") -> DataFrame:
    """Every day from start to end, both included, for each row of ``bounds``."""
    days = F.sequence(_col(start).cast("date"), _col(end).cast("date"))
    # An end before the start is an empty range, not a descending one.
    forward = F.when(_col(start).cast("date") <= _col(end).cast("date"), days)
    return bounds.select(F.explode(forward).alias(name))


def date_range(spark: SparkSession, start: str, end: str, name: str = "game_date") -> DataFrame:
    """Every day from ``start`` to ``end`` (ISO text), both included."""
    return date_sequence(spark.range(1), F.lit(start), F.lit(end), name)
