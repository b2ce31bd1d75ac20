"""Clock and playing-time text as numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake.functions.numbers import ColumnLike, _col, parse_double, round_half_even


def _iso_parts(text: Column) -> tuple[Column, Column, Column]:
    """(is ``PT<m>M<s>S``, minutes, seconds) of an ISO-like duration."""
    parts = F.split(F.substring(text, 3, 2**31 - 1), "M", -1)
    shaped = F.startswith(text, F.lit("PT")) & (F.size(parts) == 2)
    minutes = parse_double(F.get(parts, F.lit(0)))
    seconds = parse_double(F.rtrim(F.get(parts, F.lit(1)), F.lit("S")))
    return shaped, minutes, seconds


def clock_seconds(text: ColumnLike) -> Column:
    """``PT<m>M<s>S`` to seconds, unrounded; any other text is null."""
    shaped, minutes, seconds = _iso_parts(_col(text))
    return F.when(shaped, minutes * 60 + seconds)


def decimal_minutes(text: ColumnLike) -> Column:
    """``mm:ss``, ``PT<m>M<s>S`` or a plain number to minutes with two decimals, else null."""
    c = _col(text)
    shaped, minutes, seconds = _iso_parts(c)
    colon = F.split(c, ":", -1)
    value = (
        F.when(
            F.contains(c, F.lit(":")) & ~F.contains(c, F.lit("PT")),
            parse_double(F.get(colon, F.lit(0))) + parse_double(F.get(colon, F.lit(1))) / 60,
        )
        .when(shaped, minutes + seconds / 60)
        .when(~F.startswith(c, F.lit("PT")), parse_double(c))
    )
    return round_half_even(value, 2)


def normalize_durations(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Replace each named text column by its number.

    ``columns`` maps a column to ``"clock"`` or ``"minutes"``.
    """
    parsers = {"clock": clock_seconds, "minutes": decimal_minutes}
    return df.withColumns({name: parsers[kind](name) for name, kind in columns.items()})


def duration_rejects(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row: per column, how many non-empty texts could not be read."""
    parsed = normalize_durations(
        df.select(*columns, *[F.col(c).alias(f"_raw_{c}") for c in columns]), columns
    )
    return parsed.agg(*[
        F.count_if(F.col(c).isNull() & (F.length(f"_raw_{c}") > 0)).alias(f"{c}_rejects")
        for c in columns
    ])
