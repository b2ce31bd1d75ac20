"""Typed coercion of text and numbers.

``coerce_*`` turn what cannot be read into null; ``cast_*_strict`` and
``store_*`` raise instead (they rely on ANSI mode, Spark's default).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = str | Column

# Spark's text-to-double cast also reads Java forms ("1d", "2f", "0x1p3").
# They hold one of these letters where no decimal number, "inf" or "nan" does.
_JAVA_ONLY_NUMBER = "[dDxX]|(^|[^nN])[fF]"
# A cast that fails makes an exception, which costs more than many casts that don't. So text that
# can't be a number is told apart first: neither a digit, nor infinity or NaN in it.
_NO_NUMBER = r"^(?=[^0-9]*\z)(?!(?is).*(nan|inf))"
# All text that casts to bigint looks so, and few others do.
_LIKE_LONG = r"^[^.a-zA-Z]*[0-9][^.a-zA-Z]*\z"
# Decimals are also read from the digits of other scripts.
_ANY_DIGIT = r"\p{Nd}"


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_double(text: ColumnLike) -> Column:
    """Decimal text to double; anything else is null. Blanks around are allowed."""
    c = _col(text)
    return F.when(~c.rlike(f"{_JAVA_ONLY_NUMBER}|{_NO_NUMBER}"), c.try_cast("double"))


def coerce_double(text: ColumnLike) -> Column:
    """As :func:`parse_double`, and JSON ``true``/``false`` count as 1 and 0."""
    c = _col(text)
    return (
        F.when(c == "true", F.lit(1.0)).when(c == "false", F.lit(0.0)).otherwise(parse_double(c))
    )


def coerce_long(text: ColumnLike) -> Column:
    """Integer text to bigint, null when it is not one.

    Text that :func:`is_unsafe_long` flags is null as well, so callers that must
    not lose it test that flag first (and quarantine or raise).
    """
    c = _col(text)
    exact = F.when(c.rlike(_ANY_DIGIT), c.try_cast("decimal(38,18)"))
    return F.coalesce(
        # Nearly all text ends here; the other forms are "12.0" and "1e2".
        F.when(c.rlike(_LIKE_LONG), c.try_cast("bigint")),
        F.when(exact == F.floor(exact), exact.try_cast("bigint")),
        F.when(c == "true", 1).when(c == "false", 0).cast("bigint"),
    )


def is_unsafe_long(text: ColumnLike) -> Column:
    """True for text that is a number but not a 64-bit integer (``1.5``, ``inf``, ``1e30``)."""
    c = _col(text)
    # NaN sorts above infinity, so this is true for numbers and infinities only.
    is_number = F.coalesce(parse_double(c) <= F.lit(float("inf")), F.lit(False))
    return coerce_long(c).isNull() & is_number


def coerce_long_strict(text: ColumnLike) -> Column:
    """As :func:`coerce_long`, but a number that is no integer fails the query."""
    c = _col(text)
    message = F.concat(F.lit("cannot safely cast to an integer: "), c)
    return F.when(is_unsafe_long(c), F.raise_error(message).cast("bigint")).otherwise(
        coerce_long(c)
    )


def cast_int_strict(value: ColumnLike) -> Column:
    """Non-null int; null or text that is no integer fails the query."""
    c = _col(value)
    return F.when(
        c.isNull(), F.raise_error(F.lit("null where an integer is required")).cast("int")
    ).otherwise(c.cast("int"))


def truthy_number(value: ColumnLike) -> Column:
    """0 is false. A missing number has become NaN in a float column, which is true."""
    return F.coalesce(_col(value) != 0, F.lit(True))


def truthy_text(value: ColumnLike) -> Column:
    """Any non-empty text is true, also ``"0"``; null is false."""
    return F.coalesce(F.length(_col(value)) > 0, F.lit(False))


def truthy_bool(value: ColumnLike) -> Column:
    """Null is false."""
    return F.coalesce(_col(value), F.lit(False))


def zero_to_null(value: ColumnLike) -> Column:
    """The id 0 stands for "nobody"."""
    c = _col(value)
    return F.when(c != 0, c)


def round_half_even(value: ColumnLike, digits: int = 2) -> Column:
    """Round the exact binary value of a double, ties to even.

    ``bround`` rounds the shortest decimal text of the double instead, which
    sees a tie in 12.575 although the double lies just below it. Here the exact
    rounding error of ``value * 10**digits`` is recovered by splitting the value
    in two halves of 26 bits, so the comparison with one half is exact.
    """
    x = _col(value)
    scale = float(10**digits)
    scaled = x * F.lit(scale)
    carried = x * F.lit(134217729.0)  # 2**27 + 1
    high = carried - (carried - x)
    low = x - high
    error = (high * F.lit(scale) - scaled) + low * F.lit(scale)
    floor = F.floor(scaled)
    past_half = (scaled - floor - F.lit(0.5)) + error
    rounded = (
        F.when(past_half > 0, floor + 1)
        .when(past_half < 0, floor)
        .otherwise(floor + F.pmod(floor, F.lit(2)))
    )
    # Beyond 2**52 every double is whole; NaN and infinity also pass unchanged.
    return F.when(F.abs(scaled) < F.lit(4503599627370496.0), rounded / F.lit(scale)).otherwise(x)


def store_decimal(value: ColumnLike, precision: int, scale: int) -> Column:
    """Assignment to NUMERIC(p, s): half away from zero, NaN is null, overflow fails."""
    c = _col(value)
    return c.cast(f"decimal({precision},{scale})")


def store_int(value: ColumnLike) -> Column:
    """Assignment of a number to INT: half to even, overflow fails."""
    number = _col(value).cast("double")
    return F.when(~F.isnan(number), F.rint(number)).cast("int")


def store_char(value: ColumnLike, size: int) -> Column:
    """Assignment to CHAR(n): longer text fails, unless only blanks are cut off."""
    c = _col(value)
    message = F.concat(F.lit(f"value too long for char({size}): "), c)
    return F.when(
        F.length(F.rtrim(c)) > size, F.raise_error(message).cast("string")
    ).otherwise(F.substring(c, 1, size))
