"""Text and number clean-up as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, NumericType, StringType

MONEY = DecimalType(18, 2)

_WHITESPACE = " \t\n\r\x0b\x0c"
# An optional sign, digits with at most one point, an optional exponent. Spark's own cast also
# takes "1d" and "2f", which are not amounts.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

__all__ = [
    "MONEY", "strip", "blank_to_null", "upper_text", "slashes", "voucher_key", "flag_text",
    "to_number", "number_is_invalid", "null_if_nan", "scrub_line_breaks", "concat_nulls_as_blank",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of whitespace at both ends (plain trim only removes spaces)."""
    return F.trim(_col(c).cast("string"), F.lit(_WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def upper_text(c: Column | str) -> Column:
    """Upper-cased, trimmed text; null becomes the empty string so that `contains` is never null."""
    return F.coalesce(F.upper(strip(c)), F.lit(""))


def slashes(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit("\\"), F.lit("/"))


def voucher_key(c: Column | str) -> Column:
    """Match key of a voucher number: trimmed, upper case, a trailing ".0" of a float removed.

    Blank becomes null, so a missing number never matches another missing number.
    """
    return F.nullif(F.regexp_replace(F.upper(strip(c)), r"^([0-9]+)\.0$", "$1"), F.lit(""))


def flag_text(c: Column | str) -> Column:
    """Text of a flag column, with 1.0 written as 1."""
    return F.regexp_replace(_col(c).cast("string"), r"^([0-9]+)\.0$", "$1")


def null_if_nan(c: Column | str, dtype: DataType) -> Column:
    """NaN to null for floating columns; other types pass."""
    c = _col(c)
    if dtype.typeName() in ("double", "float"):
        return F.when(~F.isnan(c), c)
    return c


def to_number(c: Column | str, source: DataType = StringType(), target: DataType = MONEY, fill=None) -> Column:
    """Lenient number parsing: commas and spaces dropped, blank or unreadable text becomes null.

    `source` is the type of the column; numeric columns are only cast. `fill` replaces null.
    """
    c = _col(c)
    if isinstance(source, NumericType):
        value = null_if_nan(c, source).try_cast(target)
    else:
        text = strip(F.translate(c.cast("string"), ", ", ""))
        value = F.when(text.rlike(_NUMBER), text.try_cast(target))
    return value if fill is None else F.coalesce(value, F.lit(fill).cast(target))


def number_is_invalid(c: Column | str, source: DataType = StringType()) -> Column:
    """True where a value is present but does not read as a number."""
    return _col(c).isNotNull() & to_number(c, source).isNull()


def scrub_line_breaks(c: Column | str) -> Column:
    return F.translate(_col(c), "\r\n", "")


def concat_nulls_as_blank(*parts: Column | str) -> Column:
    """Concatenation that reads null as the empty string."""
    return F.concat(*[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts])
