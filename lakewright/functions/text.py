"""Text predicates and conversions used when profiling or casting text columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters removed when a value is trimmed, and the text patterns.
TRIM_CHARS = " \t\r\n"
WHITESPACE_ONLY = r"^\s+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
GUARDED_NUMBER = r"^-?[0-9]*\.?[0-9]+([eE][+-]?[0-9]+)?$"
REPEATED_DIGIT = r"^-?(\d)\1+$"

# The date layouts that make a text column a date column. Each layout is a
# pattern for the start of the value (what follows it is ignored), the rewrite of that
# start and the Spark datetime pattern of the rewritten text.
DATE_LAYOUTS = [
    ("year-month-day", r"^(\d{1,4})-(\d{1,2})-(\d{1,2}).*$", "$1-$2-$3", "y-M-d"),
    ("month/day/year", r"^(\d{1,2})/(\d{1,2})/(\d{1,4}).*$", "$3-$1-$2", "y-M-d"),
    ("month-day-year", r"^(\d{1,2})-(\d{1,2})-(\d{1,4}).*$", "$3-$1-$2", "y-M-d"),
    ("year/month/day", r"^(\d{1,4})/(\d{1,2})/(\d{1,2}).*$", "$1-$2-$3", "y-M-d"),
    ("day-monthname-year", r"^(\d{1,2})-([A-Za-z]{3})-(\d{1,4}).*$", "$3-$2-$1", "y-MMM-d"),
    ("yearmonthday", r"^(\d{4})(\d{2})(\d{1,2}).*$", "$1-$2-$3", "y-M-d"),
]
MAY_BE_DATE = r"^\d{1,4}[-/]|^\d{7}"


def trim_blanks(c: Column) -> Column:
    """Strip spaces, tabs and line ends from both ends (plain ``trim`` strips spaces only)."""
    return F.btrim(c, F.lit(TRIM_CHARS))


def blank_to_null(c: Column) -> Column:
    return F.when(trim_blanks(c) != "", c)


def is_number(c: Column) -> Column:
    return trim_blanks(c).rlike(NUMBER)


def to_number(c: Column) -> Column:
    """Text to double, NULL where the text is not a decimal number."""
    trimmed = trim_blanks(c)
    return F.when(trimmed.rlike(NUMBER), trimmed.try_cast("double"))


def guarded_number(c: Column, data_type: T.DataType) -> Column:
    """Text to a numeric type, NULL where the text is not strictly a number: ``.5`` and
    ``1e3`` pass, ``5.``, ``+5`` and ``abc`` do not."""
    pattern = r"^-?[0-9]+$" if isinstance(data_type, T.IntegralType) else GUARDED_NUMBER
    return F.when(c.rlike(pattern), c.try_cast(data_type))


def date_layout_match(c: Column, layout: tuple[str, str, str, str]) -> Column:
    """True where the text starts with a valid date in ``layout``; text after it is ignored."""
    _, pattern, rewrite, fmt = layout
    pattern = "(?s)" + pattern  # what follows the date may hold line ends
    start = F.when(c.rlike(pattern), F.regexp_replace(c, pattern, rewrite))
    return F.coalesce(
        c.rlike(MAY_BE_DATE) & F.try_to_timestamp(start, F.lit(fmt)).isNotNull(), F.lit(False)
    )


def as_text(c: Column, data_type: T.DataType) -> Column:
    """The text a typed column is profiled as: numbers print without trailing zeros and
    booleans in capitals, so typed and text copies of a column profile alike."""
    if isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e15))
        return F.when(whole, c.try_cast("bigint").cast("string")).otherwise(c.cast("string"))
    if isinstance(data_type, T.DecimalType) and data_type.scale > 0:
        return F.regexp_replace(c.cast("string"), r"\.?0+$", "")
    if isinstance(data_type, T.BooleanType):
        return F.upper(c.cast("string"))
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast("string")


def plain_number(c: Column) -> Column:
    """Short text of a number for messages: 25.0 reads as 25."""
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def yes_no(c: Column) -> Column:
    """Y, YES, TRUE and 1 (any case) are true; everything else, NULL included, is false."""
    return F.coalesce(F.upper(c.cast("string")).isin("Y", "YES", "TRUE", "1"), F.lit(False))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage rounded half-even; 0 when the whole is 0."""
    return F.when(whole > 0, F.bround(part / whole * 100, digits)).otherwise(F.lit(0.0))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
