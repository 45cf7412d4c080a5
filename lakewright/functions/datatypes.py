"""Declared SQL types: parsing, describing, comparing and casting to them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions.text import NUMBER, guarded_number, trim_blanks

# Which Spark type holds each declared type.
SPARK_TYPES: dict[str, T.DataType] = {
    "text": T.StringType(),
    "character varying": T.StringType(),
    "varchar": T.StringType(),
    "char": T.StringType(),
    "character": T.StringType(),
    "smallint": T.ShortType(),
    "int2": T.ShortType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "int4": T.IntegerType(),
    "bigint": T.LongType(),
    "int8": T.LongType(),
    "numeric": T.DecimalType(38, 10),
    "decimal": T.DecimalType(38, 10),
    "real": T.FloatType(),
    "float4": T.FloatType(),
    "double precision": T.DoubleType(),
    "double": T.DoubleType(),
    "float8": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamp without time zone": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
    "timestamp with time zone": T.TimestampType(),
    "time": T.StringType(),
    "time without time zone": T.StringType(),
    "timetz": T.StringType(),
}

# Families observed types are compared in.
INTEGER_NAMES = ["integer", "int", "int4", "smallint", "int2", "bigint", "int8"]
INTEGER_UDTS = ["int4", "int2", "int8"]
NUMERIC_NAMES = ["numeric", "decimal", "real", "double precision"]
NUMERIC_UDTS = ["numeric", "float4", "float8"]

# How specific a type is when sources disagree; unknown types rank as text.
TYPE_RANK = {
    "TIMESTAMPTZ": 10,
    "TIMESTAMP": 9,
    "DATE": 8,
    "TIMETZ": 7,
    "TIME": 6,
    "DOUBLE PRECISION": 5,
    "REAL": 5,
    "NUMERIC": 4,
    "BIGINT": 3,
    "INTEGER": 2,
    "SMALLINT": 1,
    "BOOLEAN": 0,
    "TEXT": -1,
}

# How dates and times are written in extracts. Each text is parsed by the one
# pattern its shape calls for, so that texts which fit none cost a comparison and no more.
DATE_TEXT = [
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
]
MOMENT_TEXT = [
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}(:\d{1,2})?$", "M/d/yyyy H:m[:s]"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}(:\d{1,2})? [AaPp][Mm]$", "M/d/yyyy h:m[:s] a"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}(:\d{1,2})?$", "yyyy/M/d H:m[:s]"),
]
CLOCK_TEXT = [
    (r"^\d{1,2}:\d{1,2}(:\d{1,2})?$", "H:m[:s]"),
    (r"^\d{1,2}:\d{1,2}(:\d{1,2})? [AaPp][Mm]$", "h:m[:s] a"),
]
ISO_START = r"^\d{4}-\d{1,2}-\d{1,2}"
WHOLE_NUMBER = r"^[+-]?[0-9]+$"


def base_name(declared: str) -> str:
    return re.sub(r"\s*\(.*\)", "", declared.strip().lower()).strip()


def is_time(declared: str) -> bool:
    return base_name(declared) in ("time", "time without time zone", "timetz")


def spark_type(declared: str) -> T.DataType | None:
    """The Spark type of a declared SQL type, NULL for a type that is not known."""
    sized = re.fullmatch(
        r"(?:numeric|decimal)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", declared.strip().lower()
    )
    if sized:
        return T.DecimalType(int(sized.group(1)), int(sized.group(2) or 0))
    return SPARK_TYPES.get(base_name(declared))


def declared_name(data_type: T.DataType) -> tuple[str, str]:
    """(type name, short type name) of a Spark type in catalog wording."""
    names = {
        T.StringType: ("text", "text"),
        T.ShortType: ("smallint", "int2"),
        T.ByteType: ("smallint", "int2"),
        T.IntegerType: ("integer", "int4"),
        T.LongType: ("bigint", "int8"),
        T.DecimalType: ("numeric", "numeric"),
        T.FloatType: ("real", "float4"),
        T.DoubleType: ("double precision", "float8"),
        T.BooleanType: ("boolean", "bool"),
        T.DateType: ("date", "date"),
        T.TimestampNTZType: ("timestamp without time zone", "timestamp"),
        T.TimestampType: ("timestamp with time zone", "timestamptz"),
    }
    return names.get(type(data_type), (data_type.simpleString(), data_type.simpleString()))


def normalized_type(data_type: Column, udt: Column) -> Column:
    """Observed type reduced to integer, numeric, boolean, date, timestamp, time or text."""
    name = F.lower(F.coalesce(data_type, F.lit("")))
    short = F.lower(F.coalesce(udt, F.lit("")))
    return (
        F.when(name.isin(INTEGER_NAMES) | short.isin(INTEGER_UDTS), "integer")
        .when(name.isin(NUMERIC_NAMES) | short.isin(NUMERIC_UDTS), "numeric")
        .when((name == "boolean") | (short == "bool"), "boolean")
        .when(name == "date", "date")
        .when(name.contains("timestamp"), "timestamp")
        .when(name.startswith("time"), "time")
        .otherwise("text")
    )


def type_descriptor(data_type: Column, length: Column, precision: Column, scale: Column) -> Column:
    """One-word description of a column type, sizes included."""
    name = F.coalesce(data_type, F.lit(""))
    return (
        F.when(length.isNotNull(), F.concat(F.lit("varchar("), length.cast("string"), F.lit(")")))
        .when(
            precision.isNotNull() & scale.isNotNull(),
            F.format_string("numeric(%d,%d)", precision.cast("int"), scale.cast("int")),
        )
        .when(name.isin("boolean", "integer", "date"), name)
        .when(name.contains("timestamp"), "timestamp")
        .otherwise("text")
    )


def type_rank(sql_type: Column) -> Column:
    """How specific a type text such as ``NUMERIC(9,2)`` is."""
    base = F.trim(F.regexp_extract(sql_type, "^[A-Z ]+", 0))
    ranks = F.create_map(*[F.lit(x) for pair in TYPE_RANK.items() for x in pair])
    return F.coalesce(F.try_element_at(ranks, base), F.lit(-1))


def _parsed(c: Column, shapes: list[tuple[str, str]]) -> Column:
    """The moment a text spells, by the pattern of the shape it has; NULL without one."""
    return F.coalesce(*[
        F.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(pattern)))
        for shape, pattern in shapes
    ])


def _must_parse(c: Column, parsed: Column, wanted: str) -> Column:
    complaint = F.concat(F.lit("invalid value for "), F.lit(wanted), F.lit(": "), c)
    return F.when(c.isNull() | parsed.isNotNull(), parsed).otherwise(F.raise_error(complaint))


def strict_cast(c: Column, declared: str) -> Column:
    """Cast text to a declared type; a value that does not fit fails the job."""
    target = spark_type(declared)
    if target is None:
        raise ValueError(f"unknown type {declared!r}")
    sized = re.fullmatch(r"(?:varchar|character varying|char|character)\s*\(\s*(\d+)\s*\)",
                         declared.strip().lower())
    if sized:
        return F.substring(c, 1, int(sized.group(1)))
    trimmed = trim_blanks(c)
    if is_time(declared):
        clock = F.date_format(_parsed(trimmed, CLOCK_TEXT), "HH:mm:ss")
        return _must_parse(trimmed, clock, declared)
    if isinstance(target, T.DateType):
        iso = F.when(trimmed.rlike(ISO_START), trimmed.try_cast("date"))
        day = F.coalesce(iso, _parsed(trimmed, DATE_TEXT).cast("date"))
        return _must_parse(trimmed, day, declared)
    if isinstance(target, (T.TimestampNTZType, T.TimestampType)):
        iso = F.when(trimmed.rlike(ISO_START), trimmed.try_cast(target))
        moment = F.coalesce(iso, _parsed(trimmed, MOMENT_TEXT + DATE_TEXT).cast(target))
        return _must_parse(trimmed, moment, declared)
    if isinstance(target, T.BooleanType):
        switch = F.when(F.lower(trimmed) == "on", "true").when(F.lower(trimmed) == "off", "false")
        return F.coalesce(switch, trimmed).cast(target)
    if isinstance(target, T.StringType):
        return c
    return trimmed.cast(target)


def lenient_cast(c: Column, descriptor: str) -> Column:
    """Cast text to the type of a descriptor; what does not parse becomes NULL."""
    trimmed = trim_blanks(c)
    present = F.when(~trimmed.isin("", "NA"), trimmed)
    kind = descriptor.strip().lower()
    if kind == "integer":
        return F.when(present.rlike(WHOLE_NUMBER), present.try_cast("int"))
    if kind == "boolean":
        return F.when(present.isin("T", "TRUE", "True", "true", "t", "1"), F.lit(True)).when(
            present.isin("F", "FALSE", "False", "false", "f", "0"), F.lit(False)
        )
    if kind == "timestamp":
        return F.when(present.rlike(ISO_START), present.try_cast("timestamp_ntz"))
    if kind == "date":
        shapes = [(ISO_START + "$", "yyyy-M-d"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d")]
        return _parsed(present, shapes).cast("date")
    if kind.startswith("numeric("):
        return F.when(present.rlike(NUMBER), present.try_cast("double"))
    return c


def convert(c: Column, source: T.DataType, target: T.DataType | None) -> Column:
    """Cast between staging and target types; text to number is guarded, an unknown target
    type leaves the value as it is."""
    if target is None or source == target:
        return c
    if isinstance(source, T.StringType) and isinstance(target, T.NumericType):
        return guarded_number(c, target)
    return c.cast(target)
