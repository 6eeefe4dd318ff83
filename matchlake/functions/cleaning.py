"""Column coercions: sentinel text to NULL, then a tolerant or strict cast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value (exact match).
SENTINELS = ("NaN", "None", "Null", "nan", "null", "")
STRICT_SENTINELS = ("NaN", "None", "Null")

# The extended and the compact ISO-8601 form of a date.
ISO_EXTENDED = r"^\s*\d{4}(-\d{2}(-\d{2}([T ].*)?)?)?\s*$"
ISO_COMPACT = r"^\s*\d{8}\s*$"


def sentinels_to_null(col: Column, sentinels: tuple[str, ...] = SENTINELS) -> Column:
    return F.when(~col.isin(*sentinels), col)


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def to_integer(col: Column, source: T.DataType) -> Column:
    """Whole numbers to bigint; text such as ``12.0`` counts, fractions become NULL."""
    if isinstance(source, T.StringType):
        exact = col.try_cast("decimal(38,18)")
        return F.coalesce(col.try_cast("bigint"), _whole(exact))
    if isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType)):
        return _whole(col)
    return col.try_cast("bigint")


def _whole(col: Column) -> Column:
    whole = col.try_cast("bigint")
    return F.when(col == whole, whole)


def to_double(col: Column, source: T.DataType) -> Column:
    """Number to double; bad text and NaN become NULL."""
    if isinstance(source, T.StringType):
        # the JVM parser also takes literals such as 12d or 12f
        col = F.when(~col.rlike(r"[0-9.]\s*[dDfF]\s*$"), col)
    return nan_to_null(col.try_cast("double"))


def to_boolean(col: Column, source: T.DataType) -> Column:
    return col.try_cast("boolean")


def to_text(col: Column, source: T.DataType) -> Column:
    return col.cast("string")


def to_json_text(col: Column, source: T.DataType) -> Column:
    """JSON text stays as it is; a parsed list or struct is written back as JSON."""
    if isinstance(source, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(col)
    return col.cast("string")


def to_timestamp(col: Column, source: T.DataType) -> Column:
    """ISO-8601 text to a naive UTC timestamp; anything else becomes NULL."""
    if isinstance(source, T.StringType):
        parsed = F.when(col.rlike(ISO_EXTENDED), F.try_to_timestamp(col)).when(
            col.rlike(ISO_COMPACT), F.try_to_timestamp(F.trim(col), F.lit("yyyyMMdd"))
        )
        return parsed.cast("timestamp_ntz")
    return col.try_cast("timestamp_ntz")


def to_date(col: Column, source: T.DataType) -> Column:
    if isinstance(source, T.DateType):
        return col
    return to_timestamp(col, source).cast("date")


_TOLERANT = {
    T.LongType: to_integer,
    T.DoubleType: to_double,
    T.BooleanType: to_boolean,
    T.StringType: to_text,
    T.DateType: to_date,
    T.TimestampNTZType: to_timestamp,
}


def cleaned(col: Column, source: T.DataType, target: T.StructField) -> Column:
    """Tolerant coercion of one declared column."""
    if source == target.dataType and not isinstance(source, (T.StringType, T.DoubleType)):
        return col
    if isinstance(source, T.StringType):
        col = sentinels_to_null(col)
    if target.metadata.get("json"):
        return to_json_text(col, source)
    return _TOLERANT[type(target.dataType)](col, source)


def cleaned_strictly(col: Column, source: T.DataType, target: T.StructField) -> Column:
    """Earlier variant: fewer sentinels, and a bad number or time fails the query."""
    if isinstance(source, T.StringType):
        col = sentinels_to_null(col, STRICT_SENTINELS)
    if isinstance(target.dataType, T.LongType) and isinstance(source, T.StringType):
        return col.cast("decimal(38,18)").cast("bigint")
    if isinstance(target.dataType, T.TimestampNTZType):
        return col.cast("timestamp").cast("timestamp_ntz")
    if isinstance(target.dataType, (T.LongType, T.DoubleType)):
        return col.cast(target.dataType)
    return col


def repair_quotes(col: Column) -> Column:
    """Undo a doubled apostrophe after a capital N (``N''Golo``)."""
    return F.replace(col, F.lit("N''"), F.lit("N'"))
