"""Cleaning and projection steps that work on any table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleaning as c
from ..schemas import VALID_FROM, VALID_TO


def clean(df: DataFrame, declared: T.StructType, strict: bool = False) -> DataFrame:
    """Coerce the declared columns that are present; others pass through.

    One projection, so it runs inside the scan stage.
    """
    wanted = {field.name: field for field in declared.fields}
    coerce = c.cleaned_strictly if strict else c.cleaned
    return df.select(*[
        coerce(_col(field.name), field.dataType, wanted[field.name]).alias(field.name)
        if field.name in wanted else f"`{field.name}`"
        for field in df.schema.fields
    ])


def cleaned_column(df: DataFrame, name: str, declared: T.StructType) -> Column:
    """One declared column, coerced like ``clean`` does."""
    return c.cleaned(_col(name), df.schema[name].dataType, declared[name])


def align(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Exactly the declared columns in order: missing ones NULL, extra ones dropped."""
    present = dict(df.dtypes)

    def column(field: T.StructField) -> str:
        kind = field.dataType.simpleString()
        if present.get(field.name) == kind:
            return f"`{field.name}`"
        source = f"`{field.name}`" if field.name in present else "NULL"
        return f"CAST({source} AS {kind}) AS `{field.name}`"

    return df.selectExpr(*[column(f) for f in declared.fields])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating point columns to NULL, as written tables hold no NaN."""
    return df.select(*[
        c.nan_to_null(_col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else f"`{f.name}`"
        for f in df.schema.fields
    ])


def repair_names(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: c.repair_quotes(_col(name)) for name in present})


def version_clock(now: datetime) -> tuple[datetime, datetime]:
    """Start of the new versions and end of the old ones (1 ms earlier)."""
    return now, now - timedelta(milliseconds=1)


def naive(ts: datetime | None) -> Column:
    """Timestamp literal without time zone."""
    text = None if ts is None else ts.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def stamp_versions(df: DataFrame, valid_from: datetime) -> DataFrame:
    """Mark rows as open versions that start at ``valid_from``."""
    return df.withColumns({VALID_FROM: naive(valid_from), VALID_TO: naive(None)})


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def project(columns: Mapping[str, Iterable[str]]) -> list[Column]:
    """Select list for aliased tables: ``{alias: column names}``."""
    return [F.col(f"{alias}.`{name}`") for alias, names in columns.items() for name in names]


def names_without(names: Iterable[str], text: str, taken: Iterable[str] = ()) -> list[str]:
    """Column names that do not contain ``text`` and are not taken already."""
    taken = set(taken)
    return [name for name in names if text not in name and name not in taken]


def describe_columns(spark, df: DataFrame) -> DataFrame:
    """Column names and types as rows (reads the schema only)."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def _col(name: str) -> Column:
    return F.col(f"`{name}`")
