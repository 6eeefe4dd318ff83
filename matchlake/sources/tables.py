"""Layer tables in the Spark catalog: create, append, rebuild, empty, clone, drop, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.shaping import align


def create_layer(spark: SparkSession, layer: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}{where}")


def append(df: DataFrame, table: str, declared: T.StructType) -> None:
    """Typed append; creates the table on first use."""
    align(df, declared).write.mode("append").saveAsTable(table)


def rebuild(df: DataFrame, table: str) -> None:
    """Drop and rebuild a table from a query that does not read it."""
    df.write.mode("overwrite").saveAsTable(table)


def rebuild_view(spark: SparkSession, table: str, sql: str) -> None:
    """Zero-copy alternative to ``rebuild`` for a pure selection."""
    drop(spark, table)
    spark.sql(f"CREATE VIEW {table} AS {sql}")


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def empty(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def clone_structure(spark: SparkSession, source: str, target: str) -> None:
    """Empty table with the structure of another one, replacing any old copy."""
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(f"CREATE TABLE {target} LIKE {source}")


def drop(spark: SparkSession, table: str) -> None:
    """Drop a table or view if it is there."""
    schema, name = table.rsplit(".", 1)
    views = spark.sql(f"SHOW VIEWS IN {schema} LIKE '{name}'")
    kind = "TABLE" if views.isEmpty() else "VIEW"
    spark.sql(f"DROP {kind} IF EXISTS {table}")
