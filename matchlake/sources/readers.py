"""Source readers: one distributed read per entity instead of one request per match."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as s
from ..operators.joins import only_keys, with_ids
from ..operators.shaping import cleaned_column
from .seasons import replace_seasons


def text_schema(schema: T.StructType) -> T.StructType:
    """Same columns with every scalar read as text, so that cleaning sees raw values.

    Lists inside a row (cards, positions) keep their types: cleaning leaves them.
    """
    return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in schema.fields])


def _as_text(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return text_schema(kind)
    if isinstance(kind, T.MapType):
        return T.MapType(T.StringType(), T.ArrayType(text_schema(kind.valueType.elementType)))
    return kind if isinstance(kind, T.ArrayType) else T.StringType()


def read_source(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """Parquet keeps its stored types; text formats are read as raw text."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.schema(text_schema(schema))
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


CORRUPT, SOURCE_FILE = "_corrupt_record", "source_file"


def read_checked(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                 required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The rows of a text source that can be used, and the rejected ones as (source_file, reason, record).

    A line that does not parse, or a CSV line with another number of columns, is ``unreadable`` and kept as it is; a row
    whose column in ``required`` is missing, or does not clean to its declared type, is ``without <column>`` and kept as JSON.
    Both frames read the source; nothing is dropped silently and no line stops a load.
    """
    raw = text_schema(schema)
    reader = spark.read.schema(raw.add(T.StructField(CORRUPT, T.StringType()))).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if fmt == "csv":
        # all columns are parsed, or lines of another length would pass when few are asked for
        reader = reader.option("header", True).option("enforceSchema", False).option("columnPruning", False)
    rows = reader.format(fmt).load(path)
    names = [f"`{name}`" for name in schema.names]
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("unreadable"))
    for name in required:
        reason = reason.when(cleaned_column(rows, name, schema).isNull(), F.lit(f"without {name}"))
    judged = rows.select(*names, CORRUPT, F.col("_metadata.file_path").alias(SOURCE_FILE), reason.alias("reason"))
    record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*names)))
    return judged.filter("reason IS NULL").select(*names), judged.filter("reason IS NOT NULL").select(SOURCE_FILE, "reason", record.alias("record"))


def store_rejected(rejected: DataFrame, table: str, source: str, now: datetime) -> None:
    """Keep the rejected rows of a load beside those of others; repeating the load replaces its own."""
    stamped = rejected.withColumns({"source": F.lit(source), "loaded_at": F.lit(now.isoformat(sep=" "))})
    replace_seasons(stamped, table, season=["source", "loaded_at"])


def read_competitions(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_source(spark, path, s.COMPETITIONS_SOURCE, fmt)


def read_matches(spark: SparkSession, path: str, fmt: str = "json",
                 pairs: DataFrame | None = None) -> DataFrame:
    """Matches, optionally of the given (competition, season) pairs only."""
    matches = read_source(spark, path, s.MATCHES_SOURCE, fmt)
    return matches if pairs is None else only_keys(matches, pairs, s.COMPETITION_KEY)


def read_events(spark: SparkSession, path: str, fmt: str = "json",
                match_ids: DataFrame | None = None) -> DataFrame:
    """Events, optionally of the given matches only. JSON lists arrive as text."""
    events = read_source(spark, path, s.EVENTS_SOURCE, fmt)
    return events if match_ids is None else with_ids(events, F.col("match_id"), match_ids.select(*s.MATCH_KEY))


def read_lineups(spark: SparkSession, path: str, fmt: str = "json",
                 match_ids: DataFrame | None = None) -> DataFrame:
    """Lineups as one row per listed player, tagged with the team."""
    nested = read_source(spark, path, s.LINEUPS_SOURCE, fmt)
    if match_ids is not None:
        nested = only_keys(nested, match_ids, s.MATCH_KEY)
    return team_rows(nested)


def team_rows(nested: DataFrame) -> DataFrame:
    """Team map of each match to one row per player."""
    ids = [name for name in ("competition_id", "season_id", "match_id") if name in nested.columns]
    per_team = nested.select(*ids, F.explode("lineups").alias("team", "players"))
    per_player = per_team.select(*ids, "team", F.explode("players").alias("p"))
    return per_player.select(*ids, "team", "p.*")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_sql(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL over stored tables; keyword frames fill ``{name}`` placeholders."""
    return spark.sql(sql, **frames)
