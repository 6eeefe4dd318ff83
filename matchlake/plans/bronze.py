"""Bronze layer: incremental loads into version history, cascading to changed children."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as s
from ..operators import filters
from ..operators.history import newer_rows
from ..operators.joins import broadcast_if_small, sized_strategy, with_ids
from ..operators.lineups import flatten_lineups
from ..operators.shaping import align, clean, cleaned_column, repair_names
from ..session import remove_scratch, scratch_path, together, tune
from ..sources.tables import create_layer
from ..sources.versions import history_exists, load_versions, watermarks


@dataclass(frozen=True)
class Sources:
    """Source frames: lineups with nested ``cards`` and ``positions`` per player."""

    competitions: DataFrame
    matches: DataFrame
    events: DataFrame
    lineups: DataFrame


def pick_competitions(source: DataFrame, history: DataFrame | None,
                      competitions: Iterable[int] | None = None, season: int | None = None,
                      min_season: str | None = None) -> DataFrame:
    """Clean competitions in scope that are newer than the watermark of their scope."""
    picked = clean(source, s.COMPETITIONS).filter(
        filters.in_scope(competitions, season, min_season)
    )
    scope = [] if competitions is None else s.COMPETITION_KEY[: 1 if season is None else 2]
    return newer_rows(picked, history, "match_updated", scope)


def pick_matches(source: DataFrame, history: DataFrame | None,
                 changed_competitions: DataFrame) -> DataFrame:
    """Clean newer matches of the changed competitions, watermark per season."""
    matches = clean(_of_parents(source, s.MATCHES, changed_competitions, s.COMPETITION_KEY), s.MATCHES)
    return newer_rows(matches, history, "last_updated", s.COMPETITION_KEY)


def pick_events(source: DataFrame, changed_matches: DataFrame) -> DataFrame:
    """Clean events of the changed matches in the declared columns."""
    events = clean(_of_parents(source, s.EVENTS, changed_matches, s.MATCH_KEY), s.EVENTS)
    return align(repair_names(events, ["player", "pass_recipient"]), s.EVENTS)


def pick_lineups(source: DataFrame, changed_matches: DataFrame) -> DataFrame:
    """Flat lineups of the changed matches, tagged with competition and season."""
    lineups = clean(_of_parents(source, s.LINEUPS, changed_matches, s.MATCH_KEY), s.LINEUPS)
    tagged = tag_seasons(lineups.drop(*s.COMPETITION_KEY), changed_matches)
    return align(clean(flatten_lineups(tagged), s.LINEUPS), s.LINEUPS)


def tag_seasons(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows of a match table with the competition and season of their match."""
    tags = matches.select("match_id", *s.COMPETITION_KEY)
    return rows.join(tags.dropDuplicates(["match_id"]).hint(sized_strategy(tags)), "match_id", "inner")


def _of_parents(source: DataFrame, declared, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Raw rows of the given parents: only the key is cleaned before rows are dropped. The parents' keys are measured."""
    if len(keys) == 1:
        return with_ids(source, cleaned_column(source, keys[0], declared), parents.select(*keys))
    renamed = broadcast_if_small(parents.select(*[F.col(k).alias(f"parent.{k}") for k in keys]))
    same = [cleaned_column(source, k, declared) == F.col(f"`parent.{k}`") for k in keys]
    return source.join(renamed, same, "left_semi")


def in_seasons(source: DataFrame, matches: DataFrame) -> DataFrame:
    """Restrict a source that carries competition and season to the seasons of the matches.

    The pairs, one row per season, are broadcast to the scan and not collected. Where the source is partitioned by them,
    Spark prunes its partitions by the pairs while it runs.
    """
    if not set(s.COMPETITION_KEY) <= set(source.columns):
        return source
    # every id passes this filter: Spark prunes by a join only behind one that it takes for selective
    listed = reduce(Column.__and__, [F.col(k) >= F.lit(-(1 << 63)) for k in s.COMPETITION_KEY])
    # one key of both columns, as Spark prunes by each key for itself
    pairs = matches.filter(listed).select(_pair(*[F.col(k) for k in s.COMPETITION_KEY]).alias("season.pair")).distinct()
    here = _pair(*[cleaned_column(source, k, s.MATCHES) for k in s.COMPETITION_KEY])
    return source.join(F.broadcast(pairs), here == F.col("`season.pair`"), "left_semi")


def _pair(*ids: Column) -> Column:
    """Both ids in one text, NULL if one is missing."""
    return F.concat(ids[0].cast("string"), F.lit("-"), ids[1].cast("string"))


def run_bronze(spark: SparkSession, sources: Sources, now: datetime, layer: str = "bronze",
               competitions: Iterable[int] | None = None, season: int | None = None,
               min_season: str | None = None) -> None:
    """One incremental load of all four tables.

    The four batches are worked out first, each once, and stored. Their versions are written at the same time and committed children
    first: the update times of competitions and matches, from which the next load tells what is new, move only when everything
    below them is in. So a load that stopped half way is simply followed by another, at the same or a later time. The stored batches are
    dropped when all are committed.
    """
    tune(spark)
    create_layer(spark, layer)

    def marks(name: str, column: str) -> DataFrame | None:
        """Newest update time of each season, as stored with the last commit."""
        table = f"{layer}.{name}"
        return watermarks(spark, table, column, s.COMPETITION_KEY) if history_exists(spark, table) else None

    paths = []

    def staged(name: str, rows: DataFrame) -> DataFrame:
        path = scratch_path(spark, f"batch-{name}")
        paths.append(path)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    new_competitions = staged("competitions", pick_competitions(
        sources.competitions, marks("competitions", "match_updated"), competitions, season, min_season))
    new_matches = staged("matches", pick_matches(sources.matches, marks("matches", "last_updated"), new_competitions))
    new_events, new_lineups = together(
        spark,
        lambda: staged("events", tag_seasons(pick_events(in_seasons(sources.events, new_matches), new_matches), new_matches)),
        lambda: staged("lineups", pick_lineups(in_seasons(sources.lineups, new_matches), new_matches)))

    def written(name: str, rows: DataFrame, declared, keys: list[str], newest: str | None, cluster_by: list[str], looked_up: list[str]):
        return lambda: load_versions(spark, f"{layer}.{name}", rows, declared, keys, s.COMPETITION_KEY, now, newest, cluster_by, looked_up, 0, False)

    finishes = together(spark, *[written(*load) for load in (
        ("events", new_events, s.EVENTS, s.EVENT_KEY, None, ["type", "match_id"], ["id", "match_id"]),
        ("lineups", new_lineups, s.LINEUPS, s.LINEUP_KEY, None, s.MATCH_KEY, ["player_id"]),
        ("matches", new_matches, s.MATCHES, s.MATCH_KEY, "last_updated", s.MATCH_KEY, []),
        ("competitions", new_competitions, s.COMPETITIONS, s.COMPETITION_KEY, "match_updated", s.COMPETITION_KEY, []),
    )])
    left = []
    try:
        for finish in finishes:
            left.append(finish(False))
    finally:
        if left:
            together(spark, *left)
    for path in paths:
        remove_scratch(spark, path)
