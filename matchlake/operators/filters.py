"""Predicates of the pipelines; all are plain columns, so Catalyst can push them down."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock, lineups, matches
from ..schemas import TYPE_FOLDED, VALID_TO


def in_scope(competitions: Iterable[int] | None = None, season: int | None = None,
             min_season: str | None = None) -> Column:
    """Competition selection; without a list, all competitions.

    With a season: that season of the competitions. Without one: the seasons
    whose name is not below ``min_season`` (text comparison).
    """
    picked = F.lit(True) if competitions is None else F.col("competition_id").isin(*competitions)
    if season is not None:
        return picked & (F.col("season_id") == season)
    if min_season is not None:
        return picked & (F.col("season_name") >= min_season)
    return picked


def is_current() -> Column:
    return F.col(VALID_TO).isNull()


def is_drawn_knockout() -> Column:
    return (F.col("competition_stage_ranking") > 1) & (F.col("winning_team") == matches.DRAW)


def is_shootout_goal() -> Column:
    return (F.col("period") == 5) & (F.col("type") == "Shot") & (F.col("shot_outcome") == "Goal")


def is_pass(events: DataFrame | None = None) -> Column:
    """Pass in any case. Events that were stored with their folded type are compared by it, which the scan can do."""
    folded = events is not None and TYPE_FOLDED in events.columns
    return (F.col(TYPE_FOLDED) if folded else F.lower(F.col("type"))) == "pass"


def is_timed_half_end() -> Column:
    return clock.is_half_end() & F.col("period").isin(*[p for p, _, _ in clock.PERIODS])


def is_final() -> Column:
    return F.col("competition_stage_ranking").isin(matches.THIRD_PLACE_RANK, matches.FINAL_RANK)


def relevant_stints(stints: DataFrame) -> DataFrame:
    return stints.filter(lineups.is_relevant(F.col("start_reason"), F.col("end_reason")))


def other_stints(stints: DataFrame) -> DataFrame:
    """Stints whose reasons the lineup summary does not account for."""
    return stints.filter(~lineups.is_relevant(F.col("start_reason"), F.col("end_reason")))


def by_id(df: DataFrame, event_id: str) -> DataFrame:
    return df.filter(F.col("id") == event_id)


def type_contains(df: DataFrame, text: str) -> DataFrame:
    return df.filter(F.lower(F.col("type")).like(f"%{text}%"))


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()
