"""Silver layer: current rows, match results, shoot-outs, the combined event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as s
from ..functions import matches as mx
from ..operators import filters
from ..operators.history import current_versions
from ..operators.joins import attach_detail
from ..operators.shaping import names_without
from ..sources import dealt


def snapshot(history: DataFrame, derived: dict[str, Column] | None = None) -> DataFrame:
    """Current rows of a history, plus optional derived columns."""
    current = current_versions(history)
    return current.withColumns(derived) if derived else current


def match_columns() -> dict[str, Column]:
    """Columns silver adds to a match; the shoot-out columns start at 0."""
    stage = F.col("competition_stage")
    return {
        "match_name": mx.match_label(),
        "winning_team": mx.winning_team(),
        "winning_team_id": mx.winning_team_id(),
        "competition_stage_ranking": mx.stage_rank(stage),
        "fixed_competition_stage": mx.normalised_stage(stage),
        "penalty_shootout": F.lit(0),
        "home_pen_score": F.lit(0),
        "away_pen_score": F.lit(0),
    }


def drawn_knockouts(matches: DataFrame) -> DataFrame:
    return matches.filter(filters.is_drawn_knockout()).select(
        "match_id", "home_team", "away_team", "home_team_id", "away_team_id"
    )


def shootout_goals(events: DataFrame) -> DataFrame:
    """Shoot-out goals per match and team, combined before the shuffle."""
    goals = events.filter(filters.is_shootout_goal())
    return goals.groupBy("match_id", "team").agg(
        F.count(F.lit(1)).alias("goals"), F.min("team_id").alias("scorer_id")
    )


def shootout_results(matches: DataFrame, events: DataFrame) -> DataFrame:
    """Winner and scores of each drawn knock-out match that has shoot-out goals."""
    # not for Spark to estimate: drawn matches grow with the input and would be broadcast (see ``sized_strategy``)
    scored = shootout_goals(events).join(drawn_knockouts(matches).hint("merge"), "match_id", "inner")
    home, away = F.col("team") == F.col("home_team"), F.col("team") == F.col("away_team")

    def side(hit: Column, name: str) -> Column:
        return F.max(F.when(hit, F.col(name)))

    tally = scored.groupBy("match_id", "home_team", "away_team").agg(
        F.coalesce(side(home, "goals"), F.lit(0)).cast("int").alias("home_goals"),
        F.coalesce(side(away, "goals"), F.lit(0)).cast("int").alias("away_goals"),
        F.coalesce(side(home, "scorer_id"), F.max("home_team_id")).alias("home_id"),
        F.coalesce(side(away, "scorer_id"), F.max("away_team_id")).alias("away_id"),
    )
    home_won = F.col("home_goals") > F.col("away_goals")
    return tally.select(
        "match_id",
        F.when(home_won, F.col("home_team")).otherwise(F.col("away_team")).alias("shootout_winner"),
        F.when(home_won, F.col("home_id")).otherwise(F.col("away_id")).alias("shootout_winner_id"),
        "home_goals",
        "away_goals",
    )


def patch_shootouts(matches: DataFrame, events: DataFrame) -> DataFrame:
    """Replace the drawn result of the matches a shoot-out decided."""
    results = shootout_results(matches, events)
    decided = F.col("home_goals").isNotNull()
    patched = matches.join(results, "match_id", "left").withColumns({
        "penalty_shootout": F.when(decided, F.lit(1)).otherwise(F.col("penalty_shootout")),
        "winning_team": F.coalesce("shootout_winner", "winning_team"),
        "winning_team_id": F.coalesce("shootout_winner_id", "winning_team_id"),
        "home_pen_score": F.coalesce("home_goals", "home_pen_score"),
        "away_pen_score": F.coalesce("away_goals", "away_pen_score"),
    })
    return patched.select(*matches.columns)


def silver_matches(bronze_matches: DataFrame, bronze_events: DataFrame) -> DataFrame:
    matches = snapshot(bronze_matches, match_columns())
    return patch_shootouts(matches, current_versions(bronze_events))


def competition_matches(competitions: DataFrame, matches: DataFrame) -> DataFrame:
    """Match grain of the combined table: every competition, with its matches if any."""
    parents = competitions.select(*s.COMBINED_COMPETITION_COLUMNS)
    keys = s.COMPETITION_KEY
    return attach_detail(parents, matches.select(*keys, *s.COMBINED_MATCH_COLUMNS), keys)


def combined(match_grain: DataFrame, events: DataFrame, strategy: str | None = None) -> DataFrame:
    """Event grain of the combined table: every match, with its events if any.

    ``strategy`` is the join hint for the match grain (see ``strategy_for``).
    """
    details = events.select("match_id", *[f"`{c}`" for c in s.COMBINED_EVENT_COLUMNS])
    return attach_detail(match_grain, details, s.MATCH_KEY, strategy)


def combined_in_parts(match_grain: DataFrame, events: DataFrame, strategy: str | None = None) -> DataFrame:
    """Like ``combined``, from tables dealt by match and part (``sources.dealt``): no exchange if both are bucketed alike."""
    details = events.select(*dealt.DEALT_BY, *[f"`{c}`" for c in s.COMBINED_EVENT_COLUMNS])
    return attach_detail(match_grain, details, dealt.DEALT_BY, strategy, dealt.is_whole()).drop(dealt.PART, dealt.PARTS)


def with_folded_type(events: DataFrame) -> DataFrame:
    """Events with their type in lower case, which Parquet can compare with a value where it cannot fold."""
    return events.withColumn(s.TYPE_FOLDED, F.lower("type"))


def earlier_combined(competitions: DataFrame, matches: DataFrame,
                     events: DataFrame | None = None) -> DataFrame:
    """Earlier silver design: all columns but the 360 ones, each name once.

    Without events it is the competition and match table, with them the
    complete event table.
    """
    result = competitions.select(*names_without(competitions.columns, "360"))
    fresh = names_without(matches.columns, "360", taken=result.columns)
    result = attach_detail(result, matches.select(*s.COMPETITION_KEY, *fresh), s.COMPETITION_KEY)
    if events is None:
        return result
    fresh = names_without(events.columns, "360", taken=result.columns)
    details = events.select("match_id", *[f"`{name}`" for name in fresh])
    return attach_detail(result, details, s.MATCH_KEY)
