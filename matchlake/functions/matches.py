"""Match-level labels: winner, stage rank, stage reached, composite keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stage ranks with their case-folded patterns; the first hit wins.
STAGE_RANKS = (
    (0, ("%regular%season%", "%league%")),
    (1, ("%group%",)),
    (2, ("%play-in%", "%qualif%")),
    (3, ("%128%", "%1st%round%", "%2nd%round%")),
    (4, ("%64%", "%32nd%final%", "%3rd%round%", "%4th%round%")),
    (5, ("%32%", "%16th%final%")),
    (6, ("%16%", "%8th%final%")),
    (7, ("%quarter%", "%qtr%")),
    (8, ("%semi%",)),
    (9, ("%3rd%", "%third%")),
    (10, ("%final%",)),
)
UNKNOWN_STAGE = 99
THIRD_PLACE_RANK = 9
FINAL_RANK = 10
DRAW = "Draw"
DRAW_ID = -1


def joined_text(*parts: Column | str) -> Column:
    """Concatenation in which NULL counts as empty text."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.concat_ws("", *columns)


def composite_key(*parts: str) -> Column:
    """``a-b-c`` key of the named columns."""
    pieces: list[Column | str] = []
    for name in parts:
        pieces += ["-", F.col(name)]
    return joined_text(*pieces[1:])


def competition_label() -> Column:
    return joined_text(F.col("competition_name"), " ", F.col("season_name"))


def match_label() -> Column:
    return joined_text(F.col("home_team"), " vs ", F.col("away_team"))


def by_score(drawn: Column, home: Column, away: Column) -> Column:
    """Pick by final score; with a missing score the away side is taken."""
    home_score, away_score = F.col("home_score"), F.col("away_score")
    return (
        F.when(home_score == away_score, drawn)
        .when(home_score > away_score, home)
        .otherwise(away)
    )


def winning_team() -> Column:
    return by_score(F.lit(DRAW), F.col("home_team"), F.col("away_team"))


def winning_team_id() -> Column:
    return by_score(F.lit(DRAW_ID).cast("bigint"), F.col("home_team_id"), F.col("away_team_id"))


def stage_rank(stage: Column) -> Column:
    folded = F.lower(stage)
    ranked = F
    for rank, patterns in STAGE_RANKS:
        hit = folded.like(patterns[0])
        for pattern in patterns[1:]:
            hit = hit | folded.like(pattern)
        ranked = ranked.when(hit, F.lit(rank))
    return ranked.otherwise(F.lit(UNKNOWN_STAGE))


def normalised_stage(stage: Column) -> Column:
    return F.when(stage == "1st Group Stage", F.lit("Group Stage")).otherwise(stage)


def placed(rank: Column, third: Column, first: Column, team: Column,
           values: tuple, fallback: Column) -> Column:
    """Final placing: ``values`` for first to fourth, ``fallback`` for everyone else."""
    final, play_off = rank == FINAL_RANK, rank == THIRD_PLACE_RANK
    return (
        F.when(final & (first == team), F.lit(values[0]))
        .when(final & (first != team), F.lit(values[1]))
        .when(play_off & (third == team), F.lit(values[2]))
        .when(play_off & (third != team), F.lit(values[3]))
        .otherwise(fallback)
    )


# Labels and ranks of the four places (fourth keeps rank 10).
PLACE_LABELS = ("1st Place", "2nd Place", "3rd Place", "4th Place")
PLACE_RANKS = (14, 13, 12, 10)
