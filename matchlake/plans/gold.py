"""Gold marts. Each takes the frames it reads and returns the mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock, passes as px
from ..functions import matches as mx
from ..operators import filters

COMPETITION_COLUMNS = ["competition_id", "season_id", "country_name", "competition_name",
                       "season_name"]


def player_lookup(lineups: DataFrame) -> DataFrame:
    """Shortest nickname per player, then shortest name, then text order.

    Equal names collapse before the shuffle and the pick is a plain minimum, so a
    player with very many rows costs no window over them.
    """
    return merged_players(best_names(lineups))


def best_names(lineups: DataFrame, season: Sequence[str] = ()) -> DataFrame:
    """The first name in order of every player, of all rows or by season: a part that can be merged."""
    names = lineups.select(*season, "player_id", "player_nickname", "player_name").distinct()
    order = F.struct(
        F.length(F.coalesce("player_nickname", F.lit(""))).alias("nickname_length"),
        F.length("player_name").alias("name_length"),
        F.col("player_nickname"),
        F.col("player_name"),
    )
    return names.groupBy(*season, "player_id").agg(F.min(order).alias("best"))


def merged_players(parts: DataFrame) -> DataFrame:
    best = parts.groupBy("player_id").agg(F.min("best").alias("best"))
    return best.select("player_id", F.col("best.player_nickname").alias("player_nickname"))


def both_sides(matches: DataFrame, keep: list[str]) -> DataFrame:
    """Two rows per match, home and away, from one scan."""
    sides = [
        F.struct(
            F.lit(side).alias("side"),
            F.col(f"{side}_team_id").alias("team_id"),
            F.col(f"{side}_team").alias("team"),
        )
        for side in ("home", "away")
    ]
    spread = matches.select(*keep, F.explode(F.array(*sides)).alias("s"))
    return spread.select(*keep, "s.side", "s.team_id", "s.team")


def team_lookup(matches: DataFrame) -> DataFrame:
    keys = ["competition_id", "season_id"]
    return both_sides(matches, keys).select(*keys, "team_id", "team").distinct()


def match_duration_lookup(events: DataFrame, season: Sequence[str] = ()) -> DataFrame:
    """End label and length of each period, total seconds and end of the game, with the season columns if given.

    Maxima of text are grouped by sorting. The half ends are dealt by match first, so that tasks sort what a
    partition of the shuffle holds instead of all half ends of a file split, which are many where files are sorted by type.
    """
    minute, second = F.col("minute"), F.col("second")
    halves = events.filter(filters.is_timed_half_end()).select(
        *season, "match_id", "type", "period", "minute", "second"
    ).repartition("match_id")
    columns: list[Column] = []
    total = F.lit(0)
    for period, prefix, start in clock.PERIODS:
        ended = clock.is_half_end(period)
        seconds = clock.period_seconds(minute, second, start)
        label = F.lit(f"{start:02d}:00")
        columns += [
            (label if period < 3 else F.max(F.when(ended, label))).alias(f"{prefix}_start"),
            F.max(F.when(ended, clock.clock_label(minute, second))).alias(f"{prefix}_end"),
            F.max(F.when(ended, seconds)).alias(f"{prefix}_duration_seconds"),
        ]
        total = total + F.max(F.when(ended, seconds).otherwise(F.lit(0)))
    grouped = halves.groupBy(*season, "match_id").agg(
        *columns, total.alias("total_match_duration_seconds")
    )
    return grouped.withColumn("game_end", F.coalesce("et2_end", "h2_end"))


def combined_player_playtime(lineups: DataFrame, durations: DataFrame,
                             teams: DataFrame) -> DataFrame:
    """Start, end and length of every player's time on the pitch."""
    players = lineups.select(
        "competition_id", "season_id", "match_id", "player_id", "player_nickname",
        F.col("team").alias("lineup_team"), "starting_xi", "sub_on", "sub_off",
        "removed_due_to_red_card", "ended_game",
    )
    teams = teams.withColumn("lineup_team", F.col("team"))
    placed = players.join(durations.select("match_id", "game_end"), "match_id", "left").join(
        teams, ["competition_id", "season_id", "lineup_team"], "left"
    )
    timed = placed.select(
        "competition_id", "season_id", "match_id", "player_id", "player_nickname",
        "team_id", "team", "starting_xi",
        clock.stint_start(clock.label_minute).alias("start_minute"),
        clock.stint_start(clock.label_second).alias("start_second"),
        clock.stint_end(clock.label_minute).alias("end_minute"),
        clock.stint_end(clock.label_second).alias("end_second"),
    )
    return timed.select(
        mx.composite_key("competition_id", "season_id", "team_id").alias("cst_composite_id"),
        *timed.columns,
        clock.seconds_played().alias("duration_played_in_seconds"),
    )


def match_tallies(match_grain: DataFrame) -> DataFrame:
    """Distinct matches per side, team and outcome.

    Works on match or event grain: rows first collapse to one per team, side
    and match, after which distinct counts are plain sums.
    """
    keep = [*COMPETITION_COLUMNS, "match_id", "winning_team_id", "penalty_shootout",
            "competition_stage_ranking"]
    rows = both_sides(match_grain, keep)
    winner, shootout = F.col("winning_team_id"), F.col("penalty_shootout")
    own, drawn = F.col("team_id") == winner, winner == mx.DRAW_ID
    outcomes = {
        "win_non_pens": own & ~drawn & (shootout != 1),
        "win_in_pens": own & ~drawn & (shootout == 1),
        "draw": drawn,
        "lost_non_pens": ~own & ~drawn & (shootout != 1),
        "lost_in_pens": ~own & ~drawn & (shootout == 1),
    }
    counted = F.col("match_id").isNotNull()
    team_keys = [*COMPETITION_COLUMNS, "side", "team_id", "team"]

    def mark(condition: Column) -> Column:
        return F.when(counted & condition, F.lit(1).cast("bigint")).otherwise(F.lit(0))

    once = rows.groupBy(*team_keys, "match_id").agg(
        F.max(mark(F.lit(True))).alias("matches_played"),
        *[F.max(mark(hit)).alias(name) for name, hit in outcomes.items()],
        F.max("competition_stage_ranking").alias("max_competition_stage_ranking"),
    )
    return once.groupBy(*team_keys).agg(
        F.sum("matches_played").alias("matches_played"),
        *[F.sum(name).alias(name) for name in outcomes],
        F.max("max_competition_stage_ranking").alias("max_competition_stage_ranking"),
    )


def team_totals(tallies: DataFrame) -> DataFrame:
    """Home and away tallies added up per team."""
    counts = ["matches_played", "win_non_pens", "win_in_pens", "draw", "lost_non_pens",
              "lost_in_pens"]
    return tallies.groupBy(*COMPETITION_COLUMNS, "team_id", F.col("team").alias("team_name")).agg(
        *[F.sum(name).alias(name) for name in counts],
        F.max("max_competition_stage_ranking").alias("max_competition_stage_ranking"),
    )


def stage_names(match_grain: DataFrame, season: Sequence[str] = ()) -> DataFrame:
    """Distinct stage names and ranks; several names may share a rank."""
    return match_grain.select(
        *season, F.col("fixed_competition_stage").alias("competition_stage"), "competition_stage_ranking"
    ).distinct()


def finals_winners(match_grain: DataFrame) -> DataFrame:
    """Winner of each final and third-place match, in the column of its kind."""
    rank, winner = F.col("competition_stage_ranking"), F.col("winning_team")
    return match_grain.filter(filters.is_final()).select(
        *COMPETITION_COLUMNS,
        "competition_stage_ranking",
        F.when(rank == mx.THIRD_PLACE_RANK, winner).alias("third_place_winner"),
        F.when(rank == mx.FINAL_RANK, winner).alias("first_place_winner"),
    ).distinct()


def combined_results(match_grain: DataFrame, stages: DataFrame | None = None) -> DataFrame:
    """Results per competition, season and team, with the stage reached.

    ``match_grain`` is the competition and match table; the event-grain table
    gives the same rows from a far larger scan. ``stages`` are the stage names of all seasons where the
    match grain holds only some.
    """
    totals = team_totals(match_tallies(match_grain)).alias("f")
    stages = (stage_names(match_grain) if stages is None else stages).alias("cs")
    winners = finals_winners(match_grain).select(
        "competition_id", "season_id", "competition_stage_ranking",
        "third_place_winner", "first_place_winner",
    ).alias("w")
    rank = F.col("f.max_competition_stage_ranking")
    joined = totals.join(
        stages, rank == F.col("cs.competition_stage_ranking"), "left"
    ).join(
        winners,
        (F.col("f.competition_id") == F.col("w.competition_id"))
        & (F.col("f.season_id") == F.col("w.season_id"))
        & (rank == F.col("w.competition_stage_ranking")),
        "left",
    )
    place = (rank, F.col("third_place_winner"), F.col("first_place_winner"), F.col("f.team_name"))
    return joined.select(
        mx.composite_key("f.competition_id", "f.season_id", "f.team_id").alias("cst_composite_id"),
        *[F.col(f"f.{name}") for name in COMPETITION_COLUMNS],
        mx.competition_label().alias("competition"),
        "f.team_id", "f.team_name", "f.matches_played", "f.win_non_pens", "f.win_in_pens",
        "f.draw", "f.lost_non_pens", "f.lost_in_pens",
        mx.placed(*place, mx.PLACE_LABELS, F.col("cs.competition_stage")).alias("stage_reached"),
        mx.placed(*place, mx.PLACE_RANKS, rank).alias("max_competition_stage_ranking"),
        _added("win_non_pens", "win_in_pens").alias("wins"),
        _added("lost_non_pens", "lost_in_pens").alias("losses"),
    )


# Columns of the marts.
MATCH_MART_KEYS = [
    "competition_id", "season_id", "country_name", "competition_name", "season_name",
    "match_id", "match_date", "match_name", "kick_off", "home_score", "away_score",
    "match_week", "home_team", "away_team", "winning_team", "winning_team_id",
    "fixed_competition_stage", "competition_stage_ranking", "penalty_shootout",
    "home_pen_score", "away_pen_score",
]


def combined_matches(match_grain: DataFrame) -> DataFrame:
    """One row per match from the match or event grain."""
    grouped = match_grain.groupBy(*MATCH_MART_KEYS).agg(
        F.min("home_team_id").alias("home_team_id"), F.min("away_team_id").alias("away_team_id")
    )
    return grouped.select(
        mx.composite_key("competition_id", "season_id", "match_id").alias("csm_composite_id"),
        *COMPETITION_COLUMNS,
        mx.competition_label().alias("competition"),
        "match_id", "match_date", "match_name", "kick_off", "home_score", "away_score",
        "match_week", "home_team", "home_team_id", "away_team", "away_team_id",
        "winning_team", "winning_team_id",
        F.col("fixed_competition_stage").alias("competition_stage"),
        "competition_stage_ranking", "penalty_shootout", "home_pen_score", "away_pen_score",
    )


# Flags of a pass, and the result columns joined to it.
PASS_FLAGS = ["pass_switch", "pass_cross", "pass_shot_assist", "pass_inswinging",
              "pass_outswinging", "pass_cut_back", "pass_deflected", "pass_through_ball"]
RESULT_COLUMNS = ["matches_played", "wins", "draw", "losses", "stage_reached"]


def combined_passes(events_grain: DataFrame, results: DataFrame,
                    players: DataFrame) -> DataFrame:
    """Every pass with its match, team result, player names, geometry and flags.

    Three left joins with the passes on the left. Hand in lookup frames with a
    broadcast hint (see ``broadcast_if_small``) to keep the passes unshuffled.
    """
    team_keys = ["competition_id", "season_id", "team_id"]
    passer = players.select("player_id", "player_nickname")
    recipient = players.select(
        F.col("player_id").alias("pass_recipient_id"),
        F.col("player_nickname").alias("pass_recipient_nickname"),
    )
    joined = (
        events_grain.filter(filters.is_pass(events_grain))
        .join(results.select(*team_keys, *RESULT_COLUMNS), team_keys, "left")
        .join(passer, "player_id", "left")
        .join(recipient, "pass_recipient_id", "left")
    )
    start, end = F.col("location"), F.col("pass_end_location")
    placed = joined.withColumns({
        "pass_start_x": px.coordinate(start, 0),
        "pass_start_y": px.coordinate(start, 1),
        "pass_end_x": px.coordinate(end, 0),
        "pass_end_y": px.coordinate(end, 1),
    })
    end_x = F.col("pass_end_x")
    flags = {name: px.flag(F.col(name)).alias(name) for name in PASS_FLAGS}
    return placed.select(
        mx.composite_key("competition_id", "season_id", "team_id").alias("cst_composite_id"),
        mx.composite_key("competition_id", "season_id", "match_id").alias("csm_composite_id"),
        *COMPETITION_COLUMNS,
        mx.competition_label().alias("competition"),
        "match_id", "match_date", "match_name", "kick_off", "home_score", "away_score",
        "penalty_shootout", "home_pen_score", "away_pen_score", "match_week",
        "home_team", "away_team", "winning_team_id", "winning_team",
        "competition_stage", "competition_stage_ranking",
        "id", "period", px.half_label(F.col("period")).alias("which_half"),
        "timestamp", "minute", "second", "type", "possession", "possession_team",
        "play_pattern", "team", "team_id", *RESULT_COLUMNS,
        px.equal_flag(F.col("team_id"), F.col("winning_team_id")).alias("part_of_winning_team"),
        "player", "player_id", "player_nickname", "position", "location", "duration",
        *[px.flag(F.col(name)).alias(name)
          for name in ("under_pressure", "off_camera", "out", "counterpress")],
        "pass_recipient", "pass_recipient_id", "pass_recipient_nickname",
        "pass_length", "pass_angle", px.direction(F.col("pass_angle")).alias("pass_direction"),
        "pass_height", "pass_end_location",
        "pass_start_x", "pass_start_y", "pass_end_x", "pass_end_y",
        px.third_name(end_x).alias("pass_end_sector"),
        px.third_rank(end_x).alias("pass_end_sector_rank"),
        "pass_body_part", "pass_type",
        px.outcome_or_success(F.col("pass_outcome")).alias("pass_outcome"),
        "pass_technique", flags["pass_switch"], flags["pass_cross"], "pass_assisted_shot_id",
        *[flags[name] for name in PASS_FLAGS[2:]],
    )


def _added(*names: str) -> Column:
    total = F.lit(0)
    for name in names:
        total = total + F.coalesce(F.col(f"f.{name}"), F.lit(0))
    return total
