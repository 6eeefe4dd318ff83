"""Joins, aggregations, windows, set operations, expressions and the layer tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake import schemas as s
from matchlake.functions import clock, lineups as lx
from matchlake.functions import matches as mx
from matchlake.functions import passes as px
from matchlake.operators import filters, history, joins
from matchlake.operators import lineups as lu
from matchlake.plans import bronze, gold, silver
from matchlake.plans.pipeline import run_pipeline
from matchlake.session import together
from matchlake.sources.tables import rebuild

from .bridge import FIRST_LOAD, SECOND_LOAD, Bridge
from .oracle import quoted
from .registry import check

_COMP5 = ", ".join(gold.COMPETITION_COLUMNS)

# --- joins ---------------------------------------------------------------------------



def combine(b: Bridge, events: DataFrame | None = None) -> DataFrame:
    return silver.combined(b.match_grain, b.line_events if events is None else events, joins.sized_strategy(b.match_grain))


check("J1_competitions_to_matches", lambda b: silver.competition_matches(
    b.competitions, b.silver_matches), "SELECT * FROM match_grain")
check("J2_to_events", lambda b: combine(b).select(
    "competition_id", "season_id", "match_id", "match_name", "id", "type", "team"),
    "SELECT competition_id, season_id, match_id, match_name, id, type, team FROM combined")
check("J3_lineups_to_cards", lambda b: joins.lookup(
    b.lineups.select("match_id", "player_id", "team"), lu.card_summary(b.lineups), s.LINEUP_KEY),
    """SELECT match_id, player_id, team, first_yellow_time, first_yellow_reason, first_yellow_period,
        second_yellow_time, second_yellow_reason, second_yellow_period, red_card_time,
        red_card_reason, red_card_period
        FROM b_players LEFT JOIN card_sums USING (match_id, player_id)""")
check("J4_lineups_to_stints", lambda b: joins.lookup(
    b.lineups.select("match_id", "player_id", "team"), lu.stint_summary(b.lineups), s.LINEUP_KEY),
    """SELECT match_id, player_id, team, starting_xi, sub_off, sub_on, removed_due_to_red_card, ended_game
        FROM b_players LEFT JOIN stint_sums USING (match_id, player_id)""")
check("J5_lineups_to_duration", lambda b: joins.lookup(
    b.lineups.select("match_id", "player_id"), joins.broadcast_if_small(b.durations.select("match_id", "game_end")),
    s.MATCH_KEY),
    """SELECT p.match_id, player_id, game_end FROM b_players p
        LEFT JOIN durations d ON p.match_id = d.match_id""")
check("J6_lineups_to_teams", lambda b: joins.lookup(
    b.lineups.select("competition_id", "season_id", "team", "match_id", "player_id"), b.teams,
    ["competition_id", "season_id", "team"]),
    """SELECT p.competition_id, p.season_id, p.team, match_id, player_id, team_id FROM b_players p
        LEFT JOIN team_lookup t ON p.competition_id = t.competition_id
        AND p.season_id = t.season_id AND p.team = t.team""")
check("J7_passes_to_results", lambda b: joins.lookup(
    b.combined.filter("lower(type) = 'pass'").select("id", "competition_id", "season_id", "team_id"),
    b.results.select("competition_id", "season_id", "team_id", "wins", "stage_reached"),
    ["competition_id", "season_id", "team_id"]),
    """SELECT id, p.competition_id, p.season_id, p.team_id, wins, stage_reached FROM pass_rows p
        LEFT JOIN results r ON p.competition_id = r.competition_id AND p.season_id = r.season_id
        AND p.team_id = r.team_id""")


def named_players(b: Bridge) -> DataFrame:
    passes = b.events.filter("lower(type) = 'pass'").select("id", "player_id", "pass_recipient_id")
    recipient = b.players.toDF("pass_recipient_id", "recipient_nickname")
    return joins.lookup(joins.lookup(passes, b.players, ["player_id"]), recipient,
                        ["pass_recipient_id"])


check("J8_passes_to_players", named_players,
      """SELECT id, p.player_id, pass_recipient_id, a1.player_nickname,
        a2.player_nickname AS recipient_nickname FROM b_events p
        LEFT JOIN player_lookup a1 ON p.player_id = a1.player_id
        LEFT JOIN player_lookup a2 ON p.pass_recipient_id = a2.player_id
        WHERE lower(type) = 'pass'""")
check("J9_results_to_stages", lambda b: joins.lookup(
    gold.team_totals(gold.match_tallies(b.match_grain)).select(
        "competition_id", "season_id", "team_id",
        F.col("max_competition_stage_ranking").alias("competition_stage_ranking")),
    gold.stage_names(b.match_grain), ["competition_stage_ranking"]),
    """SELECT competition_id, season_id, team_id, competition_stage,
        max_competition_stage_ranking AS competition_stage_ranking FROM totals
        LEFT JOIN stage_names ON max_competition_stage_ranking = competition_stage_ranking""")
check("J9_results_to_first_stage", lambda b: joins.lookup(
    gold.team_totals(gold.match_tallies(b.match_grain)).select(
        "competition_id", "season_id", "team_id",
        F.col("max_competition_stage_ranking").alias("competition_stage_ranking")),
    gold.stage_names(b.match_grain), ["competition_stage_ranking"], "first"),
    """SELECT competition_id, season_id, team_id, competition_stage,
        max_competition_stage_ranking AS competition_stage_ranking FROM totals
        LEFT JOIN (SELECT competition_stage_ranking, min(competition_stage) AS competition_stage FROM stage_names GROUP BY 1)
        ON max_competition_stage_ranking = competition_stage_ranking""")
check("J8_passes_to_one_player_each", lambda b: joins.lookup(
    b.events.filter(filters.is_pass()).select("id", "player_id"), b.players, ["player_id"], "raise"),
    """SELECT id, p.player_id, player_nickname FROM b_events p LEFT JOIN player_lookup a ON p.player_id = a.player_id
        WHERE lower(type) = 'pass'""")
check("J10_results_to_winners", lambda b: joins.lookup(
    gold.team_totals(gold.match_tallies(b.match_grain)).select(
        "competition_id", "season_id", "team_id",
        F.col("max_competition_stage_ranking").alias("competition_stage_ranking")),
    gold.finals_winners(b.match_grain).drop("country_name", "competition_name", "season_name"),
    ["competition_id", "season_id", "competition_stage_ranking"]),
    """SELECT t.competition_id, t.season_id, team_id, third_place_winner, first_place_winner,
        max_competition_stage_ranking AS competition_stage_ranking FROM totals t
        LEFT JOIN finals w ON t.competition_id = w.competition_id AND t.season_id = w.season_id
        AND max_competition_stage_ranking = competition_stage_ranking""")
check("J11_shootout_patch", lambda b: silver.patch_shootouts(silver_base(b), b.events).select(
    "match_id", "winning_team", "winning_team_id", "penalty_shootout", "home_pen_score",
    "away_pen_score"),
    """SELECT match_id, winning_team, winning_team_id, penalty_shootout, home_pen_score,
        away_pen_score FROM silver_matches""")
check("J12_changed_keys_only", lambda b: history.changed_only(
    b.matches, b.competitions.filter("match_updated >= '1998-01-01'"), s.COMPETITION_KEY),
    """SELECT * FROM b_matches WHERE (competition_id, season_id) IN
        (SELECT (competition_id, season_id) FROM b_competitions
         WHERE match_updated >= TIMESTAMP '1998-01-01 00:00:00')""")

# --- aggregations, window, sets --------------------------------------------------------

check("A1_card_maxima", lambda b: lu.card_summary(b.lineups), "SELECT * FROM card_sums")
check("A2_stint_maxima", lambda b: lu.stint_summary(b.lineups), "SELECT * FROM stint_sums")
check("A3_conditional_maxima", lambda b: gold.match_duration_lookup(b.events).drop(
    "total_match_duration_seconds", "game_end"),
    "SELECT * EXCLUDE (total_match_duration_seconds, game_end) FROM durations")
check("A4_total_seconds", lambda b: gold.match_duration_lookup(b.events).select("match_id", "total_match_duration_seconds"),
      "SELECT match_id, total_match_duration_seconds FROM durations")
_TALLY = f"{_COMP5}, side, team_id, team"
check("A5_matches_per_team", lambda b: gold.match_tallies(b.match_grain).select(
    *_TALLY.split(", "), "matches_played"), f"SELECT {_TALLY}, matches_played FROM tallies")
check("A6_outcomes_per_team", lambda b: gold.match_tallies(b.match_grain).select(
    *_TALLY.split(", "), "win_non_pens", "win_in_pens", "draw", "lost_non_pens", "lost_in_pens"),
    f"SELECT {_TALLY}, win_non_pens, win_in_pens, draw, lost_non_pens, lost_in_pens FROM tallies")
check("A7_highest_stage", lambda b: gold.match_tallies(b.match_grain).select(
    *_TALLY.split(", "), "max_competition_stage_ranking"),
    f"SELECT {_TALLY}, max_competition_stage_ranking FROM tallies")
check("A8_home_and_away_sums", lambda b: gold.team_totals(gold.match_tallies(b.match_grain)),
      "SELECT * FROM totals")
check("A9_matches_from_events", lambda b: gold.combined_matches(b.line_combined), "SELECT * FROM match_mart")
check("A10_stage_names", lambda b: gold.stage_names(b.match_grain), "SELECT * FROM stage_names")
check("A11_finals_winners", lambda b: gold.finals_winners(b.match_grain), "SELECT * FROM finals")


def shootout_counts(b: Bridge) -> DataFrame:
    drawn = silver.snapshot(b.bronze_matches, silver.match_columns())
    return silver.shootout_results(drawn, b.events).select("match_id", "home_goals", "away_goals")


def shootout_winners(b: Bridge) -> DataFrame:
    drawn = silver.snapshot(b.bronze_matches, silver.match_columns())
    return silver.shootout_results(drawn, b.events).select(
        "match_id", "shootout_winner", "shootout_winner_id")


check("A12_shootout_counts", shootout_counts, "SELECT match_id, home_goals, away_goals FROM so_results")
check("A13_max_update_time", lambda b: b.loaded.agg(F.max("last_updated").alias("watermark")),
      "SELECT max(last_updated) AS watermark FROM loaded")
check("A14_duplicate_keys", lambda b: history.duplicate_keys(b.loaded, ["match_id"]),
      "SELECT match_id, count(*) AS versions FROM loaded GROUP BY match_id HAVING count(*) > 1")
check("A15_shootout_winner_id", shootout_winners,
      "SELECT match_id, shootout_winner, shootout_winner_id FROM so_results")
check("W1_shortest_nickname", lambda b: gold.player_lookup(b.bronze_lineups), "SELECT * FROM player_lookup")
check("U1_distinct_teams", lambda b: gold.team_lookup(b.silver_matches), "SELECT * FROM team_lookup")
check("U2_home_and_away_rows", lambda b: gold.both_sides(
    b.silver_matches, ["competition_id", "season_id", "match_id"]),
    """SELECT competition_id, season_id, match_id, 'home' AS side, home_team_id AS team_id,
        home_team AS team FROM silver_matches
        UNION ALL SELECT competition_id, season_id, match_id, 'away', away_team_id, away_team
        FROM silver_matches""")


def team_frames(b: Bridge) -> DataFrame:
    players = b.lineups.select("match_id", "player_id", "team")
    home = F.col("player_id") % 2 == 0
    return players.filter(home).unionByName(players.filter(~home))


check("U3_concatenated_teams", team_frames, "SELECT match_id, player_id, team FROM b_players")
check("U4_limit", lambda b: b.matches.orderBy("match_id").limit(100).select("match_id", "home_team"),
      "SELECT match_id, home_team FROM b_matches ORDER BY match_id LIMIT 100")
_ORDER = "cst_composite_id, team_name, stage_reached"
check("U5_head_20", lambda b: b.results.orderBy(*_order(F.asc_nulls_first)).limit(20),
      "SELECT * FROM results ORDER BY " + ", ".join(f"{n} NULLS FIRST" for n in _ORDER.split(", "))
      + " LIMIT 20")
check("U5_tail_50", lambda b: b.results.orderBy(*_order(F.desc_nulls_last)).limit(50),
      "SELECT * FROM results ORDER BY " + ", ".join(f"{n} DESC NULLS LAST" for n in _ORDER.split(", "))
      + " LIMIT 50")


def _order(direction) -> list:
    return [direction(name) for name in _ORDER.split(", ")]


# --- expressions -------------------------------------------------------------------------


def silver_base(b: Bridge) -> DataFrame:
    return silver.snapshot(b.bronze_matches, silver.match_columns())


def match_expression(*names: str):
    return lambda b: silver_base(b).select("match_id", *names)


check("E1_nickname_fallback", lambda b: b.lineups.select(
    "match_id", "player_id", lx.nickname().alias("player_nickname")),
    """SELECT match_id, player_id, coalesce(player_nickname, player_name) AS player_nickname
        FROM b_players""")
check("E2_explode_cards", lambda b: lu.exploded(b.lineups, "cards", "card").select(
    "match_id", "player_id", "card.card_type", "card.time"),
    """SELECT match_id, player_id, card_type, "time" FROM b_players
        LEFT JOIN b_cards USING (match_id, player_id)""")
check("E3_card_fields", lambda b: lu.card_rows(b.lineups).select(
    "match_id", "player_id", "first_yellow_time", "second_yellow_reason", "red_card_period"),
    """SELECT match_id, player_id, CASE WHEN card_type = 'Yellow Card' THEN "time" END AS first_yellow_time,
        CASE WHEN card_type = 'Second Yellow' THEN reason END AS second_yellow_reason,
        CASE WHEN card_type = 'Red Card' THEN period END AS red_card_period
        FROM b_players LEFT JOIN b_cards USING (match_id, player_id)""")
check("E4_position_fields", lambda b: lu.stint_rows(b.lineups),
      """SELECT match_id, player_id, position_id, "position", "from", "to", from_period, to_period,
        start_reason, end_reason FROM b_stints""")
check("E5_stint_flags", lambda b: lu.stint_flags(lu.stint_rows(b.lineups)),
      """SELECT match_id, player_id, CAST(starting_xi AS BIGINT) AS starting_xi, sub_off, sub_on,
        removed_due_to_red_card, CAST(ended_game AS BIGINT) AS ended_game FROM stint_marks
        WHERE coalesce(CAST(starting_xi AS VARCHAR), sub_off, sub_on, removed_due_to_red_card,
            CAST(ended_game AS VARCHAR)) IS NOT NULL""")
check("E6_red_card_not_finished", lambda b: lu.stint_summary(b.lineups).select(
    "match_id", "player_id", "removed_due_to_red_card", "ended_game"),
    "SELECT match_id, player_id, removed_due_to_red_card, ended_game FROM stint_sums")
check("E7_flags_default_zero", lambda b: lu.flatten_lineups(b.lineups).select(
    "match_id", "player_id", "starting_xi", "ended_game"),
    "SELECT match_id, player_id, starting_xi, ended_game FROM b_lineups")
check("E8_match_label", match_expression("match_name"), "SELECT match_id, match_name FROM s_matches")
check("E9_winner", match_expression("winning_team", "winning_team_id"),
      "SELECT match_id, winning_team, winning_team_id FROM s_matches")
check("E10_stage_rank", match_expression("competition_stage", "competition_stage_ranking"),
      "SELECT match_id, competition_stage, competition_stage_ranking FROM s_matches")
check("E11_stage_name", match_expression("fixed_competition_stage"),
      "SELECT match_id, fixed_competition_stage FROM s_matches")
check("E12_shootout_defaults", match_expression("penalty_shootout", "home_pen_score", "away_pen_score"),
      "SELECT match_id, penalty_shootout, home_pen_score, away_pen_score FROM s_matches")
check("E13_shootout_winner", shootout_winners,
      "SELECT match_id, shootout_winner, shootout_winner_id FROM so_results")
check("E15_clock_label", lambda b: b.events.select(
    "id", clock.clock_label(F.col("minute"), F.col("second")).alias("label")),
    """SELECT id, CASE WHEN minute >= 100 THEN CAST(minute AS VARCHAR)
            ELSE lpad(CAST(coalesce(minute, 0) AS VARCHAR), 2, '0') END
        || ':' || lpad(CAST(coalesce(second, 0) AS VARCHAR), 2, '0') AS label FROM b_events""")
check("E16_period_seconds", lambda b: gold.match_duration_lookup(b.events).select(
    "match_id", *[f"{p}_duration_seconds" for _, p, _ in clock.PERIODS]),
    """SELECT match_id, h1_duration_seconds, h2_duration_seconds, et1_duration_seconds,
        et2_duration_seconds FROM durations""")
check("E17_period_starts", lambda b: gold.match_duration_lookup(b.events).select(
    "match_id", *[f"{p}_start" for _, p, _ in clock.PERIODS]),
    "SELECT match_id, h1_start, h2_start, et1_start, et2_start FROM durations")
check("E18_game_end", lambda b: gold.match_duration_lookup(b.events).select("match_id", "game_end"),
      "SELECT match_id, game_end FROM durations")


def playtime(b: Bridge) -> DataFrame:
    small = joins.broadcast_if_small
    return gold.combined_player_playtime(b.bronze_lineups, small(b.durations.select("match_id", "game_end")), small(b.teams))


check("E19_start_and_end_clock", lambda b: playtime(b).select(
    "match_id", "player_id", "start_minute", "start_second", "end_minute", "end_second"),
    "SELECT match_id, player_id, start_minute, start_second, end_minute, end_second FROM playtime")
check("E20_seconds_played", lambda b: playtime(b).select(
    "match_id", "player_id", "duration_played_in_seconds"),
    "SELECT match_id, player_id, duration_played_in_seconds FROM playtime")
check("E21_composite_keys", lambda b: b.match_grain.select(
    mx.composite_key("competition_id", "season_id", "home_team_id").alias("team_key"),
    mx.composite_key("competition_id", "season_id", "match_id").alias("match_key"),
    mx.competition_label().alias("competition")),
    """SELECT CAST(competition_id AS VARCHAR) || '-' || CAST(season_id AS VARCHAR) || '-'
            || coalesce(CAST(home_team_id AS VARCHAR), '') AS team_key,
        CAST(competition_id AS VARCHAR) || '-' || CAST(season_id AS VARCHAR) || '-'
            || coalesce(CAST(match_id AS VARCHAR), '') AS match_key,
        competition_name || ' ' || season_name AS competition FROM match_grain""")


def late(build):
    """Column expressions need a session, so they are built when the query runs."""
    return lambda b: b.events.select("id", *build())


check("E22_half_label", late(lambda: [px.half_label(F.col("period")).alias("which_half")]),
      "SELECT id, CASE WHEN period = 1 THEN '1st Half' ELSE '2nd Half' END AS which_half FROM b_events")
check("E23_outcome_or_success", late(lambda: [
    px.outcome_or_success(F.col("pass_outcome")).alias("pass_outcome")]),
    "SELECT id, coalesce(pass_outcome, 'Success') AS pass_outcome FROM b_events")
check("E24_direction", late(lambda: [px.direction(F.col("pass_angle")).alias("pass_direction")]),
      """SELECT id, CASE WHEN cos(pass_angle) > 0 THEN 'Forward' WHEN cos(pass_angle) < 0
        THEN 'Backward' ELSE 'Lateral' END AS pass_direction FROM b_events""")
check("E25_coordinates", late(lambda: [
    px.coordinate(F.col(col), axis).alias(name) for name, col, axis in (
        ("pass_start_x", "location", 0), ("pass_start_y", "location", 1),
        ("pass_end_x", "pass_end_location", 0), ("pass_end_y", "pass_end_location", 1))]),
    "SELECT id, pass_start_x, pass_start_y, pass_end_x, pass_end_y FROM geometry")
check("E26_third_name", late(lambda: [
    px.third_name(px.coordinate(F.col("pass_end_location"), 0)).alias("pass_end_sector")]),
    """SELECT id, CASE WHEN pass_end_x >= 80 THEN 'Final 3rd' WHEN pass_end_x >= 40 THEN 'Middle 3rd'
        WHEN pass_end_x >= 0 THEN 'Defensive 3rd' ELSE CAST(pass_end_x AS VARCHAR) END
        AS pass_end_sector FROM geometry""")
check("E27_third_rank", late(lambda: [
    px.third_rank(px.coordinate(F.col("pass_end_location"), 0)).alias("pass_end_sector_rank")]),
    """SELECT id, CASE WHEN pass_end_x >= 80 THEN 1 WHEN pass_end_x >= 40 THEN 2
        WHEN pass_end_x >= 0 THEN 3 ELSE pass_end_x END AS pass_end_sector_rank FROM geometry""")
_FLAGS = ["under_pressure", "off_camera", "out", "counterpress", *gold.PASS_FLAGS]
check("E28_flags", late(lambda: [px.flag(F.col(name)).alias(name) for name in _FLAGS]),
      "SELECT id, " + ", ".join(
          f'CAST(coalesce("{n}", FALSE) AS INTEGER) AS "{n}"' for n in _FLAGS) + " FROM b_events")


def passes(b: Bridge) -> DataFrame:
    """Stored lookups are measured, then broadcast if they fit."""
    small = joins.broadcast_if_small
    return gold.combined_passes(b.line_combined, small(b.results), small(b.players))


check("E29_part_of_winning_team", lambda b: joins.lookup(
    b.events.select("id", "match_id", "team_id"),
    joins.broadcast_if_small(b.silver_matches.select("match_id", "winning_team_id")), s.MATCH_KEY).select(
        "id", px.equal_flag(F.col("team_id"), F.col("winning_team_id")).alias("part_of_winning_team")),
    """SELECT id, CASE WHEN e.team_id = m.winning_team_id THEN 1 ELSE 0 END AS part_of_winning_team
        FROM b_events e LEFT JOIN silver_matches m ON e.match_id = m.match_id""")
check("E30_stage_reached", lambda b: gold.combined_results(b.match_grain).select("cst_composite_id", "team_name", "stage_reached"),
      "SELECT cst_composite_id, team_name, stage_reached FROM results")
check("E31_final_rank", lambda b: gold.combined_results(b.match_grain).select(
    "cst_composite_id", "team_name", "max_competition_stage_ranking"),
    "SELECT cst_composite_id, team_name, max_competition_stage_ranking FROM results")
check("E32_wins_and_losses", lambda b: gold.combined_results(b.match_grain).select("cst_composite_id", "team_name", "wins", "losses"),
      "SELECT cst_composite_id, team_name, wins, losses FROM results")
check("E33_scalar_functions", lambda b: b.events.select(
    "id",
    F.lower("type").alias("folded"), F.length("player").alias("name_length"),
    F.substring_index("timestamp", ":", 1).try_cast("int").alias("hour"),
    F.instr("timestamp", ":").alias("colon_at"),
    (F.cos("pass_angle") > 0).alias("is_forward"),
    F.lower("type").like("%pass%").alias("has_pass"),
    mx.joined_text(F.col("team"), " / ", F.col("pass_recipient")).alias("pair")),
    """SELECT id, lower(type) AS folded, CAST(length(player) AS INTEGER) AS name_length,
        TRY_CAST(split_part("timestamp", ':', 1) AS INTEGER) AS hour,
        CAST(instr("timestamp", ':') AS INTEGER) AS colon_at, cos(pass_angle) > 0 AS is_forward,
        lower(type) LIKE '%pass%' AS has_pass,
        coalesce(team, '') || ' / ' || coalesce(pass_recipient, '') AS pair FROM b_events""")

# --- layer tables ----------------------------------------------------------------------------

_FROM_LOAD = """TIMESTAMP '2024-03-01 00:00:00' AS data_valid_from_utc,
    CAST(NULL AS TIMESTAMP) AS data_valid_to_utc"""
_OPEN = """TIMESTAMP '2024-02-01 00:00:00' AS data_valid_from_utc,
    CAST(NULL AS TIMESTAMP) AS data_valid_to_utc"""


def bronze_competitions(b: Bridge) -> DataFrame:
    """Second load over a history whose update times lie a day back."""
    held = b.bronze_competitions.withColumn("match_updated", F.expr("match_updated - INTERVAL '1' DAY"))
    new = bronze.pick_competitions(b.competitions, held)
    return history.upsert_versions(held, new, s.COMPETITION_KEY, SECOND_LOAD, "match_updated")


def bronze_matches(b: Bridge) -> DataFrame:
    held = b.bronze_matches.withColumn("last_updated", F.expr("last_updated - INTERVAL '50' DAY"))
    new = bronze.pick_matches(b.matches, held, b.competitions.filter("competition_id <> 3"))
    return history.upsert_versions(held, new, s.MATCH_KEY, SECOND_LOAD, "last_updated")


def bronze_events(b: Bridge) -> DataFrame:
    """Events of the matches of 1998 and later, over a history that lacks 1998."""
    changed = b.matches.filter("season_id >= 1998")
    lacking = b.matches.filter("season_id = 1998").select(*s.MATCH_KEY)
    held = joins.with_ids(b.line_events, F.col("match_id"), lacking, present=False)
    new = bronze.pick_events(b.line_events, changed).drop(s.VALID_FROM, s.VALID_TO)
    return history.upsert_versions(b.open_versions(held), new, s.EVENT_KEY, SECOND_LOAD)


def bronze_lineups(b: Bridge) -> DataFrame:
    changed = b.matches.filter("season_id >= 1998")
    new = bronze.pick_lineups(b.lineups, changed).drop(s.VALID_FROM, s.VALID_TO)
    return history.upsert_versions(b.bronze_lineups, new, s.LINEUP_KEY, SECOND_LOAD)


_LINEUP_COLS = quoted([n for n in s.LINEUPS.names if n not in (s.VALID_FROM, s.VALID_TO)])
_EVENT_COLS = quoted(s.EVENTS_SOURCE.names)
_FIXED_EVENTS = """* REPLACE (replace(player, 'N''''', 'N''') AS player,
    replace(pass_recipient, 'N''''', 'N''') AS pass_recipient,
    CASE WHEN location NOT IN ('', 'null') THEN location END AS location)"""
_CLOSED_AT = "TIMESTAMP '2024-02-29 23:59:59.999'"

check("T1_competitions_in_memory", bronze_competitions,
      f"""WITH held AS (SELECT * REPLACE (match_updated - INTERVAL '1' DAY AS match_updated) FROM b_competitions),
        fresh AS (SELECT * FROM b_competitions WHERE match_updated > (SELECT max(match_updated) FROM held))
        SELECT *, {_FROM_LOAD} FROM fresh
        UNION ALL SELECT *, TIMESTAMP '2024-02-01 00:00:00',
            CASE WHEN (competition_id, season_id) IN (SELECT (competition_id, season_id) FROM fresh)
            THEN {_CLOSED_AT} END FROM held""")
check("T2_matches_in_memory", bronze_matches,
      f"""WITH fresh AS (SELECT m.* FROM b_matches m JOIN (
            SELECT competition_id, season_id, max(last_updated) - INTERVAL '50' DAY AS mark
            FROM b_matches GROUP BY ALL) w
            ON m.competition_id = w.competition_id AND m.season_id = w.season_id
            AND m.last_updated > w.mark WHERE m.competition_id <> 3),
        held AS (SELECT * REPLACE (last_updated - INTERVAL '50' DAY AS last_updated) FROM b_matches)
        SELECT *, {_FROM_LOAD} FROM fresh
        UNION ALL SELECT *, TIMESTAMP '2024-02-01 00:00:00',
            CASE WHEN match_id IN (SELECT match_id FROM fresh) THEN {_CLOSED_AT} END FROM held
        UNION ALL SELECT * REPLACE (home_score + 1 AS home_score), TIMESTAMP '2024-01-01 00:00:00',
            TIMESTAMP '2024-01-31 23:59:59.999' FROM held WHERE match_id % 7 = 0""")
check("T3_events_in_memory", bronze_events,
      f"""WITH season AS (SELECT match_id, season_id FROM b_matches),
        fresh AS (SELECT {_FIXED_EVENTS} FROM b_events
            WHERE match_id IN (SELECT match_id FROM season WHERE season_id >= 1998)),
        held AS (SELECT * FROM b_events
            WHERE match_id NOT IN (SELECT match_id FROM season WHERE season_id = 1998))
        SELECT {_EVENT_COLS}, {_FROM_LOAD} FROM fresh
        UNION ALL SELECT {_EVENT_COLS}, TIMESTAMP '2024-02-01 00:00:00',
            CASE WHEN match_id IN (SELECT match_id FROM season WHERE season_id >= 1998)
            THEN {_CLOSED_AT} END FROM held""")
check("T4_lineups_in_memory", bronze_lineups,
      f"""SELECT {_LINEUP_COLS}, {_FROM_LOAD} FROM b_lineups WHERE season_id >= 1998
        UNION ALL SELECT {_LINEUP_COLS}, TIMESTAMP '2024-02-01 00:00:00',
            CASE WHEN season_id >= 1998 THEN {_CLOSED_AT} END FROM b_lineups""")
check("T5_silver_matches", silver_base, f"SELECT *, {_OPEN} FROM s_matches")
check("T6_silver_matches_shootouts", lambda b: silver.silver_matches(
    b.bronze_matches, b.bronze_events),
      f"SELECT *, {_OPEN} FROM silver_matches")
check("T7_silver_competitions", lambda b: silver.snapshot(bronze_competitions(b)),
      f"""WITH held AS (SELECT * REPLACE (match_updated - INTERVAL '1' DAY AS match_updated) FROM b_competitions),
        fresh AS (SELECT * FROM b_competitions WHERE match_updated > (SELECT max(match_updated) FROM held))
        SELECT *, {_FROM_LOAD} FROM fresh
        UNION ALL SELECT *, TIMESTAMP '2024-02-01 00:00:00', NULL FROM held
        WHERE (competition_id, season_id) NOT IN (SELECT (competition_id, season_id) FROM fresh)""")
check("T7_silver_events", lambda b: silver.snapshot(bronze_events(b)),
      f"""WITH season AS (SELECT match_id, season_id FROM b_matches)
        SELECT {_EVENT_COLS}, {_FROM_LOAD} FROM (SELECT {_FIXED_EVENTS} FROM b_events
            WHERE match_id IN (SELECT match_id FROM season WHERE season_id >= 1998))
        UNION ALL SELECT {_EVENT_COLS}, TIMESTAMP '2024-02-01 00:00:00', NULL FROM b_events
            WHERE match_id IN (SELECT match_id FROM season WHERE season_id < 1998)""")
check("T7_silver_lineups", lambda b: silver.snapshot(bronze_lineups(b)),
      f"""SELECT {_LINEUP_COLS}, CASE WHEN season_id >= 1998 THEN TIMESTAMP '2024-03-01 00:00:00'
            ELSE TIMESTAMP '2024-02-01 00:00:00' END AS data_valid_from_utc,
        CAST(NULL AS TIMESTAMP) AS data_valid_to_utc FROM b_lineups""")
check("T8_silver_combined", combine, "SELECT * FROM combined")
check("T9_player_lookup", lambda b: gold.player_lookup(b.bronze_lineups), "SELECT * FROM player_lookup")
check("T10_team_lookup", lambda b: gold.team_lookup(b.silver_matches), "SELECT * FROM team_lookup")
check("T11_match_duration_lookup", lambda b: gold.match_duration_lookup(b.events_by_type), "SELECT * FROM durations")
check("T12_combined_player_playtime", playtime, "SELECT * FROM playtime")
check("T13_combined_results", lambda b: gold.combined_results(b.match_grain), "SELECT * FROM results")
check("T14_combined_matches", lambda b: gold.combined_matches(b.match_grain), "SELECT * FROM match_mart")
check("T15_combined_passes", passes, "SELECT * FROM passes")
_EARLIER_MATCH = [n for n in s.MATCHES_SOURCE.names if "360" not in n
                  and n not in s.COMPETITIONS_SOURCE.names]
_EARLIER_COMP = [n for n in s.COMPETITIONS_SOURCE.names if "360" not in n]
_EARLIER_EVENT = [n for n in s.EVENTS_SOURCE.names if n != "match_id"]
check("T16_earlier_comp_matches", lambda b: silver.earlier_combined(b.competitions, b.matches),
      f"""SELECT {quoted(_EARLIER_COMP, 'c.')}, {quoted(_EARLIER_MATCH, 'm.')} FROM b_competitions c
        LEFT JOIN b_matches m ON c.competition_id = m.competition_id AND c.season_id = m.season_id""")
check("T16_earlier_complete", lambda b: silver.earlier_combined(b.competitions, b.matches, b.line_events),
      f"""SELECT {quoted(_EARLIER_COMP, 'c.')}, {quoted(_EARLIER_MATCH, 'm.')},
            {quoted(_EARLIER_EVENT, 'e.')} FROM b_competitions c
        LEFT JOIN b_matches m ON c.competition_id = m.competition_id AND c.season_id = m.season_id
        LEFT JOIN b_events e ON m.match_id = e.match_id""")


def whole_run(b: Bridge) -> DataFrame:
    """All layers of all competitions into fresh schemas; the passes mart is read back."""
    layers = tuple(b.scratch_schema() for _ in range(3))
    sources = bronze.Sources(b.competitions, b.matches, b.events, b.lineups)
    run_pipeline(b.spark, sources, FIRST_LOAD, [0, 1, 2, 3, 4, 99], min_season="1900",
                 layers=layers)
    return b.spark.table(f"{layers[2]}.combined_passes")


MARTS = {"player_lookup": "player_lookup", "team_lookup": "team_lookup", "match_duration_lookup": "durations",
         "combined_player_playtime": "playtime", "combined_results": "results", "combined_matches": "match_mart",
         "combined_passes": "passes"}


_LAYERS: dict[tuple[str, str], tuple[str, str, str]] = {}


def two_runs(b: Bridge) -> tuple[str, str, str]:
    """Layers after a first run with earlier scores of two competitions and a second one that delivers all sources again, those two
    competitions changed and a third of the events sent twice. Run once per session."""
    key = (b.spark.sparkContext.applicationId, b.sf_dir)
    if key in _LAYERS:
        return _LAYERS[key]
    layers = tuple(b.scratch_schema() for _ in range(3))
    together(b.spark, lambda: b.events, lambda: (b.competitions, b.lineups))
    before = lambda name: F.expr(f"if(competition_id < 2, {name} - INTERVAL '20000' DAY, {name})")
    first = bronze.Sources(
        b.competitions.withColumn("match_updated", before("match_updated")),
        b.matches.withColumn("last_updated", before("last_updated")).withColumn(
            "home_score", F.expr("if(competition_id < 2, home_score + 1, home_score)")),
        b.events, b.lineups)
    doubled = b.events.unionByName(b.events.filter("match_id % 3 = 0"))
    second = bronze.Sources(b.competitions, b.matches, doubled, b.lineups)
    for sources, now in ((first, FIRST_LOAD), (second, SECOND_LOAD)):
        run_pipeline(b.spark, sources, now, [0, 1, 2, 3, 4, 99], layers=layers)
    _LAYERS[key] = layers
    return layers


def after_two_runs(layer: int, name: str, drop: tuple[str, ...] = ()):
    return lambda b: b.spark.table(f"{two_runs(b)[layer]}.{name}").drop(*drop)


def run_counts(b: Bridge) -> DataFrame:
    """Row counts of all marts, and of versions in bronze, after two runs."""
    layers = two_runs(b)
    names = [f"{layers[0]}.{t}" for t in ("competitions", "matches", "events", "lineups")] + [f"{layers[2]}.{m}" for m in MARTS]
    counts = [b.spark.table(n).agg(F.lit(n.split(".")[1]).alias("part"), F.count(F.lit(1)).alias("n")) for n in names]
    return reduce(DataFrame.unionAll, counts)


# competitions loaded again by the second run; one without any update time has no watermark and is loaded each time
_AGAIN = """(competition_id < 2 AND match_updated IS NOT NULL OR competition_id IN (
    SELECT competition_id FROM b_competitions GROUP BY competition_id HAVING max(match_updated) IS NULL))"""
_EARLIER = "CASE WHEN competition_id < 2 THEN {0} - INTERVAL '20000' DAY ELSE {0} END AS {0}"
_FIRST = "TIMESTAMP '2024-02-01 00:00:00' AS data_valid_from_utc"
_SEASONS = "(SELECT match_id, competition_id FROM b_matches)"


def _versions(columns: str, old: str, source: str, again: str) -> str:
    """Versions of the first run, closed where the second loads the row again, and those of the second."""
    return f"""SELECT {old}, {_FIRST}, CASE WHEN {again} THEN {_CLOSED_AT} END AS data_valid_to_utc FROM {source}
        UNION ALL SELECT {columns}, {_FROM_LOAD} FROM {source} WHERE {again}"""


check("T1_bronze_competitions", after_two_runs(0, "competitions"),
      _versions("*", f"* REPLACE ({_EARLIER.format('match_updated')})", "b_competitions", _AGAIN))
check("T2_bronze_matches", after_two_runs(0, "matches"),
      _versions("*", f"* REPLACE ({_EARLIER.format('last_updated')}, CASE WHEN competition_id < 2 THEN home_score + 1 ELSE home_score END AS home_score)",
                "b_matches", "competition_id < 2"))
_NAMED_EVENTS = f"(SELECT {_FIXED_EVENTS} FROM b_events)"
_CHANGED = f"match_id IN (SELECT match_id FROM {_SEASONS} WHERE competition_id < 2)"
check("T3_bronze_events", after_two_runs(0, "events"), _versions(_EVENT_COLS, _EVENT_COLS, _NAMED_EVENTS, _CHANGED))
check("T4_bronze_lineups", after_two_runs(0, "lineups"), _versions(_LINEUP_COLS, _LINEUP_COLS, "b_lineups", "competition_id < 2"))
_LATEST = f"CASE WHEN {{0}} THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS data_valid_from_utc, CAST(NULL AS TIMESTAMP) AS data_valid_to_utc"
check("T7_stored_competitions", after_two_runs(1, "competitions"), f"SELECT *, {_LATEST.format(_AGAIN)} FROM b_competitions")
check("T7_stored_events", after_two_runs(1, "events"), f"SELECT {_EVENT_COLS}, {_LATEST.format(_CHANGED)} FROM {_NAMED_EVENTS}")
check("T7_stored_lineups", after_two_runs(1, "lineups"), f"SELECT {_LINEUP_COLS}, {_LATEST.format('competition_id < 2')} FROM b_lineups")
check("T6_stored_matches", after_two_runs(1, "matches"), f"SELECT *, {_LATEST.format('competition_id < 2')} FROM silver_matches")
check("T8_stored_combined", after_two_runs(1, "combined", (s.TYPE_FOLDED,)), f"SELECT {_FIXED_EVENTS} FROM combined")
check("D10_two_runs_results", after_two_runs(2, "combined_results"), "SELECT * FROM results")
check("D10_two_runs_playtime", after_two_runs(2, "combined_player_playtime"), "SELECT * FROM playtime")
check("D10_two_runs_passes", after_two_runs(2, "combined_passes"), f"SELECT {_FIXED_EVENTS} FROM passes")


def select_all(b: Bridge) -> DataFrame:
    table = f"{b.scratch_schema()}.combined_player_playtime"
    rebuild(playtime(b), table)
    return b.spark.table(table)


check("T17_select_all_of_mart", select_all, "SELECT * FROM playtime")
check("D10_whole_run", whole_run, f"SELECT {_FIXED_EVENTS} FROM passes")
check("D10_two_runs", run_counts, """SELECT 'competitions' AS part, count(*) + count(*) FILTER (
        competition_id < 2 AND match_updated IS NOT NULL OR competition_id IN (
            -- without any update time a competition has no watermark and is loaded each time
            SELECT competition_id FROM b_competitions GROUP BY competition_id HAVING max(match_updated) IS NULL)) AS n FROM b_competitions
    UNION ALL SELECT 'matches', count(*) + count(*) FILTER (competition_id < 2) FROM b_matches
    UNION ALL SELECT 'events', count(*) + count(*) FILTER (m.competition_id < 2) FROM b_events e JOIN b_matches m ON e.match_id = m.match_id
    UNION ALL SELECT 'lineups', count(*) + count(*) FILTER (competition_id < 2) FROM b_lineups
    """ + " ".join(f"UNION ALL SELECT '{mart}', count(*) FROM {name}" for mart, name in MARTS.items()))
