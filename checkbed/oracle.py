"""DuckDB SQL for the match-shaped views and layer tables, as named CTEs."""

from __future__ import annotations

import re

from pyspark.sql import types as T

from matchlake import schemas as s

from . import columns as c

_TYPES = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


def sql_type(kind: T.DataType) -> str:
    name = kind.simpleString()
    return _TYPES.get(name, name.upper())


def quoted(names, prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{n}"' for n in names)


def aliased(rules: dict[str, str]) -> str:
    return ", ".join(f'{text} AS "{name}"' for name, text in rules.items())


def shaped(rules: dict[str, str], shape: T.StructType) -> str:
    """Select list of a contract: the given rules, typed NULLs elsewhere."""
    return ", ".join(
        f'CAST({rules.get(f.name, "NULL")} AS {sql_type(f.dataType)}) AS "{f.name}"'
        for f in shape.fields
    )


# Stage ranks and their case-folded patterns, first hit first.
STAGE_RANK = """CAST(CASE
    WHEN st LIKE '%regular%season%' OR st LIKE '%league%' THEN 0
    WHEN st LIKE '%group%' THEN 1
    WHEN st LIKE '%play-in%' OR st LIKE '%qualif%' THEN 2
    WHEN st LIKE '%128%' OR st LIKE '%1st%round%' OR st LIKE '%2nd%round%' THEN 3
    WHEN st LIKE '%64%' OR st LIKE '%32nd%final%' OR st LIKE '%3rd%round%' OR st LIKE '%4th%round%' THEN 4
    WHEN st LIKE '%32%' OR st LIKE '%16th%final%' THEN 5
    WHEN st LIKE '%16%' OR st LIKE '%8th%final%' THEN 6
    WHEN st LIKE '%quarter%' OR st LIKE '%qtr%' THEN 7
    WHEN st LIKE '%semi%' THEN 8
    WHEN st LIKE '%3rd%' OR st LIKE '%third%' THEN 9
    WHEN st LIKE '%final%' THEN 10
    ELSE 99 END AS INTEGER)"""

_MATCH_COLS = [n for n in s.MATCHES_SOURCE.names]
_COMP5 = "competition_id, season_id, country_name, competition_name, season_name"

CTES: dict[str, str] = {
    "h": "SELECT CAST(n_nationkey AS BIGINT) AS h_key, n_name AS h_name, n_regionkey AS h_region FROM nation",
    "a": "SELECT CAST(n_nationkey AS BIGINT) AS a_key, n_name AS a_name, n_regionkey AS a_region FROM nation",
    "top_orders": f"""SELECT o_orderkey AS top_key, place FROM (
        SELECT o_orderkey, row_number() OVER (
            PARTITION BY {c.COMPETITION_OF_ORDER}, {c.SEASON_OF_ORDER}
            ORDER BY o_orderkey DESC) AS place FROM orders) WHERE place <= 16""",
    "b_matches": f"""SELECT {shaped(c.MATCH, s.MATCHES_SOURCE)}
        FROM orders LEFT JOIN top_orders ON o_orderkey = top_key
        JOIN region ON r_regionkey = {c.COMPETITION_OF_ORDER}
        JOIN h ON h_key = {c.HOME_OF_ORDER} JOIN a ON a_key = {c.AWAY_OF_ORDER}""",
    "b_competitions": f"""SELECT {shaped(c.COMPETITION, s.COMPETITIONS_SOURCE)} FROM b_matches
        GROUP BY {', '.join(c.COMPETITION_GROUP)}
        UNION ALL SELECT {shaped(c.EMPTY_COMPETITION, s.COMPETITIONS_SOURCE)}""",
    "b_events": f"""SELECT {shaped(c.EVENT, s.EVENTS_SOURCE)}
        FROM lineitem JOIN h ON h_key = {c.HOME_OF_LINE} JOIN a ON a_key = {c.AWAY_OF_LINE}
        UNION ALL SELECT {shaped(c.HALF_END, s.EVENTS_SOURCE)}
        FROM orders JOIN (SELECT unnest([1, 2, 3, 4]) AS p)
            ON p <= 2 OR ({c.EXTRA_TIME})
        JOIN h ON h_key = {c.HOME_OF_ORDER} JOIN a ON a_key = {c.AWAY_OF_ORDER}""",
    "b_kinds": f"""SELECT {aliased(c.STINT_KEYS)}, {aliased(c.STINT_VALUES)}
        FROM lineitem GROUP BY ALL""",
    # flat stints and cards, without arrays
    "b_stints": f"SELECT match_id, player_id, {aliased(c.STINT)} FROM b_kinds",
    "b_cards": f"SELECT match_id, player_id, {aliased(c.CARD)} FROM b_kinds WHERE card_kind < 3",
    "b_players": f"""SELECT competition_id, season_id, k.match_id,
            CASE WHEN player_id % 2 = 0 THEN home_team ELSE away_team END AS team,
            player_id, {aliased(c.PLAYER_ATTRIBUTES)}
        FROM (SELECT match_id, player_id, MAX(name_pad) AS name_pad FROM b_kinds GROUP BY ALL) k
        JOIN b_matches m ON k.match_id = m.match_id""",
    # lineups flattened
    "card_sums": """SELECT match_id, player_id,
            MAX(time) FILTER (WHERE card_type = 'Yellow Card') AS first_yellow_time,
            MAX(reason) FILTER (WHERE card_type = 'Yellow Card') AS first_yellow_reason,
            MAX(period) FILTER (WHERE card_type = 'Yellow Card') AS first_yellow_period,
            MAX(time) FILTER (WHERE card_type = 'Second Yellow') AS second_yellow_time,
            MAX(reason) FILTER (WHERE card_type = 'Second Yellow') AS second_yellow_reason,
            MAX(period) FILTER (WHERE card_type = 'Second Yellow') AS second_yellow_period,
            MAX(time) FILTER (WHERE card_type = 'Red Card') AS red_card_time,
            MAX(reason) FILTER (WHERE card_type = 'Red Card') AS red_card_reason,
            MAX(period) FILTER (WHERE card_type = 'Red Card') AS red_card_period
        FROM b_cards GROUP BY match_id, player_id""",
    "stint_marks": """SELECT match_id, player_id,
            CASE WHEN start_reason = 'Starting XI' THEN 1 END AS starting_xi,
            CASE WHEN contains(end_reason, 'Substitution - Off') THEN "to" END AS sub_off,
            CASE WHEN contains(start_reason, 'Substitution - On') THEN "from" END AS sub_on,
            CASE WHEN end_reason = 'Foul Committed (Red Card)' THEN "to" END AS removed_due_to_red_card,
            CASE WHEN end_reason = 'Final Whistle' THEN 1 END AS ended_game
        FROM b_stints""",
    "stint_maxes": """SELECT match_id, player_id, CAST(MAX(starting_xi) AS BIGINT) AS starting_xi,
            MAX(sub_off) AS sub_off, MAX(sub_on) AS sub_on,
            MAX(removed_due_to_red_card) AS removed_due_to_red_card,
            CAST(MAX(ended_game) AS BIGINT) AS ended_game
        FROM stint_marks
        WHERE COALESCE(CAST(starting_xi AS VARCHAR), sub_off, sub_on, removed_due_to_red_card,
                       CAST(ended_game AS VARCHAR)) IS NOT NULL
        GROUP BY match_id, player_id""",
    "stint_sums": """SELECT match_id, player_id, COALESCE(starting_xi, 0) AS starting_xi, sub_off,
            sub_on, removed_due_to_red_card,
            CASE WHEN removed_due_to_red_card IS NOT NULL THEN 0
                 ELSE COALESCE(ended_game, 0) END AS ended_game
        FROM stint_maxes""",
    "b_lineups": """SELECT competition_id, season_id, match_id, team, player_id, player_name,
            COALESCE(player_nickname, player_name) AS player_nickname, jersey_number, country,
            first_yellow_time, first_yellow_reason, first_yellow_period,
            second_yellow_time, second_yellow_reason, second_yellow_period,
            red_card_time, red_card_reason, red_card_period,
            starting_xi, sub_off, sub_on, removed_due_to_red_card, ended_game
        FROM b_players LEFT JOIN card_sums USING (match_id, player_id)
        LEFT JOIN stint_sums USING (match_id, player_id)""",
    # silver
    "matches_raw": f"""SELECT *,
            COALESCE(home_team, '') || ' vs ' || COALESCE(away_team, '') AS match_name,
            CASE WHEN home_score = away_score THEN 'Draw'
                 WHEN home_score > away_score THEN home_team ELSE away_team END AS winning_team,
            CASE WHEN home_score = away_score THEN -1
                 WHEN home_score > away_score THEN home_team_id ELSE away_team_id END AS winning_team_id,
            {STAGE_RANK} AS competition_stage_ranking,
            CASE WHEN competition_stage = '1st Group Stage' THEN 'Group Stage'
                 ELSE competition_stage END AS fixed_competition_stage
        FROM (SELECT *, lower(competition_stage) AS st FROM b_matches)""",
    "s_matches": f"""SELECT {quoted(_MATCH_COLS)}, match_name, winning_team, winning_team_id,
            competition_stage_ranking, fixed_competition_stage, 0 AS penalty_shootout,
            0 AS home_pen_score, 0 AS away_pen_score
        FROM matches_raw""",
    "so_goals": """SELECT m.match_id, m.home_team, m.away_team, e.team, e.team_id
        FROM s_matches m JOIN b_events e ON e.match_id = m.match_id
        WHERE m.competition_stage_ranking > 1 AND m.winning_team = 'Draw'
          AND e.period = 5 AND e.type = 'Shot' AND e.shot_outcome = 'Goal'""",
    "so_scores": """SELECT match_id, home_team, away_team,
            CAST(count(*) FILTER (WHERE team = home_team) AS INTEGER) AS home_goals,
            CAST(count(*) FILTER (WHERE team = away_team) AS INTEGER) AS away_goals,
            min(team_id) FILTER (WHERE team = home_team) AS home_id,
            min(team_id) FILTER (WHERE team = away_team) AS away_id
        FROM so_goals GROUP BY match_id, home_team, away_team""",
    "so_results": """SELECT match_id,
            CASE WHEN home_goals > away_goals THEN home_team ELSE away_team END AS shootout_winner,
            CASE WHEN home_goals > away_goals THEN home_id ELSE away_id END AS shootout_winner_id,
            home_goals, away_goals FROM so_scores""",
    "silver_matches": f"""SELECT {quoted(_MATCH_COLS, 'm.')}, m.match_name,
            COALESCE(r.shootout_winner, m.winning_team) AS winning_team,
            COALESCE(r.shootout_winner_id, m.winning_team_id) AS winning_team_id,
            m.competition_stage_ranking, m.fixed_competition_stage,
            CASE WHEN r.match_id IS NULL THEN 0 ELSE 1 END AS penalty_shootout,
            COALESCE(r.home_goals, 0) AS home_pen_score,
            COALESCE(r.away_goals, 0) AS away_pen_score
        FROM s_matches m LEFT JOIN so_results r ON r.match_id = m.match_id""",
    "match_grain": f"""SELECT {quoted(s.COMBINED_COMPETITION_COLUMNS, 'c.')},
            {quoted(s.COMBINED_MATCH_COLUMNS, 'm.')}
        FROM b_competitions c LEFT JOIN silver_matches m
        ON c.competition_id = m.competition_id AND c.season_id = m.season_id""",
    "combined": f"""SELECT g.*, {quoted(s.COMBINED_EVENT_COLUMNS, 'e.')}
        FROM match_grain g LEFT JOIN b_events e ON e.match_id = g.match_id""",
    # gold
    "player_lookup": """SELECT player_id, player_nickname FROM (
            SELECT player_id, player_nickname, row_number() OVER (
                PARTITION BY player_id
                ORDER BY length(coalesce(player_nickname, '')) NULLS FIRST,
                         length(player_name) NULLS FIRST, player_nickname NULLS FIRST,
                         player_name NULLS FIRST) AS place
            FROM b_lineups) WHERE place = 1""",
    "team_lookup": """SELECT competition_id, season_id, home_team_id AS team_id, home_team AS team
            FROM silver_matches
        UNION SELECT competition_id, season_id, away_team_id, away_team FROM silver_matches""",
    "half_ends": """SELECT match_id, period,
            printf('%02d:%02d', coalesce(minute, 0), coalesce(second, 0)) AS label,
            (minute - CASE period WHEN 1 THEN 0 WHEN 2 THEN 45 WHEN 3 THEN 90 ELSE 105 END) * 60
                + second AS secs
        FROM b_events WHERE type = 'Half End' AND period BETWEEN 1 AND 4""",
    "durations": """SELECT match_id,
            '00:00' AS h1_start, max(label) FILTER (WHERE period = 1) AS h1_end,
            max(secs) FILTER (WHERE period = 1) AS h1_duration_seconds,
            '45:00' AS h2_start, max(label) FILTER (WHERE period = 2) AS h2_end,
            max(secs) FILTER (WHERE period = 2) AS h2_duration_seconds,
            max('90:00') FILTER (WHERE period = 3) AS et1_start,
            max(label) FILTER (WHERE period = 3) AS et1_end,
            max(secs) FILTER (WHERE period = 3) AS et1_duration_seconds,
            max('105:00') FILTER (WHERE period = 4) AS et2_start,
            max(label) FILTER (WHERE period = 4) AS et2_end,
            max(secs) FILTER (WHERE period = 4) AS et2_duration_seconds,
            CAST(coalesce(max(secs) FILTER (WHERE period = 1), 0)
                + coalesce(max(secs) FILTER (WHERE period = 2), 0)
                + coalesce(max(secs) FILTER (WHERE period = 3), 0)
                + coalesce(max(secs) FILTER (WHERE period = 4), 0) AS BIGINT)
                AS total_match_duration_seconds,
            coalesce(max(label) FILTER (WHERE period = 4), max(label) FILTER (WHERE period = 2))
                AS game_end
        FROM half_ends GROUP BY match_id""",
    "clocks": """SELECT l.competition_id, l.season_id, l.match_id, player_id, player_nickname,
            t.team_id, t.team, starting_xi,
            CASE WHEN starting_xi = 1 THEN '0:0' ELSE sub_on END AS start_label,
            CASE WHEN ended_game = 1 THEN d.game_end
                 ELSE coalesce(sub_off, removed_due_to_red_card) END AS end_label
        FROM b_lineups l LEFT JOIN durations d ON l.match_id = d.match_id
        LEFT JOIN team_lookup t ON l.competition_id = t.competition_id
            AND l.season_id = t.season_id AND l.team = t.team""",
    "playtime": """SELECT coalesce(CAST(competition_id AS VARCHAR), '') || '-'
                || coalesce(CAST(season_id AS VARCHAR), '') || '-'
                || coalesce(CAST(team_id AS VARCHAR), '') AS cst_composite_id,
            competition_id, season_id, match_id, player_id, player_nickname, team_id, team,
            starting_xi, start_minute, start_second, end_minute, end_second,
            (end_minute * 60 + end_second) - (start_minute * 60 + start_second)
                AS duration_played_in_seconds
        FROM (SELECT *, TRY_CAST(split_part(start_label, ':', 1) AS INTEGER) AS start_minute,
                TRY_CAST(split_part(start_label, ':', 2) AS INTEGER) AS start_second,
                TRY_CAST(split_part(end_label, ':', 1) AS INTEGER) AS end_minute,
                TRY_CAST(split_part(end_label, ':', 2) AS INTEGER) AS end_second FROM clocks)""",
    "sides": f"""SELECT {_COMP5}, 'home' AS side, home_team_id AS team_id, home_team AS team,
            match_id, winning_team_id, penalty_shootout, competition_stage_ranking FROM match_grain
        UNION ALL SELECT {_COMP5}, 'away', away_team_id, away_team,
            match_id, winning_team_id, penalty_shootout, competition_stage_ranking FROM match_grain""",
    "tallies": f"""SELECT {_COMP5}, side, team_id, team,
            count(DISTINCT match_id) AS matches_played,
            count(DISTINCT match_id) FILTER (WHERE winning_team_id <> -1 AND team_id = winning_team_id
                AND penalty_shootout <> 1) AS win_non_pens,
            count(DISTINCT match_id) FILTER (WHERE winning_team_id <> -1 AND team_id = winning_team_id
                AND penalty_shootout = 1) AS win_in_pens,
            count(DISTINCT match_id) FILTER (WHERE winning_team_id = -1) AS draw,
            count(DISTINCT match_id) FILTER (WHERE winning_team_id <> -1 AND team_id <> winning_team_id
                AND penalty_shootout <> 1) AS lost_non_pens,
            count(DISTINCT match_id) FILTER (WHERE winning_team_id <> -1 AND team_id <> winning_team_id
                AND penalty_shootout = 1) AS lost_in_pens,
            max(competition_stage_ranking) AS max_competition_stage_ranking
        FROM sides GROUP BY {_COMP5}, side, team_id, team""",
    "totals": f"""SELECT {_COMP5}, team_id, team AS team_name,
            CAST(sum(matches_played) AS BIGINT) AS matches_played,
            CAST(sum(win_non_pens) AS BIGINT) AS win_non_pens,
            CAST(sum(win_in_pens) AS BIGINT) AS win_in_pens,
            CAST(sum(draw) AS BIGINT) AS draw,
            CAST(sum(lost_non_pens) AS BIGINT) AS lost_non_pens,
            CAST(sum(lost_in_pens) AS BIGINT) AS lost_in_pens,
            max(max_competition_stage_ranking) AS max_competition_stage_ranking
        FROM tallies GROUP BY {_COMP5}, team_id, team""",
    "stage_names": """SELECT DISTINCT fixed_competition_stage AS competition_stage,
            competition_stage_ranking FROM match_grain""",
    "finals": f"""SELECT DISTINCT {_COMP5}, competition_stage_ranking,
            CASE WHEN competition_stage_ranking = 9 THEN winning_team END AS third_place_winner,
            CASE WHEN competition_stage_ranking = 10 THEN winning_team END AS first_place_winner
        FROM match_grain WHERE competition_stage_ranking IN (9, 10)""",
    "placed": """SELECT f.*, cs.competition_stage,
            CASE WHEN f.max_competition_stage_ranking = 10 THEN w.first_place_winner
                 WHEN f.max_competition_stage_ranking = 9 THEN w.third_place_winner END AS decider
        FROM totals f
        LEFT JOIN stage_names cs ON f.max_competition_stage_ranking = cs.competition_stage_ranking
        LEFT JOIN finals w ON f.competition_id = w.competition_id AND f.season_id = w.season_id
            AND f.max_competition_stage_ranking = w.competition_stage_ranking""",
    "results": f"""SELECT CAST(competition_id AS VARCHAR) || '-' || CAST(season_id AS VARCHAR) || '-'
                || coalesce(CAST(team_id AS VARCHAR), '') AS cst_composite_id,
            {_COMP5}, competition_name || ' ' || season_name AS competition, team_id, team_name,
            matches_played, win_non_pens, win_in_pens, draw, lost_non_pens, lost_in_pens,
            CASE WHEN decider IS NULL OR team_name IS NULL THEN competition_stage
                 WHEN max_competition_stage_ranking = 10 AND decider = team_name THEN '1st Place'
                 WHEN max_competition_stage_ranking = 10 THEN '2nd Place'
                 WHEN decider = team_name THEN '3rd Place' ELSE '4th Place' END AS stage_reached,
            CASE WHEN decider IS NULL OR team_name IS NULL THEN max_competition_stage_ranking
                 WHEN max_competition_stage_ranking = 10 AND decider = team_name THEN 14
                 WHEN max_competition_stage_ranking = 10 THEN 13
                 WHEN decider = team_name THEN 12 ELSE 10 END AS max_competition_stage_ranking,
            win_non_pens + win_in_pens AS wins, lost_non_pens + lost_in_pens AS losses
        FROM placed""",
    "match_mart": f"""SELECT CAST(competition_id AS VARCHAR) || '-' || CAST(season_id AS VARCHAR) || '-'
                || coalesce(CAST(match_id AS VARCHAR), '') AS csm_composite_id,
            {_COMP5}, competition_name || ' ' || season_name AS competition,
            match_id, match_date, match_name, kick_off, home_score, away_score, match_week,
            home_team, min(home_team_id) AS home_team_id, away_team, min(away_team_id) AS away_team_id,
            winning_team, winning_team_id, fixed_competition_stage AS competition_stage,
            competition_stage_ranking, penalty_shootout, home_pen_score, away_pen_score
        FROM match_grain
        GROUP BY {_COMP5}, match_id, match_date, match_name, kick_off, home_score, away_score,
            match_week, home_team, away_team, winning_team, winning_team_id,
            fixed_competition_stage, competition_stage_ranking, penalty_shootout,
            home_pen_score, away_pen_score""",
    "geometry": """SELECT *,
            CASE WHEN location LIKE '[%,%]' THEN
                TRY_CAST(split_part(trim(location, '[]'), ',', 1) AS DOUBLE) END AS pass_start_x,
            CASE WHEN location LIKE '[%,%]' THEN
                TRY_CAST(trim(split_part(trim(location, '[]'), ',', 2)) AS DOUBLE) END AS pass_start_y,
            CASE WHEN pass_end_location LIKE '[%,%]' THEN
                TRY_CAST(split_part(trim(pass_end_location, '[]'), ',', 1) AS DOUBLE) END AS pass_end_x,
            CASE WHEN pass_end_location LIKE '[%,%]' THEN
                TRY_CAST(trim(split_part(trim(pass_end_location, '[]'), ',', 2)) AS DOUBLE) END AS pass_end_y
        FROM b_events""",
    "pass_rows": """SELECT g.*, e.* EXCLUDE (match_id)
        FROM match_grain g JOIN geometry e ON e.match_id = g.match_id
        WHERE lower(e.type) = 'pass'""",
    "passes": f"""SELECT CAST(p.competition_id AS VARCHAR) || '-' || CAST(p.season_id AS VARCHAR) || '-'
                || coalesce(CAST(p.team_id AS VARCHAR), '') AS cst_composite_id,
            CAST(p.competition_id AS VARCHAR) || '-' || CAST(p.season_id AS VARCHAR) || '-'
                || CAST(p.match_id AS VARCHAR) AS csm_composite_id,
            {', '.join('p.' + n.strip() for n in _COMP5.split(','))},
            p.competition_name || ' ' || p.season_name AS competition,
            p.match_id, match_date, match_name, kick_off, home_score, away_score, penalty_shootout,
            home_pen_score, away_pen_score, match_week, home_team, away_team, winning_team_id,
            winning_team, competition_stage, competition_stage_ranking, id, period,
            CASE WHEN period = 1 THEN '1st Half' ELSE '2nd Half' END AS which_half,
            "timestamp", minute, second, type, possession, possession_team, play_pattern, p.team,
            p.team_id, r.matches_played, r.wins, r.draw, r.losses, r.stage_reached,
            CASE WHEN p.team_id = winning_team_id THEN 1 ELSE 0 END AS part_of_winning_team,
            player, p.player_id, pl.player_nickname, "position", location, duration,
            CAST(coalesce(under_pressure, FALSE) AS INTEGER) AS under_pressure,
            CAST(coalesce(off_camera, FALSE) AS INTEGER) AS off_camera,
            CAST(coalesce("out", FALSE) AS INTEGER) AS "out",
            CAST(coalesce(counterpress, FALSE) AS INTEGER) AS counterpress,
            pass_recipient, pass_recipient_id, pr.player_nickname AS pass_recipient_nickname,
            pass_length, pass_angle,
            CASE WHEN cos(pass_angle) > 0 THEN 'Forward' WHEN cos(pass_angle) < 0 THEN 'Backward'
                 ELSE 'Lateral' END AS pass_direction,
            pass_height, pass_end_location, pass_start_x, pass_start_y, pass_end_x, pass_end_y,
            CASE WHEN pass_end_x >= 80 THEN 'Final 3rd' WHEN pass_end_x >= 40 THEN 'Middle 3rd'
                 WHEN pass_end_x >= 0 THEN 'Defensive 3rd'
                 ELSE CAST(pass_end_x AS VARCHAR) END AS pass_end_sector,
            CASE WHEN pass_end_x >= 80 THEN 1.0::DOUBLE WHEN pass_end_x >= 40 THEN 2.0::DOUBLE
                 WHEN pass_end_x >= 0 THEN 3.0::DOUBLE ELSE pass_end_x END AS pass_end_sector_rank,
            pass_body_part, pass_type, coalesce(pass_outcome, 'Success') AS pass_outcome,
            pass_technique,
            CAST(coalesce(pass_switch, FALSE) AS INTEGER) AS pass_switch,
            CAST(coalesce(pass_cross, FALSE) AS INTEGER) AS pass_cross,
            pass_assisted_shot_id,
            CAST(coalesce(pass_shot_assist, FALSE) AS INTEGER) AS pass_shot_assist,
            CAST(coalesce(pass_inswinging, FALSE) AS INTEGER) AS pass_inswinging,
            CAST(coalesce(pass_outswinging, FALSE) AS INTEGER) AS pass_outswinging,
            CAST(coalesce(pass_cut_back, FALSE) AS INTEGER) AS pass_cut_back,
            CAST(coalesce(pass_deflected, FALSE) AS INTEGER) AS pass_deflected,
            CAST(coalesce(pass_through_ball, FALSE) AS INTEGER) AS pass_through_ball
        FROM pass_rows p
        LEFT JOIN results r ON p.competition_id = r.competition_id AND p.season_id = r.season_id
            AND p.team_id = r.team_id
        LEFT JOIN player_lookup pl ON p.player_id = pl.player_id
        LEFT JOIN player_lookup pr ON p.pass_recipient_id = pr.player_id""",
    # raw text and batches
    "raw": f"SELECT {aliased(c.RAW)} FROM orders",
    "first_batch": f"SELECT {aliased(c.CHANGE)} FROM orders WHERE {c.FIRST_BATCH}",
    "loaded": """SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS data_valid_from_utc,
            CAST(NULL AS TIMESTAMP) AS data_valid_to_utc FROM first_batch
        UNION ALL SELECT match_id, competition_id, season_id, 'OLD', last_updated,
            TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-31 23:59:59.999'
        FROM first_batch WHERE match_id % 11 = 0""",
    "second_batch": f"""SELECT match_id, competition_id, season_id,
            CASE WHEN changed THEN 'U' ELSE status END AS status,
            CASE WHEN changed THEN last_updated + INTERVAL '2000' DAY ELSE last_updated END AS last_updated
        FROM (SELECT {aliased(c.CHANGE)}, {c.FIRST_BATCH} AND o_orderkey % 5 = 0 AS changed FROM orders)""",
    "marks": """SELECT competition_id, season_id, max(last_updated) AS watermark
        FROM loaded GROUP BY competition_id, season_id""",
    "newer": """SELECT s.* FROM second_batch s
        LEFT JOIN marks k ON s.competition_id = k.competition_id AND s.season_id = k.season_id
        WHERE k.watermark IS NULL OR s.last_updated > k.watermark""",
    "closed": """SELECT match_id, competition_id, season_id, status, last_updated, data_valid_from_utc,
            CASE WHEN data_valid_to_utc IS NULL AND match_id IN (SELECT match_id FROM newer)
                 THEN TIMESTAMP '2024-02-29 23:59:59.999' ELSE data_valid_to_utc END AS data_valid_to_utc
        FROM loaded""",
    "upserted": """SELECT * FROM closed UNION ALL
        SELECT *, TIMESTAMP '2024-03-01 00:00:00', NULL FROM newer""",
}


def oracle(query: str) -> str:
    """Prefix a query with the CTEs it names, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"(?<![\w\".]){name}(?![\w\"(])", text):
                needed.add(name)
                visit(CTES[name])

    visit(query)
    if not needed:
        return query
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    own = query.lstrip()
    tail = f", {own[5:]}" if own.startswith("WITH ") else f"\n{query}"
    return f"WITH {parts}{tail}"
