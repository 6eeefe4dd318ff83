"""Column rules that shape the driver tables into matches, events and lineups.

Every rule is one expression that Spark SQL and DuckDB read alike (whole-number
arithmetic, CASE and text functions), so both engines start from the same rows.
"""

VALID_FROM = "2024-02-01 00:00:00"

# orders o; h, a = nation of the home and away team; r = region of the competition
COMPETITION_OF_ORDER = "o_custkey % 5"
SEASON_OF_ORDER = "CAST(year(o_orderdate) AS BIGINT)"
HOME_OF_ORDER = "o_orderkey % 25"
AWAY_OF_ORDER = "(o_orderkey % 25 + 1 + o_orderkey % 24) % 25"

# stages below the sixteen newest matches of a season; friendlies only in 1998
LOWER_STAGE = """CASE
    WHEN o_orderkey % 12 = 0 THEN 'Regular Season'
    WHEN o_orderkey % 12 = 1 THEN 'League Stage'
    WHEN o_orderkey % 12 IN (2, 3) THEN '1st Group Stage'
    WHEN o_orderkey % 12 = 4 THEN 'Play-in Round'
    WHEN o_orderkey % 12 = 5 THEN 'Round of 128'
    WHEN o_orderkey % 12 = 6 THEN '3rd Round'
    WHEN o_orderkey % 12 = 7 THEN 'Round of 32'
    WHEN o_orderkey % 12 = 8 THEN '8th Finals'
    WHEN o_orderkey % 12 = 9 AND year(o_orderdate) = 1998 THEN 'Friendly'
    WHEN o_orderkey % 12 = 10 AND year(o_orderdate) = 1998 THEN NULL
    ELSE 'Group Stage' END"""

STAGE = f"""CASE
    WHEN place = 1 THEN 'Final'
    WHEN place = 2 THEN '3rd Place Final'
    WHEN place <= 4 THEN 'Semi-finals'
    WHEN place <= 8 THEN 'Quarter-finals'
    WHEN place <= 16 THEN 'Round of 16'
    ELSE {LOWER_STAGE} END"""

MATCH = {
    "match_id": "o_orderkey",
    "match_date": "CAST(o_orderdate AS DATE)",
    "kick_off": "LPAD(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':00:00.000'",
    "home_score": "o_orderkey % 4",
    "away_score": "o_custkey % 4",
    "match_status": "'available'",
    "last_updated": "o_orderdate",
    "match_week": "o_orderkey % 38 + 1",
    "competition_id": COMPETITION_OF_ORDER,
    "competition_country_name": "r_name",
    "competition_name": "'Cup ' || r_name",
    "competition": "r_name || ' - Cup ' || r_name",
    "season_id": SEASON_OF_ORDER,
    "season": "CAST(year(o_orderdate) AS STRING)",
    "home_team_id": HOME_OF_ORDER,
    "home_team": "h_name",
    "home_team_gender": "'male'",
    "home_team_country_id": "CAST(h_region AS BIGINT)",
    "home_team_country_name": "h_name",
    "away_team_id": AWAY_OF_ORDER,
    "away_team": "a_name",
    "away_team_gender": "'male'",
    "away_team_country_id": "CAST(a_region AS BIGINT)",
    "away_team_country_name": "a_name",
    "competition_stage": STAGE,
    "stadium_id": "o_custkey",
    "stadium": "'Stadium ' || CAST(o_custkey AS STRING)",
    "data_version": "'1.1.0'",
}

COMPETITION = {
    "competition_id": "competition_id",
    "season_id": "season_id",
    "country_name": "competition_country_name",
    "competition_name": "competition_name",
    "competition_gender": "'male'",
    "competition_youth": "competition_id = 4",
    "competition_international": "competition_id % 2 = 0",
    "season_name": "season",
    "match_updated": "MAX(last_updated)",
}
COMPETITION_GROUP = ["competition_id", "season_id", "competition_country_name",
                     "competition_name", "season"]

# one competition without matches, for the NULL-extended rows
EMPTY_COMPETITION = {
    "competition_id": "CAST(99 AS BIGINT)",
    "season_id": "CAST(1900 AS BIGINT)",
    "country_name": "'NOWHERE'",
    "competition_name": "'Cup NOWHERE'",
    "competition_gender": "'male'",
    "competition_youth": "FALSE",
    "competition_international": "FALSE",
    "season_name": "'1900'",
}

# lineitem l; h, a = nation of the home and away team
HOME_OF_LINE = "l_orderkey % 25"
AWAY_OF_LINE = "(l_orderkey % 25 + 1 + l_orderkey % 24) % 25"
PLAYER = "l_partkey % 5 + 5 * (l_orderkey % 400)"
RECIPIENT = "CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE (l_partkey * 7 + 1) % 2000 END"


def player_text(number: str) -> str:
    """Player name; every fiftieth has the doubled apostrophe that cleaning repairs."""
    return (f"CASE WHEN ({number}) % 50 = 0 THEN 'N''''Golo ' ELSE 'Player ' END "
            f"|| CAST({number} AS STRING)")


EVENT = {
    "id": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || "
          "CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(l_quantity AS BIGINT) AS STRING)",
    "period": "CAST(l_linenumber % 5 + 1 AS BIGINT)",
    "timestamp": "'00:' || LPAD(CAST(l_partkey % 45 AS STRING), 2, '0') || ':' || "
                 "LPAD(CAST(l_suppkey % 60 AS STRING), 2, '0') || '.000'",
    "minute": "l_partkey % 45 + CASE l_linenumber % 5 WHEN 0 THEN 0 WHEN 1 THEN 45 "
              "WHEN 2 THEN 90 WHEN 3 THEN 105 ELSE 120 END",
    "second": "l_suppkey % 60",
    "type": "CASE WHEN l_returnflag = 'R' THEN 'Shot' WHEN l_linenumber = 3 THEN 'PASS' "
            "ELSE 'Pass' END",
    "possession": "CAST(l_linenumber AS BIGINT)",
    "possession_team": "CASE WHEN l_suppkey % 2 = 0 THEN h_name ELSE a_name END",
    "play_pattern": "CASE WHEN l_suppkey % 3 = 0 THEN 'From Corner' ELSE 'Regular Play' END",
    "team": "CASE WHEN l_partkey % 2 = 0 THEN h_name ELSE a_name END",
    "team_id": f"CASE WHEN l_partkey % 2 = 0 THEN {HOME_OF_LINE} ELSE {AWAY_OF_LINE} END",
    "player": player_text(PLAYER),
    "player_id": PLAYER,
    "position": "CASE l_partkey % 3 WHEN 0 THEN 'Goalkeeper' WHEN 1 THEN 'Left Back' "
                "ELSE 'Center Midfield' END",
    "location": "CASE l_suppkey % 11 WHEN 0 THEN 'null' WHEN 1 THEN '' ELSE "
                "'[' || CAST(l_partkey % 120 AS STRING) || '.0, ' || "
                "CAST(l_suppkey % 80 AS STRING) || '.5]' END",
    "duration": "l_tax * 10",
    "under_pressure": "CASE WHEN l_tax = 0 THEN NULL ELSE l_tax > 0.04 END",
    "off_camera": "CASE WHEN l_suppkey % 7 = 0 THEN TRUE END",
    "counterpress": "l_partkey % 9 = 0",
    "pass_recipient": f"CASE WHEN l_suppkey % 5 <> 0 THEN {player_text('((l_partkey * 7 + 1) % 2000)')} END",
    "pass_recipient_id": RECIPIENT,
    "pass_length": "l_quantity",
    "pass_angle": "CASE WHEN l_discount = 0 THEN NULL ELSE (l_discount * 100 - 5) * 0.6e0 END",
    "pass_height": "CASE WHEN l_quantity > 25 THEN 'High Pass' ELSE 'Ground Pass' END",
    "pass_end_location": "CASE WHEN l_linenumber = 7 THEN NULL "
                         "WHEN l_partkey % 50 = 0 THEN '[-1.0, 5.0]' "
                         "WHEN l_partkey % 50 = 1 THEN '[80.0, 40.0, 1.5]' ELSE "
                         "'[' || CAST(CAST(l_quantity AS BIGINT) * 2 AS STRING) || '.0, ' || "
                         "CAST(l_suppkey % 80 AS STRING) || '.0]' END",
    "pass_body_part": "CASE WHEN l_suppkey % 4 = 0 THEN 'Left Foot' ELSE 'Right Foot' END",
    "pass_outcome": "CASE WHEN l_linestatus = 'O' THEN NULL ELSE 'Incomplete' END",
    "pass_switch": "l_quantity > 45",
    "pass_cross": "CASE WHEN l_partkey % 6 = 0 THEN TRUE END",
    "pass_shot_assist": "CASE WHEN l_partkey % 8 = 0 THEN FALSE WHEN l_partkey % 8 = 1 THEN TRUE END",
    "shot_outcome": "CASE WHEN l_returnflag <> 'R' THEN NULL WHEN l_linestatus = 'F' THEN 'Goal' "
                    "ELSE 'Saved' END",
    "match_id": "l_orderkey",
}

# orders o exploded to period p: the end of each half, extra time for some draws
EXTRA_TIME = "o_orderkey % 4 = o_custkey % 4 AND o_orderkey % 3 = 0"
HALF_END = {
    "id": "'half-' || CAST(o_orderkey AS STRING) || '-' || CAST(p AS STRING)",
    "period": "CAST(p AS BIGINT)",
    "timestamp": "'00:45:00.000'",
    "minute": "CASE p WHEN 1 THEN 45 WHEN 2 THEN 90 WHEN 3 THEN 105 ELSE 120 END + o_orderkey % 4",
    "second": "o_orderkey % 60",
    "type": "'Half End'",
    "possession": "CAST(p AS BIGINT)",
    "possession_team": "h_name",
    "team": "h_name",
    "team_id": HOME_OF_ORDER,
    "match_id": "o_orderkey",
}

# lineitem grouped to at most 4 x 5 x 4 stint kinds per match and player
STINT_KEYS = {
    "match_id": "l_orderkey",
    "player_id": PLAYER,
    "start_kind": "l_suppkey % 4",
    "end_kind": "CAST(l_linenumber % 5 AS BIGINT)",
    "card_kind": "CASE WHEN l_partkey % 7 < 3 THEN l_partkey % 7 ELSE 3 END",
}
STINT_VALUES = {
    "on_minute": "MAX(l_suppkey % 90)",
    "off_minute": "MAX(45 + CAST(l_quantity AS BIGINT))",
    "clock_second": "MAX(l_partkey % 60)",
    "name_pad": "MAX(l_suppkey % 3)",
}
STINT = {
    "start_reason": "CASE start_kind WHEN 0 THEN 'Starting XI' "
                    "WHEN 1 THEN 'Substitution - On (Tactical)' WHEN 2 THEN 'Tactical Shift' "
                    "ELSE 'Player On' END",
    "end_reason": "CASE end_kind WHEN 0 THEN 'Final Whistle' "
                  "WHEN 1 THEN 'Substitution - Off (Tactical)' "
                  "WHEN 2 THEN 'Foul Committed (Red Card)' WHEN 3 THEN 'Tactical Shift' "
                  "ELSE 'Player Off' END",
    "from": "CASE WHEN start_kind = 0 THEN '00:00' ELSE LPAD(CAST(on_minute AS STRING), 2, '0') "
            "|| ':' || LPAD(CAST(clock_second AS STRING), 2, '0') END",
    "to": "LPAD(CAST(off_minute AS STRING), 2, '0') || ':' || "
          "LPAD(CAST(clock_second AS STRING), 2, '0')",
    "from_period": "CAST(1 AS BIGINT)",
    "to_period": "end_kind + 1",
    "position_id": "start_kind * 5 + end_kind",
    "position": "'Position ' || CAST(start_kind AS STRING)",
}
CARD = {
    "card_type": "CASE card_kind WHEN 0 THEN 'Yellow Card' WHEN 1 THEN 'Second Yellow' "
                 "WHEN 2 THEN 'Red Card' END",
    "time": "LPAD(CAST(off_minute AS STRING), 2, '0') || ':' || "
            "LPAD(CAST(clock_second AS STRING), 2, '0')",
    "reason": "'Foul Committed'",
    "period": "end_kind + 1",
}
PLAYER_ATTRIBUTES = {
    "player_name": "'Player ' || LPAD(CAST(player_id AS STRING), 4, '0') || "
                   "REPEAT('x', CAST(name_pad AS INT))",
    "player_nickname": "CASE WHEN name_pad = 0 THEN NULL ELSE 'P' || CAST(player_id AS STRING) "
                       "|| REPEAT('y', CAST(name_pad AS INT)) END",
    "jersey_number": "player_id % 99 + 1",
    "country": "'Country ' || CAST(player_id % 7 AS STRING)",
}

# orders as two batches of a slowly changing table
CHANGE = {
    "match_id": "o_orderkey",
    "competition_id": COMPETITION_OF_ORDER,
    "season_id": SEASON_OF_ORDER,
    "status": "o_orderstatus",
    "last_updated": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate END",
}
FIRST_BATCH = "o_orderdate < TIMESTAMP '1998-01-01 00:00:00'"

# orders as raw text with missing-value texts mixed in
RAW = {
    "order_id": "o_orderkey",
    "name": "CASE o_orderkey % 10 WHEN 0 THEN 'NaN' WHEN 1 THEN 'None' WHEN 2 THEN 'Null' "
            "WHEN 3 THEN 'nan' WHEN 4 THEN 'null' WHEN 5 THEN '' WHEN 6 THEN 'NULL' "
            "ELSE o_orderpriority END",
    "amount": "CASE o_orderkey % 9 WHEN 0 THEN CAST(o_custkey AS STRING) || '.0' "
              "WHEN 1 THEN CAST(o_custkey AS STRING) || '.7' WHEN 2 THEN 'abc' "
              "WHEN 3 THEN 'null' WHEN 4 THEN ' ' || CAST(o_custkey AS STRING) || ' ' "
              "ELSE CAST(o_custkey AS STRING) END",
    "ratio": "CASE o_orderkey % 7 WHEN 0 THEN 'nan' WHEN 1 THEN 'x1' WHEN 2 THEN '1e2' "
             "ELSE CAST(o_custkey AS STRING) || '.25' END",
    "flagged": "CASE o_orderkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'None' "
               "WHEN 3 THEN 'maybe' ELSE 'True' END",
    "seen": "CASE o_orderkey % 6 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) "
            "WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T10:20:30.5' "
            "WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 23:59:59' "
            "WHEN 3 THEN 'yesterday' WHEN 4 THEN '' ELSE '2024-13-45' END",
    "payload": "'[' || CAST(o_orderkey AS STRING) || ', {\"a\": null}]'",
}
