"""Declared table contracts: column names, order and types of every layer table."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "json": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}

VALID_FROM = "data_valid_from_utc"
VALID_TO = "data_valid_to_utc"


def contract(text: str) -> T.StructType:
    """Build a schema from lines of ``type name name ...``.

    ``json`` columns are text that holds a JSON value; the field metadata says
    so, because cleaning leaves their content alone.
    """
    fields = []
    for line in text.strip().splitlines():
        kind, *names = line.split()
        fields += [
            T.StructField(name, _TYPES[kind], True, {"json": kind == "json"})
            for name in names
        ]
    return T.StructType(fields)


# --- fixed values: source and layer column names, in contract order ---------

COMPETITIONS = contract("""
    bigint     competition_id season_id
    string     country_name competition_name competition_gender
    boolean    competition_youth competition_international
    string     season_name
    timestamp  match_updated match_updated_360 match_available_360 match_available
    timestamp  data_valid_from_utc data_valid_to_utc
""")

MATCHES = contract("""
    bigint     match_id
    date       match_date
    string     kick_off
    bigint     home_score away_score
    string     match_status match_status_360
    timestamp  last_updated last_updated_360
    bigint     match_week
    bigint     competition_id
    string     competition_country_name competition_name competition
    bigint     season_id
    string     season
    bigint     home_team_id
    string     home_team home_team_gender home_team_group
    bigint     home_team_country_id
    string     home_team_country_name
    bigint     away_team_id
    string     away_team away_team_gender away_team_group
    bigint     away_team_country_id
    string     away_team_country_name
    bigint     competition_stage_id
    string     competition_stage
    bigint     stadium_id
    string     stadium
    bigint     stadium_country_id
    string     stadium_country_name
    bigint     referee_id
    string     referee
    bigint     referee_country_id
    string     referee_country_name
    string     home_managers away_managers
    bigint     home_manager_id
    string     home_manager_name home_manager_nickname
    date       home_manager_dob
    string     home_manager_country_id home_manager_country_name
    bigint     away_manager_id
    string     away_manager_name away_manager_nickname
    date       away_manager_dob
    string     away_manager_country_id away_manager_country_name
    string     data_version shot_fidelity_version xy_fidelity_version
    timestamp  data_valid_from_utc data_valid_to_utc
""")

EVENTS = contract("""
    string     id
    bigint     period
    string     timestamp
    bigint     minute second
    string     type
    bigint     possession
    string     possession_team play_pattern
    string     team
    bigint     team_id
    string     player
    bigint     player_id
    string     position
    json       tactics
    json       location
    double     duration
    boolean    under_pressure off_camera out counterpress
    string     pass_recipient
    bigint     pass_recipient_id
    double     pass_length pass_angle
    string     pass_height
    json       pass_end_location
    string     pass_body_part pass_type pass_outcome pass_technique
    boolean    pass_switch pass_cross
    string     pass_assisted_shot_id
    boolean    pass_shot_assist pass_inswinging pass_outswinging pass_cut_back
    boolean    pass_deflected pass_through_ball
    json       carry_end_location
    json       shot_end_location
    double     shot_statsbomb_xg
    string     shot_outcome shot_type shot_body_part shot_technique
    boolean    shot_first_time
    string     shot_key_pass_id
    boolean    shot_aerial_won
    json       shot_freeze_frame
    string     goalkeeper_position goalkeeper_type goalkeeper_outcome goalkeeper_body_part
    json       goalkeeper_end_location
    string     goalkeeper_technique
    string     dribble_outcome
    boolean    dribble_overrun dribble_nutmeg
    string     duel_type duel_outcome
    json       50_50
    boolean    block_deflection block_offensive
    boolean    clearance_head clearance_left_foot clearance_right_foot
    string     clearance_body_part
    boolean    clearance_aerial_won
    string     ball_receipt_outcome
    boolean    ball_recovery_recovery_failure ball_recovery_offensive
    string     foul_committed_type
    boolean    foul_committed_advantage
    string     foul_committed_card
    boolean    foul_committed_penalty
    boolean    foul_won_advantage foul_won_defensive
    string     interception_outcome
    boolean    miscontrol_aerial_won
    boolean    injury_stoppage_in_chain
    string     substitution_outcome
    bigint     substitution_outcome_id
    string     substitution_replacement
    bigint     substitution_replacement_id
    json       related_events
    bigint     match_id
    timestamp  data_valid_from_utc data_valid_to_utc
""")

LINEUPS = contract("""
    bigint     competition_id season_id match_id
    string     team
    bigint     player_id
    string     player_name player_nickname
    bigint     jersey_number
    string     country
    string     first_yellow_time first_yellow_reason
    bigint     first_yellow_period
    string     second_yellow_time second_yellow_reason
    bigint     second_yellow_period
    string     red_card_time red_card_reason
    bigint     red_card_period
    bigint     starting_xi
    string     sub_off sub_on removed_due_to_red_card
    bigint     ended_game
    timestamp  data_valid_from_utc data_valid_to_utc
""")

CARD = contract("""
    string     time card_type reason
    bigint     period
""")

STINT = contract("""
    bigint     position_id
    string     position from to
    bigint     from_period to_period
    string     start_reason end_reason
""")

COMBINED_COMPETITION_COLUMNS = """
    competition_id season_id country_name competition_name competition_gender
    competition_youth competition_international season_name
""".split()

COMBINED_MATCH_COLUMNS = """
    match_id match_date kick_off home_score away_score match_status match_week match_name
    home_team_id home_team home_team_gender home_team_group
    home_team_country_id home_team_country_name
    away_team_id away_team away_team_gender away_team_group
    away_team_country_id away_team_country_name
    winning_team winning_team_id
    competition_stage_id competition_stage fixed_competition_stage competition_stage_ranking
    stadium_id stadium stadium_country_id stadium_country_name
    referee_id referee referee_country_id referee_country_name
    home_managers away_managers
    home_manager_id home_manager_name home_manager_nickname home_manager_dob
    home_manager_country_id home_manager_country_name
    away_manager_id away_manager_name away_manager_nickname away_manager_dob
    away_manager_country_id away_manager_country_name
    penalty_shootout home_pen_score away_pen_score
""".split()

# --- end of fixed values ------------------------------------------------------

COMBINED_EVENT_COLUMNS = [
    name for name in EVENTS.names if name not in ("match_id", VALID_FROM, VALID_TO)
]

COMPETITION_KEY = ["competition_id", "season_id"]
# beside the declared columns of stored event-grain rows: the type in lower case, by which they are sorted
TYPE_FOLDED = "type_folded"
COMBINED_CLUSTER = [TYPE_FOLDED, "match_id"]
MATCH_KEY = ["match_id"]
EVENT_KEY = ["id"]
LINEUP_KEY = ["match_id", "player_id"]


def _subset(schema: T.StructType, drop: tuple[str, ...]) -> list[T.StructField]:
    return [field for field in schema.fields if field.name not in drop]


# What a source delivers: the contract without the version columns, and for
# lineups the nested lists that the flattening step reduces.
COMPETITIONS_SOURCE = T.StructType(_subset(COMPETITIONS, (VALID_FROM, VALID_TO)))
MATCHES_SOURCE = T.StructType(_subset(MATCHES, (VALID_FROM, VALID_TO)))
EVENTS_SOURCE = T.StructType(_subset(EVENTS, (VALID_FROM, VALID_TO)))
PLAYER_SOURCE = T.StructType([
    *[f for f in LINEUPS.fields if f.name in
      ("player_id", "player_name", "player_nickname", "jersey_number", "country")],
    T.StructField("cards", T.ArrayType(CARD)),
    T.StructField("positions", T.ArrayType(STINT)),
])
LINEUPS_SOURCE = T.StructType([
    *[f for f in LINEUPS.fields if f.name in ("competition_id", "season_id", "match_id")],
    T.StructField("lineups", T.MapType(T.StringType(), T.ArrayType(PLAYER_SOURCE))),
])
