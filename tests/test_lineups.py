from helpers import rows

from matchlake import schemas as s
from matchlake.operators import lineups as lu
from matchlake.operators.filters import other_stints
from matchlake.operators.shaping import align, clean
from matchlake.plans import gold
from matchlake.sources.readers import read_lineups

SCHEMA = ("match_id long, team string, player_id long, player_name string, player_nickname string, "
          f"cards {s.PLAYER_SOURCE['cards'].dataType.simpleString()}, "
          f"positions {s.PLAYER_SOURCE['positions'].dataType.simpleString()}")
FINAL, SHIFT = "Final Whistle", "Tactical Shift"


def stint(start, end, begin="00:00", until=None):
    return (1, "Back", begin, until, 1, 2, start, end)


def card(kind, time, period=1):
    return (time, kind, "Foul Committed", period)


PLAYERS = [
    (1, "A", 1, "Starter", None, [], [stint("Starting XI", FINAL)]),
    (1, "A", 2, "Off", "O", [card("Yellow Card", "10:00")],
     [stint("Starting XI", SHIFT, until="30:00"), stint(SHIFT, "Substitution - Off (Injury)", "30:00", "60:30")]),
    (1, "A", 3, "On", "N", None, [stint("Substitution - On (Injury)", FINAL, "60:30")]),
    (1, "A", 4, "Red", "R", [card("Yellow Card", "10:00"), card("Second Yellow", "50:00", 2),
                             card("Red Card", "50:00", 2)],
     [stint("Starting XI", SHIFT), stint(SHIFT, "Foul Committed (Red Card)", "20:00", "50:00"),
      stint("Player On", FINAL)]),
    (1, "B", 5, "Bench", "B", [], []),
    (1, "B", 6, "Shifted", "S", None, [stint(SHIFT, SHIFT), stint("Player On", "Player Off"), stint(None, None)]),
    (1, "B", 7, "Twice", "T", [], [stint("Starting XI", SHIFT)]),
    (1, "B", 7, "Twice", "T", [card("Yellow Card", "70:00", 2)], [stint(SHIFT, FINAL)]),
    (1, "B", None, "Nobody", None, [card("Red Card", "1:00")], [stint("Starting XI", FINAL)]),
]


def flat(spark):
    return lu.flatten_lineups(spark.createDataFrame(PLAYERS, SCHEMA))


def test_flattened_lineups(spark):
    result = flat(spark).select("player_id", "player_nickname", "first_yellow_time", "second_yellow_time",
                                "red_card_period", *lu.lx.STINT_COLUMNS)
    twice = (7, "T", "70:00", None, None, 1, None, None, None, 1)
    assert rows(result) == [
        (None, "Nobody", None, None, None, None, None, None, None, None),
        (1, "Starter", None, None, None, 1, None, None, None, 1),
        (2, "O", "10:00", None, None, 1, "60:30", None, None, 0),
        (3, "N", None, None, None, 0, None, "60:30", None, 1),
        (4, "R", "10:00", "50:00", 2, 1, None, None, "50:00", 0),
        (5, "B", None, None, None, None, None, None, None, None),
        (6, "S", None, None, None, None, None, None, None, None),
        twice, twice,
    ]


def test_separate_summaries_agree(spark):
    nested = spark.createDataFrame(PLAYERS, SCHEMA)
    base = nested.select("match_id", "player_id", "team")
    joined = base.join(lu.card_summary(nested), s.LINEUP_KEY, "left").join(
        lu.stint_summary(nested), s.LINEUP_KEY, "left")
    columns = [*s.LINEUP_KEY, *lu.lx.CARD_COLUMNS, *lu.lx.STINT_COLUMNS]
    assert rows(joined.select(*columns)) == rows(flat(spark).select(*columns))


def test_unaccounted_reasons(spark):
    stints = lu.stint_rows(spark.createDataFrame(PLAYERS, SCHEMA))
    found = other_stints(stints).filter("player_id = 6").select("start_reason", "end_reason")
    assert rows(found) == [(None, None), ("Player On", "Player Off"), (SHIFT, SHIFT)]


def test_playtime(spark):
    lineups = align(flat(spark), s.LINEUPS).na.fill({"competition_id": 1, "season_id": 2})
    durations = spark.createDataFrame([(1, "93:10")], "match_id long, game_end string")
    teams = spark.createDataFrame([(1, 2, 11, "A")], "competition_id long, season_id long, team_id long, team string")
    played = gold.combined_player_playtime(lineups, durations, teams)
    result = played.filter("player_id < 6").select(
        "cst_composite_id", "player_id", "start_minute", "end_minute", "end_second", "duration_played_in_seconds")
    assert rows(result) == [
        ("1-2-", 5, None, None, None, None),
        ("1-2-11", 1, 0, 93, 10, 93 * 60 + 10),
        ("1-2-11", 2, 0, 60, 30, 3630),
        ("1-2-11", 3, 60, 93, 10, 93 * 60 + 10 - 3630),
        ("1-2-11", 4, 0, 50, 0, 3000),
    ]


def test_json_source_with_team_map(spark, tmp_path):
    (tmp_path / "lineups.json").write_text(
        '{"match_id": 5, "lineups": {"A": [{"player_id": 1, "player_name": "Ann", "jersey_number": 9.0, '
        '"cards": [], "positions": [{"from": "00:00", "start_reason": "Starting XI", "end_reason": "Final Whistle"}]}], '
        '"B": [{"player_id": 2, "player_name": "Bo", "cards": [{"time": "12:00", "card_type": "Red Card", "period": 1}]}]}}')
    source = clean(read_lineups(spark, str(tmp_path)), s.LINEUPS)
    result = lu.flatten_lineups(source).select("match_id", "team", "player_id", "player_nickname",
                                               "jersey_number", "red_card_period", "ended_game")
    assert rows(result) == [(5, "A", 1, "Ann", 9, None, 1), (5, "B", 2, "Bo", None, 1, None)]
