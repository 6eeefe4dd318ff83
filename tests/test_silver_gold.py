import math

import pytest
from helpers import rows
from pyspark.sql import functions as F

from matchlake import schemas as s
from matchlake.functions import matches as mx
from matchlake.functions import passes as px
from matchlake.operators import joins
from matchlake.operators.shaping import align
from matchlake.plans import gold, silver
from matchlake.sources import readers

STAGES = {
    "Regular Season": 0, "League Stage": 0, "Group Stage": 1, "1st Group Stage": 1,
    "Play-in Round": 2, "Qualifying": 2, "1st Round": 3, "Round of 128": 3, "3rd Round": 4,
    "Round of 64": 4, "Round of 32": 5, "16th Finals": 5, "Round of 16": 6, "8th Finals": 6,
    "Quarter-finals": 7, "Semi-finals": 8, "3rd Place Final": 9, "Final": 10, "Friendly": 99,
    None: 99,
}


def match_frame(spark, data):
    """Matches from (match_id, home, away, home_score, away_score, stage); ids 1 and 2."""
    columns = "match_id long, home_team string, away_team string, home_score long, away_score long, competition_stage string"
    df = spark.createDataFrame(data, columns).withColumns({
        "competition_id": F.lit(1), "season_id": F.lit(7),
        "home_team_id": F.lit(1), "away_team_id": F.lit(2),
    })
    return align(df, s.MATCHES)


def event_frame(spark, data, columns):
    return align(spark.createDataFrame(data, columns), s.EVENTS)


def test_stage_ranks(spark):
    df = spark.createDataFrame([(k, v) for k, v in STAGES.items()], "stage string, expected int")
    wrong = df.withColumn("rank", mx.stage_rank(F.col("stage"))).filter("rank <> expected")
    assert rows(wrong) == []


def test_match_results_and_shootouts(spark):
    matches = match_frame(spark, [
        (1, "Cote d'Azur", "Bees", 1, 1, "Final"),        # shoot-out 2-1
        (2, "Ants", "Bees", 1, 1, "Group Stage"),         # draw stays
        (3, "Ants", "Bees", 2, 2, "Quarter-finals"),      # no period 5
        (4, "Ants", "Bees", 0, 3, "Semi-finals"),
        (5, "Ants", "Bees", None, 3, "Semi-finals"),      # missing score: away branch
        (6, "Ants", "Bees", 1, 1, "Semi-finals"),         # level shoot-out goes to the away side
    ])
    goal = (5, "Shot", "Goal")
    events = event_frame(spark, [
        ("a", 1, *goal, "Cote d'Azur", 11), ("b", 1, *goal, "Cote d'Azur", 11),
        ("c", 1, *goal, "Bees", 12), ("d", 1, 5, "Shot", "Saved", "Bees", 12),
        ("e", 2, *goal, "Ants", 1), ("f", 3, 4, "Shot", "Goal", "Ants", 1),
        ("g", 6, *goal, "Ants", 21), ("h", 6, *goal, "Bees", 22),
    ], "id string, match_id long, period long, type string, shot_outcome string, team string, team_id long")
    result = silver.silver_matches(matches, events).select(
        "match_id", "match_name", "winning_team", "winning_team_id", "penalty_shootout",
        "home_pen_score", "away_pen_score")
    assert rows(result) == [
        (1, "Cote d'Azur vs Bees", "Cote d'Azur", 11, 1, 2, 1),
        (2, "Ants vs Bees", "Draw", -1, 0, 0, 0),
        (3, "Ants vs Bees", "Draw", -1, 0, 0, 0),
        (4, "Ants vs Bees", "Bees", 2, 0, 0, 0),
        (5, "Ants vs Bees", "Bees", 2, 0, 0, 0),
        (6, "Ants vs Bees", "Bees", 22, 1, 1, 1),
    ]


def test_results_keep_fan_out_places_and_empty_competitions(spark):
    matches = silver.snapshot(match_frame(spark, [
        (1, "Ants", "Bees", 2, 1, "Final"),
        (2, "Cats", "Dogs", 1, 2, "3rd Place Final"),
        (3, "Ants", "Eels", 0, 0, "Regular Season"),
        (4, "Fish", "Eels", 0, 1, "League Stage"),
    ]), silver.match_columns()).withColumns({
        "home_team_id": F.hash("home_team").cast("long"), "away_team_id": F.hash("away_team").cast("long"),
        "winning_team_id": F.when(F.col("winning_team") == "Draw", F.lit(-1)).otherwise(
            F.hash("winning_team")).cast("long"),
    })
    competitions = align(spark.createDataFrame(
        [(1, 7, "Land", "Cup", "2018"), (9, 9, "Void", "Cup", "2018/2019")],
        "competition_id long, season_id long, country_name string, competition_name string, season_name string",
    ), s.COMPETITIONS)
    grain = silver.competition_matches(competitions, matches)
    result = gold.combined_results(grain).select(
        "competition_id", "team_name", "matches_played", "wins", "draw", "losses",
        "stage_reached", "max_competition_stage_ranking")
    assert rows(result) == [
        (1, "Ants", 2, 1, 1, 0, "1st Place", 14),
        (1, "Bees", 1, 0, 0, 1, "2nd Place", 13),
        (1, "Cats", 1, 0, 0, 1, "4th Place", 10),
        (1, "Dogs", 1, 1, 0, 0, "3rd Place", 12),
        (1, "Eels", 2, 1, 1, 0, "League Stage", 0),   # two names share rank 0
        (1, "Eels", 2, 1, 1, 0, "Regular Season", 0),
        (1, "Fish", 1, 0, 0, 1, "League Stage", 0),
        (1, "Fish", 1, 0, 0, 1, "Regular Season", 0),
        (9, None, 0, 0, 0, 0, None, None),
    ]
    # the event grain gives the same rows as the match grain
    doubled = grain.unionByName(grain)
    assert rows(gold.combined_results(doubled)) == rows(gold.combined_results(grain))
    assert gold.combined_matches(doubled).count() == gold.combined_matches(grain).count() == 5


def test_durations(spark):
    half = "Half End"
    events = event_frame(spark, [
        (1, half, 1, 46, 5), (1, half, 1, 45, 59), (1, half, 2, 93, 1), (1, "Pass", 2, 99, 0),
        (2, half, 1, 45, 0), (2, half, 2, 90, 0), (2, half, 3, 105, 9), (2, half, 4, 121, 7),
        (3, half, 1, 45, 0), (3, half, 2, 90, 10), (3, half, 3, 105, 1), (3, half, 5, 130, 0),
        (4, half, 2, 99, 0), (4, half, 2, 100, 0), (4, half, 1, 45, None),
    ], "match_id long, type string, period long, minute long, second long")
    result = gold.match_duration_lookup(events).select(
        "match_id", "h1_end", "h1_duration_seconds", "h2_end", "et1_start", "et1_end", "et2_end",
        "total_match_duration_seconds", "game_end")
    assert rows(result) == [
        (1, "46:05", 2765, "93:01", None, None, None, 2765 + 2881, "93:01"),
        (2, "45:00", 2700, "90:00", "90:00", "105:09", "121:07", 2700 * 2 + 909 + 967, "121:07"),
        (3, "45:00", 2700, "90:10", "90:00", "105:01", None, 2700 + 2710 + 901, "90:10"),
        (4, "45:00", None, "99:00", None, None, None, 3300, "99:00"),  # largest text, largest seconds
    ]


def test_pass_geometry(spark):
    df = spark.createDataFrame([
        (None, None), (0.0, "[0.0, 1.0]"), (math.pi / 2 - 1e-9, "[39.9, 1]"),
        (math.pi / 2 + 1e-9, "[40, 1]"), (math.pi, "[79.9, 1, 3]"), (0.0, "[80.0,2]"),
        (0.0, "[-1.0, 5.0]"), (0.0, "null"), (0.0, ""), (0.0, "[5]"), (0.0, "[a, b]"),
    ], "angle double, place string")
    x = px.coordinate(F.col("place"), 0)
    found = [tuple(r) for r in df.select(
        px.direction(F.col("angle")), x, px.coordinate(F.col("place"), 1), px.third_name(x),
        px.third_rank(x)).collect()]
    assert found == [
        ("Lateral", None, None, None, None),
        ("Forward", 0.0, 1.0, "Defensive 3rd", 3.0),
        ("Forward", 39.9, 1.0, "Defensive 3rd", 3.0),
        ("Backward", 40.0, 1.0, "Middle 3rd", 2.0),
        ("Backward", 79.9, 1.0, "Middle 3rd", 2.0),
        ("Forward", 80.0, 2.0, "Final 3rd", 1.0),
        ("Forward", -1.0, 5.0, "-1.0", -1.0),
        *[("Forward", None, None, None, None)] * 4,
    ]


def test_player_lookup_order(spark):
    lineups = spark.createDataFrame([
        (1, "Bobby", "Robert"), (1, "Bob", "Robert"), (1, "Bob", "Rob"),
        (2, None, "Zed"), (2, "Z", "Zed"),
        (3, "Ab", "Xx"), (3, "Aa", "Xx"),
        (None, "No", "Id"),
    ], "player_id long, player_nickname string, player_name string")
    assert rows(gold.player_lookup(lineups)) == [(None, "No"), (1, "Bob"), (2, None), (3, "Aa")]


def test_attach_detail_equals_left_join_on_a_hot_key(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2"), (3, "c"), (None, "n")], "k long, p string")
    details = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 3 = 1 THEN 2 ELSE id + 10 END AS k", "id AS d")
    details = details.unionByName(spark.createDataFrame([(None, -1)], "k long, d long"))
    expected = rows(parents.join(details, "k", "left").select("k", "p", "d"))
    for strategy in (None, "broadcast", "shuffle_hash", "merge"):
        assert rows(joins.attach_detail(parents, details, ["k"], strategy)) == expected


def test_lookup_is_broadcast_only_below_the_measured_limit(spark):
    table = spark.range(100).selectExpr("id AS k", "repeat('x', 10) AS v")
    assert joins.measured_bytes(table) == 100 * (8 + 8 + 8 + 16)  # null bits, two slots, padded text
    assert joins.strategy_for(table, 4000) == "broadcast"
    assert joins.strategy_for(table, 3999) is None  # left to adaptive execution


def test_lookups_that_may_not_multiply(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    table = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (2, "c", None), (2, "c", None)], "k int, name string, n int")
    assert joins.lookup(facts, table, ["k"]).count() == 5
    picked = joins.lookup(facts, table, ["k"], "first")
    assert rows(picked.select("k", "v", "name", "n")) == [(None, "z", None, None), (1, "x", "a", 2), (2, "y", "c", None)]
    assert rows(joins.one_row_each(table.filter("k = 2"), ["k"])) == [(2, "c", None)]
    with pytest.raises(Exception, match=r"several rows for \(k\) = \(1\)"):
        joins.lookup(facts, table, ["k"], "raise").select("v", "name").collect()
    with pytest.raises(ValueError):
        joins.lookup(facts, table, ["k"], "some")


def test_broken_lines_are_kept_aside(spark, tmp_path):
    declared = s.contract("""
        bigint  k
        string  v
    """)
    (tmp_path / "a.json").write_text('{"k": "1", "v": "a"}\n{"k": 2, "v"\n{"v": "c"}\n{"k": "x", "v": "d"}\n\n[1]\n')
    kept, rejected = readers.read_checked(spark, str(tmp_path / "a.json"), declared, "json", ["k"])
    assert rows(kept) == [("1", "a")]
    got = rows(rejected.select("reason", "record"))
    assert [r for r, _ in got].count("without k") == 2 and ("unreadable", '{"k": 2, "v"') in got
    assert all(path.endswith("a.json") for path, in rows(rejected.select("source_file")))
    (tmp_path / "b.csv").write_text("k,v\n1,a\n2\n3,c,extra\n,d\n")
    kept, rejected = readers.read_checked(spark, str(tmp_path / "b.csv"), declared, "csv", ["k"])
    assert rows(kept.select("k")) == [("1",)] and rows(rejected.select("reason")) == [("unreadable",)] * 2 + [("without k",)]
