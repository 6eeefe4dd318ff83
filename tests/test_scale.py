"""Plans and files of what grows with the input: what is broadcast, shuffled, sorted and written."""

import glob
import re
from contextlib import redirect_stdout
from datetime import datetime
from io import StringIO

import pyarrow.parquet as pq

from checkbed import bridge
from checkbed.bridge import Bridge
from checkbed.queries_marts import combine
from checkbed.registry import QUERIES
from matchlake import schemas as s
from matchlake.operators import joins
from matchlake.plans import bronze, gold, silver
from matchlake.sources import versions

_LINES = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_tax double,
    l_discount double, l_returnflag string, l_linestatus string"""
_ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"


def plan_of(df) -> str:
    out = StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def driver_tables(spark, path) -> str:
    """Two orders with three lines each, and the nations and regions they refer to."""
    lines = [(o, 7 * o + n, 3 * o + n, n, 4.0 * n, 0.02 * n, 0.01 * n, "R" if n == 2 else "N", "F") for o in (1, 2) for n in (1, 2, 3)]
    frames = {
        "lineitem": spark.createDataFrame(lines, _LINES),
        "orders": spark.createDataFrame([(o, o, datetime(1995, 1, o)) for o in (1, 2)], _ORDERS),
        "nation": spark.range(25).selectExpr("int(id) n_nationkey", "'N' || id n_name", "int(id % 5) n_regionkey"),
        "region": spark.range(5).selectExpr("int(id) r_regionkey", "'R' || id r_name"),
    }
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_a_lookup_beyond_the_limit_is_not_broadcast_on_an_estimate(spark):
    facts, table = spark.range(50).toDF("k"), spark.range(100).selectExpr("id AS k", "id AS v")
    assert "BroadcastHashJoin" in plan_of(joins.lookup(facts, joins.broadcast_if_small(table), ["k"]))
    plan = plan_of(joins.lookup(facts, joins.broadcast_if_small(table, 10), ["k"]))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_parents_of_a_load_are_measured(spark, monkeypatch):
    events = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "id string, match_id bigint")
    matches = spark.createDataFrame([(1, 0, 0), (1, 0, 0), (3, 0, 0)], "match_id bigint, competition_id bigint, season_id bigint")
    seen = []
    monkeypatch.setattr(joins, "measured_bytes", lambda df: seen.append(df.columns) or joins.BROADCAST_BYTES + 1)
    tagged = bronze.tag_seasons(bronze.pick_events(events, matches), matches)
    assert len(seen) == 2 and "Broadcast" not in plan_of(tagged)
    assert [r["id"] for r in tagged.collect()] == ["a"]


def test_drawn_matches_are_not_broadcast(spark):
    matches = spark.range(3).selectExpr(
        "id AS match_id", "'h' AS home_team", "'a' AS away_team", "1L AS home_team_id", "2L AS away_team_id",
        "'Draw' AS winning_team", "5 AS competition_stage_ranking")
    events = spark.createDataFrame([(1, "h", 1, 5, "Shot", "Goal")],
                                   "match_id bigint, team string, team_id bigint, period bigint, type string, shot_outcome string")
    results = silver.shootout_results(matches, events)
    assert "Broadcast" not in plan_of(results)
    assert [(r["match_id"], r["shootout_winner"], r["home_goals"]) for r in results.collect()] == [(1, "h", 1)]


def test_half_ends_are_dealt_before_they_are_sorted(spark):
    events = spark.createDataFrame([(1, "Half End", 1, 46, 5)], "match_id bigint, type string, period bigint, minute bigint, second bigint")
    lookup = gold.match_duration_lookup(events)
    plan = plan_of(lookup)
    assert plan.count("Exchange") == 1 and plan.rindex("Exchange") > plan.rindex("SortAggregate")
    assert lookup.first()["h1_end"] == "46:05"


def test_lineups_shuffle_their_lines_once(spark, tmp_path):
    b = Bridge(spark, driver_tables(spark, tmp_path))
    players = b.stint_kinds.groupBy("match_id", "player_id").count()
    assert plan_of(players).count("Exchange hashpartitioning") == 1
    assert b.lineups.count() == players.count()


def test_columns_without_a_rule_are_not_written(spark, tmp_path):
    b = Bridge(spark, driver_tables(spark, tmp_path))
    for frame, declared in ((b.events, s.EVENTS_SOURCE), (b.matches, s.MATCHES_SOURCE), (b.events_by_type, s.EVENTS_SOURCE)):
        assert frame.dtypes == [(f.name, f.dataType.simpleString()) for f in declared.fields]
        written = glob.glob(frame.inputFiles()[0].removeprefix("file://"))
        assert len(pq.ParquetFile(written[0]).schema_arrow.names) < len(declared.names) / 1.5
    assert b.events.count() == b.events_by_type.count() == 10
    assert b.events.filter("shot_type IS NOT NULL").isEmpty()


def test_a_batch_without_doubled_keys_is_told_by_its_keys(spark):
    def batch(*keys):
        return spark.createDataFrame([(k, "x") for k in keys], "id string, v string")

    assert not versions.sent_twice(batch("a", "b"), ["id"])
    assert versions.sent_twice(batch("a", "b", "a"), ["id"])
    assert versions.sent_twice(batch("a", None), ["id"])


def test_wide_rows_are_not_copied_in_one_long_generated_loop(spark, tmp_path):
    """Loading events takes loops that the JIT is slow to optimise: those beyond the limit run as small methods instead."""
    events, matches = Bridge(spark, driver_tables(spark, tmp_path)).events, spark.range(3).toDF("match_id")
    out = StringIO()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the code is made while the query runs
    try:
        with redirect_stdout(out):
            bronze.pick_events(events, matches).explain("codegen")
            events.sortWithinPartitions("type").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    loops = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    limit = int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
    assert any(limit < n < 8000 for n in loops), loops


def test_few_columns_of_events_are_joined_without_storing_events(spark, tmp_path):
    path = driver_tables(spark, tmp_path)
    found = QUERIES["J2_to_events"](spark, path)
    assert not [key for key in bridge._STORED if key[1:] == (path, "events")]
    b = Bridge(spark, path)
    whole = combine(b).select(*found.columns)
    assert found.count() == 6 + 4 + 1  # lines, half ends, the competition without matches
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()
