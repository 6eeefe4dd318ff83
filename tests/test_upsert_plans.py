"""Upserts and layers of the checks: wide rows are shuffled, and layers written, only where a result needs it."""

from datetime import datetime

from checkbed import bridge
from checkbed.bridge import Bridge
from helpers import rows
from matchlake.operators import history, joins
from test_scale import driver_tables, plan_of

_ROWS = "id string, v string, data_valid_from_utc timestamp_ntz, data_valid_to_utc timestamp_ntz"


def held(spark, *ids):
    return spark.createDataFrame([(i, "old", datetime(2024, 1, 1), None) for i in ids], _ROWS)


def sent(spark, *ids):
    return spark.createDataFrame([(i, "new") for i in ids], "id string, v string")


def versions(df):
    return rows(df.selectExpr("id", "v", "data_valid_to_utc IS NULL"))


def test_a_batch_that_sends_each_key_once_is_not_ranked(spark):
    once = history.upsert_versions(held(spark, "a", "b"), sent(spark, "a", "c"), ["id"], datetime(2024, 2, 1))
    assert "Window" not in plan_of(once)
    assert versions(once) == [("a", "new", True), ("a", "old", False), ("b", "old", True), ("c", "new", True)]


def test_a_key_sent_twice_or_null_still_opens_one_version(spark):
    twice = history.upsert_versions(held(spark, "a", None), sent(spark, "a", "a", None, None), ["id"], datetime(2024, 2, 1))
    assert versions(twice) == [(None, "new", True), (None, "old", False), ("a", "new", True), ("a", "old", False)]


def test_incoming_keys_are_measured_before_the_history_is_joined(spark, monkeypatch):
    few = history.close_versions(held(spark, "a", "b"), sent(spark, "a"), ["id"], datetime(2024, 2, 1))
    assert "BroadcastHashJoin" in plan_of(few)
    monkeypatch.setattr(joins, "measured_bytes", lambda df: joins.BROADCAST_BYTES + 1)
    many = history.close_versions(held(spark, "a", "b"), sent(spark, "a"), ["id"], datetime(2024, 2, 1))
    assert "SortMergeJoin" in plan_of(many) and "Broadcast" not in plan_of(many)
    assert versions(few) == versions(many) == [("a", "old", False), ("b", "old", True)]


def test_shootouts_and_names_take_no_stored_layer(spark, tmp_path):
    b = Bridge(spark, driver_tables(spark, tmp_path))
    lean = rows(b.silver_matches), rows(b.players)
    built = {name for _, folder, name in bridge._STORED if folder == b.sf_dir}
    assert {"silver_matches", "players"} <= built and not {"events", "bronze_lineups"} & built
    whole = bridge.silver.silver_matches(b.bronze_matches, b.bronze_events), bridge.gold.player_lookup(b.bronze_lineups)
    assert lean == tuple(map(rows, whole)) and lean[0] and lean[1]
