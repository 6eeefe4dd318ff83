"""What is shuffled and written: wide rows stay where they are read if their key alone says what becomes of them."""

import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checkbed import bridge, queries_load, queries_marts  # noqa: F401  (register their queries)
from checkbed.registry import QUERIES
from matchlake import schemas as s
from matchlake.operators import history, joins
from matchlake.plans import bronze
from matchlake.session import scratch_root
from matchlake.sources import readers, seasons, tables, versions

from helpers import rows
from test_scale import driver_tables, plan_of

KEYS = [None, -130, -64, -1, 0, 1, 63, 64, 5, 5, 1 << 40]


def keyed(spark, keys, kind="bigint"):
    return spark.createDataFrame([(k, f"v{i}") for i, k in enumerate(keys)], f"k {kind}, v string")


@pytest.mark.parametrize("present", [True, False])
def test_ids_are_looked_up_in_words_as_in_a_list(spark, present):
    facts, ids = keyed(spark, [*KEYS, 2, -2, 65, (1 << 40) + 1]), keyed(spark, KEYS).select("k")
    found = joins.with_ids(facts, F.col("k"), ids, present)
    assert rows(found) == rows(facts.join(ids, "k", "left_semi" if present else "left_anti"))
    merged = joins.with_ids(facts, F.col("k"), ids, present, limit=0)
    assert rows(merged) == rows(found) and "Broadcast" not in plan_of(merged)


def test_ids_too_many_for_a_list_are_broadcast_as_words(spark):
    facts, ids = spark.range(50).toDF("k"), spark.range(6400).toDF("k")
    limit = joins.measured_bytes(ids) // 10
    assert "BroadcastHashJoin" in plan_of(joins.with_ids(facts, F.col("k"), ids, limit=limit))
    # text and fractions are compared as they are
    texts = keyed(spark, ["1", "x"], "string")
    assert rows(joins.with_ids(texts, F.col("k"), texts.select("k").limit(1))) == [("1", "v0")]
    halves = keyed(spark, [1.0, 1.5], "double")
    assert rows(joins.with_ids(halves, F.col("k"), spark.range(3))) == [(1.0, "v0")]


def test_events_of_matches_are_read_without_an_exchange_of_events(spark, tmp_path):
    spark.sql("SELECT '7' AS match_id, 'a' AS id UNION ALL SELECT '9', 'b'").write.json(f"{tmp_path}/events")
    found = readers.read_events(spark, f"{tmp_path}/events", "json", spark.createDataFrame([(7,), (8,)], "match_id bigint"))
    assert "SortMergeJoin" not in plan_of(found) and [r["id"] for r in found.collect()] == ["a"]


def test_open_versions_without_an_incoming_key_are_not_shuffled(spark, monkeypatch):
    held = spark.range(4000).selectExpr("id AS k", "CAST(id AS STRING) AS v", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS data_valid_from_utc",
                                        "CAST(NULL AS TIMESTAMP_NTZ) AS data_valid_to_utc")
    held = held.unionByName(held.limit(1).withColumn("k", F.lit(None).cast("bigint")))
    sent = spark.createDataFrame([(None,), (3,), (7777,)], "k bigint")
    maybe, never = joins.parted_by_keys(held, ["k"], sent)
    assert maybe.count() < 1000 and maybe.count() + never.count() == 4001
    assert rows(maybe.filter("k = 3 OR k IS NULL").select("k")) == [(None,), (3,)]
    monkeypatch.setattr(history, "sized_strategy", lambda _: "merge")
    called = []
    monkeypatch.setattr(history, "parted_by_keys", lambda *a: called.append(a) or joins.parted_by_keys(*a))
    closed = history.close_versions(held, sent, ["k"], datetime(2024, 2, 1))
    assert called and closed.count() == 4001
    assert rows(closed.filter(f"{s.VALID_TO} IS NOT NULL").select("k")) == [(None,), (3,)]


def test_keys_of_other_types_are_not_parted_by_hash(spark):
    assert joins.parted_by_keys(spark.range(3).toDF("k"), ["k"], spark.sql("SELECT 1 AS k")) is None
    assert joins.parted_by_keys(keyed(spark, [0.0], "double"), ["k"], keyed(spark, [-0.0], "double")) is None


def test_only_rows_of_doubled_keys_are_ranked(spark):
    batch = keyed(spark, [*range(2000), 5, None])
    doubled, rest = history.parted_by_doubled(batch, ["k"])
    assert doubled.count() < 700 and doubled.count() + rest.count() == 2002
    assert rows(doubled.filter("k = 5 OR k IS NULL").select("k")) == [(None,), (5,), (5,)]
    assert history.parted_by_doubled(keyed(spark, [1, 2]), ["k"])[0] is None


def test_rows_written_in_place_replace_their_seasons(spark):
    tables.create_layer(spark, "inplace")
    for value, only in ((1, [0, 1, 2]), (2, [1])):
        df = spark.range(30).selectExpr("id % 3 AS competition_id", "id % 3 AS season_id", f"{value} AS v").filter(F.col("season_id").isin(only))
        with seasons.only_written_partitions(spark), seasons.files_at_once(spark):
            seasons.replace_seasons(df, "inplace.t", in_place=True)
    assert rows(spark.table("inplace.t").groupBy("season_id", "v").count()) == [(0, 1, 10), (1, 2, 10), (2, 1, 10)]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


@pytest.mark.parametrize("name", ["S3_read_events", "T3_events_in_memory", "T7_silver_events", "T8_silver_combined", "T15_combined_passes",
                                  "T16_earlier_complete", "A9_matches_from_events"])
def test_events_are_not_stored_for_a_query_that_reads_them_once(spark, tmp_path, name):
    path = driver_tables(spark, tmp_path)
    QUERIES[name](spark, path)
    assert not [key for key in bridge._STORED if key[1:] in ((path, "events"), (path, "combined"))]


def test_batches_of_a_load_are_dropped_when_it_is_committed(spark):
    matches = spark.sql("SELECT 1L AS match_id, 0L AS competition_id, 0L AS season_id, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS last_updated")
    competitions = spark.sql("SELECT 0L AS competition_id, 0L AS season_id, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS match_updated")
    lineups = spark.createDataFrame([], s.LINEUPS_SOURCE.add("team", "string")).select("competition_id", "season_id", "match_id", "team").selectExpr(
        "*", "1L AS player_id", "'' AS player_name", "'' AS player_nickname", "1L AS jersey_number", "'' AS country",
        f"CAST(NULL AS array<{s.CARD.simpleString()}>) AS cards", f"CAST(NULL AS array<{s.STINT.simpleString()}>) AS positions")
    events = spark.sql("SELECT 'a' AS id, 1L AS match_id")
    before = set(glob.glob(f"{scratch_root(spark)}/matchlake/batch-*"))
    bronze.run_bronze(spark, bronze.Sources(competitions, matches, events, lineups), datetime(2024, 2, 1), "dropped_batches")
    assert set(glob.glob(f"{scratch_root(spark)}/matchlake/batch-*")) == before
    assert [r["id"] for r in versions.read_history(spark, "dropped_batches.events", s.EVENTS).collect()] == ["a"]


def test_files_are_packed_and_shuffles_start_with_small_partitions(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/t")
    assert glob.glob(f"{tmp_path}/t/*.zstd.parquet")
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) > 200
