import threading
from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from matchlake import schemas as s
from matchlake.operators import filters, history
from matchlake.operators.shaping import align, version_clock
from matchlake.plans import bronze
from matchlake.plans.bronze import Sources, run_bronze
from matchlake.plans.pipeline import run_gold, run_silver
from matchlake.sources import tables, versions

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
ROW = "k long, scope long, v string, updated timestamp_ntz"
DECLARED = s.contract("""
    bigint     k scope
    string     v
    timestamp  updated data_valid_from_utc data_valid_to_utc
""")


def day(n):
    return datetime(2023, 5, n)


def frame(spark, data):
    return spark.createDataFrame(data, ROW)


def test_newer_rows(spark):
    first = frame(spark, [(1, 1, "a", day(5)), (2, 1, "b", None), (3, 2, "c", day(9))])
    again = frame(spark, [(1, 1, "a", day(5)), (2, 1, "n", None), (4, 1, "d", day(6)), (5, 3, "e", None),
                          (3, 2, "c", day(8))])
    assert history.newer_rows(first, None, "updated").count() == 3
    assert history.newer_rows(first, first.limit(0), "updated").count() == 3
    assert history.newer_rows(again, first, "updated").isEmpty()
    scoped = history.newer_rows(again, first, "updated", ["scope"]).select("k")
    assert rows(scoped) == [(4,), (5,)]


def test_upsert_closes_open_versions_only(spark):
    loaded = history.upsert_versions(None, frame(spark, [(1, 1, "a", day(1)), (2, 1, "b", day(1))]), ["k"], T1)
    second = history.upsert_versions(loaded, frame(spark, [(1, 1, "a2", day(2))]), ["k"], T2)
    batch = frame(spark, [(1, 1, "a3", day(3)), (1, 1, "a4", day(4)), (9, 1, "z", day(4))])
    third = history.upsert_versions(second, batch, ["k"], T3, "updated")
    ends = {T2: version_clock(T2)[1], T3: version_clock(T3)[1]}
    assert rows(third.select("k", "v", s.VALID_FROM, s.VALID_TO)) == [
        (1, "a", T1, ends[T2]), (1, "a2", T2, ends[T3]), (1, "a4", T3, None),
        (2, "b", T1, None), (9, "z", T3, None)]
    restamped = history.upsert_versions(second, batch, ["k"], T3, "updated", restamp=True)
    closed = restamped.filter("k = 1 AND data_valid_to_utc IS NOT NULL").select("v", s.VALID_TO)
    assert rows(closed) == [("a", ends[T3]), ("a2", ends[T3])]
    assert history.duplicate_keys(history.current_versions(third), ["k"]).isEmpty()


def test_stored_history_equals_the_dataframe_form(spark):
    tables.create_layer(spark, "hist")
    batches = [
        (T1, frame(spark, [(k, k % 3, "a", day(1)) for k in range(40)])),
        (T2, frame(spark, [(k, k % 3, "b", day(2)) for k in range(0, 40, 7)] + [(99, 0, "n", day(2))])),
        (T3, frame(spark, [(k, k % 3, "c", day(3)) for k in range(0, 40, 5)])),
    ]
    expected = None
    for now, batch in batches:
        expected = history.upsert_versions(expected, batch, ["k"], now, "updated")
        for _ in range(2):  # repeating a load changes nothing
            versions.load_versions(spark, "hist.t", batch, DECLARED, ["k"], ["scope"], now, "updated")
        stored = versions.read_history(spark, "hist.t", DECLARED)
        assert rows(stored) == rows(align(expected, DECLARED))
    current = versions.read_history(spark, "hist.t", DECLARED).filter(filters.is_current())
    # closed versions are pruned as partitions: no file of theirs is read
    assert current.count() == 41
    assert not any("data_valid_to_utc=20" in path for path in current.inputFiles())
    assert any("data_valid_to_utc=20" in path for path in versions.read_history(spark, "hist.t", DECLARED).inputFiles())
    # a failed first attempt and its repeat: rows closed by the first part stay closed
    late = frame(spark, [(1, 1, "d", day(4))])
    now = datetime(2024, 4, 1)
    versions.load_versions(spark, "hist.t", late, DECLARED, ["k"], ["scope"], now)
    more = frame(spark, [(1, 1, "d", day(4)), (2, 2, "d", day(4))])
    versions.load_versions(spark, "hist.t", more, DECLARED, ["k"], ["scope"], now)
    closed_at = version_clock(now)[1]
    closed = versions.read_history(spark, "hist.t", DECLARED).filter(F.col(s.VALID_TO) == F.lit(closed_at))
    assert rows(closed.select("k", "v")) == [(1, "a"), (2, "a")]


def test_null_keys_are_closed_and_repeats_change_nothing(spark):
    tables.create_layer(spark, "nul")
    keys = ["k", "scope"]
    batch = frame(spark, [(1, None, "a", day(1)), (1, 5, "a", day(1)), (None, None, "b", day(1))])
    for now, v in ((T1, "x"), (T2, "y")):
        for _ in range(3):
            versions.load_versions(spark, "nul.t", batch.withColumn("v", F.lit(v)), DECLARED, keys, ["k"], now)
    stored = rows(versions.read_history(spark, "nul.t", DECLARED).select("k", "scope", "v", s.VALID_TO))
    closed = version_clock(T2)[1]
    assert sorted(stored, key=str) == sorted(
        [(k, c, v, e) for k, c in ((1, None), (1, 5), (None, None)) for v, e in (("x", closed), ("y", None))], key=str)
    merged = history.upsert_versions(history.upsert_versions(None, batch, keys, T1), batch, keys, T2)
    assert history.current_versions(merged).count() == 3


def files(spark, table):
    listed = spark.table(table).select("_metadata.file_path", "_metadata.file_modification_time").distinct()
    return {tuple(r) for r in listed.collect()}


def test_a_load_leaves_other_seasons_alone(spark):
    tables.create_layer(spark, "sls")
    batch = frame(spark, [(k, k % 4, "a", day(1)) for k in range(40)])
    versions.load_versions(spark, "sls.t", batch, DECLARED, ["k"], ["scope"], T1)
    before = files(spark, "sls.t_rows")
    versions.load_versions(spark, "sls.t", frame(spark, [(4, 0, "b", day(2))]), DECLARED, ["k"], ["scope"], T2)
    after = files(spark, "sls.t_rows")
    assert all("/slice=0/" in path for path, _ in (before | after) - (before & after))
    assert len(before & after) == 3
    assert spark.table("sls.t").filter(filters.is_current()).count() == 40
    assert spark.table("sls.t").count() == 41


def test_a_stopped_load_changes_nothing_and_is_repeated(spark, monkeypatch):
    tables.create_layer(spark, "hlf")
    versions.load_versions(spark, "hlf.t", frame(spark, [(1, 1, "a", day(1)), (2, 1, "a", day(1))]), DECLARED, ["k"], ["scope"], T1)
    first = rows(spark.table("hlf.t"))
    again = frame(spark, [(1, 1, "b", day(2))])
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            versions.load_versions(spark, "hlf.t", again, DECLARED, ["k"], ["scope"], T2)
    assert rows(spark.table("hlf.t")) == first
    assert rows(versions.read_history(spark, "hlf.t", DECLARED)) == first
    versions.load_versions(spark, "hlf.t", again, DECLARED, ["k"], ["scope"], T2)
    assert rows(spark.table("hlf.t").select("k", "v", s.VALID_FROM, s.VALID_TO)) == [
        (1, "a", T1, version_clock(T2)[1]), (1, "b", T2, None), (2, "a", T1, None)]


def sources(spark, score: int, updated: datetime) -> Sources:
    competitions = spark.createDataFrame(
        [(43, 1, "2018", updated), (43, 2, "2016", updated), (43, 3, "2018/2019", updated), (7, 1, "2020", updated)],
        "competition_id long, season_id long, season_name string, match_updated timestamp_ntz")
    matches = spark.createDataFrame(
        [(1, 43, 1, score, updated), (2, 43, 1, 0, day(1)), (3, 43, 2, 0, updated), (4, 7, 1, 0, updated)],
        "match_id long, competition_id long, season_id long, home_score long, last_updated timestamp_ntz"
    ).withColumns({"away_score": F.lit(0), "home_team": F.lit("H"), "away_team": F.lit("A"),
                   "home_team_id": F.lit(1), "away_team_id": F.lit(2), "competition_stage": F.lit("Final")})
    events = spark.createDataFrame(
        [(f"e{m}{i}", m, "Pass", "N''Golo", 5) for m in (1, 2, 3, 4) for i in range(3)],
        "id string, match_id long, type string, player string, player_id long")
    lineups = spark.createDataFrame(
        [(m, "H", 5, "N'Golo", None, [], []) for m in (1, 2, 3, 4)],
        "match_id long, team string, player_id long, player_name string, player_nickname string, "
        f"cards {s.PLAYER_SOURCE['cards'].dataType.simpleString()}, "
        f"positions {s.PLAYER_SOURCE['positions'].dataType.simpleString()}")
    return Sources(competitions, matches, events, lineups)


def counts(spark, layer):
    return {t: (spark.table(f"{layer}.{t}").count(),
                spark.table(f"{layer}.{t}").filter(filters.is_current()).count())
            for t in ("competitions", "matches", "events", "lineups")}


def test_a_load_that_failed_half_way_is_made_up_for_at_a_later_time(spark, monkeypatch):
    given = sources(spark, 0, day(2))
    load = bronze.load_versions
    for failing in ("lineups", "matches", "competitions"):
        layer = f"fail_{failing}"
        with monkeypatch.context() as patch:
            patch.setattr(bronze, "load_versions", lambda sp, t, *a: 1 / 0 if t.endswith(failing) else load(sp, t, *a))
            with pytest.raises(ZeroDivisionError):
                run_bronze(spark, given, T1, layer, [43], min_season="2018")
        run_bronze(spark, given, T2, layer, [43], min_season="2018")
        assert {t: c[1] for t, c in counts(spark, layer).items()} == {
            "competitions": 2, "matches": 2, "events": 6, "lineups": 2}


def test_scope_without_a_list_keeps_its_season_filters(spark):
    given = sources(spark, 0, day(2)).competitions
    names = lambda **k: rows(given.filter(filters.in_scope(None, **k)).select("season_name"))
    assert names(min_season="2018") == [("2018",), ("2018/2019",), ("2020",)]
    assert names(season=2) == [("2016",)]


def test_only_the_key_is_cleaned_before_rows_are_dropped(spark):
    raw = spark.createDataFrame([("e1", "1", "5"), ("e2", "7", "x")], "id string, match_id string, minute string")
    changed = spark.createDataFrame([(1, 43, 1)], "match_id long, competition_id long, season_id long")
    picked = bronze.pick_events(raw, changed)
    assert rows(picked.select("id", "match_id", "minute")) == [("e1", 1, 5)]
    plan = picked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("minute") < plan.index("Join LeftSemi")  # the cleaning projection stands above the join


def test_two_loads_through_all_layers(spark):
    def load(now, score, updated):
        run_bronze(spark, sources(spark, score, updated), now, "brz", [43], min_season="2018")

    load(T1, 0, day(2))
    first = {"competitions": (2, 2), "matches": (2, 2), "events": (6, 6), "lineups": (2, 2)}
    assert counts(spark, "brz") == first
    load(T2, 0, day(2))  # nothing newer
    assert counts(spark, "brz") == first
    load(T3, 4, day(8))  # match 1 changed, match 2 did not
    assert counts(spark, "brz") == {
        "competitions": (4, 2), "matches": (3, 2), "events": (9, 6), "lineups": (3, 2)}
    load(T3, 4, day(8))  # repeated load
    assert counts(spark, "brz")["events"] == (9, 6)

    run_silver(spark, "brz", "slv", views=["events"])
    run_gold(spark, "slv", "gld")
    passes = spark.table("gld.combined_passes")
    assert rows(passes.select("match_id", "player", "player_nickname", "winning_team").distinct()) == [
        (1, "N'Golo", "N'Golo", "H"), (2, "N'Golo", "N'Golo", "Draw")]
    # both teams played both matches: one won by H, one drawn
    results = spark.table("gld.combined_results").filter("team_name IS NOT NULL")
    assert rows(results.select("team_name", "wins", "draw", "losses", "matches_played").distinct()) == [
        ("A", 0, 1, 1, 2), ("H", 1, 1, 0, 2)]
    assert spark.table("slv.combined").count() == 6 + 1  # one competition without matches


def test_the_histories_of_a_load_are_written_at_the_same_time(spark, monkeypatch):
    """All four wait for one another, and they are committed children first."""
    load, commit, barrier, order = bronze.load_versions, versions.commit, threading.Barrier(4), []
    monkeypatch.setattr(bronze, "load_versions", lambda *a: (barrier.wait(60), load(*a))[1])
    monkeypatch.setattr(versions, "commit", lambda sp, t, *a: (order.append(t), commit(sp, t, *a)))
    run_bronze(spark, sources(spark, 0, day(2)), T1, "atonce", [43], min_season="2018")
    assert order == [f"atonce.{t}" for t in ("events", "lineups", "matches", "competitions")]
    assert {t: c[1] for t, c in counts(spark, "atonce").items()} == {"competitions": 2, "matches": 2, "events": 6, "lineups": 2}


def test_a_written_load_counts_once_it_is_finished(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS lat")
    batch = frame(spark, [(1, 1, "a", day(1)), (2, 1, "a", day(1))])
    finish = versions.load_versions(spark, "lat.t", batch, DECLARED, ["k"], ["scope"], T1, at_once=False)
    assert not versions.committed(spark, "lat.t").newest
    finish()
    assert spark.table("lat.t").count() == 2


def test_views_of_a_load_are_published_at_the_same_time(spark, monkeypatch):
    """After all commits; all four wait for one another."""
    publish, commit, barrier, order = versions.publish, versions.commit, threading.Barrier(4), []
    monkeypatch.setattr(versions, "publish", lambda sp, t, *a: (barrier.wait(60), order.append("view"), publish(sp, t, *a)))
    monkeypatch.setattr(versions, "commit", lambda sp, t, *a: (order.append("commit"), commit(sp, t, *a)))
    run_bronze(spark, sources(spark, 0, day(2)), T1, "views", [43], min_season="2018")
    assert order == ["commit"] * 4 + ["view"] * 4
    assert spark.table("views.events").count() == 6


def test_a_commit_that_fails_leaves_the_views_of_the_commits_before_it_up_to_date(spark, monkeypatch):
    commit = versions.commit
    monkeypatch.setattr(versions, "commit", lambda sp, t, *a: 1 / 0 if t.endswith("matches") else commit(sp, t, *a))
    with pytest.raises(ZeroDivisionError):
        run_bronze(spark, sources(spark, 0, day(2)), T1, "halfway", [43], min_season="2018")
    assert (spark.table("halfway.events").count(), spark.table("halfway.lineups").count()) == (6, 2)
    assert not spark.catalog.tableExists("halfway.matches")
