"""Stored history and silver: what stays on disk, what is read, and what a load of one season touches."""

from datetime import datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from matchlake import schemas as s
from matchlake.operators import filters
from matchlake.operators.shaping import version_clock
from matchlake.plans import bronze, gold, silver
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


def load(spark, table, batch, now, newest=None, keys=("k",), **options):
    versions.load_versions(spark, table, batch, DECLARED, list(keys), ["scope"], now, newest, **options)


def partitions(spark, table):
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def test_loads_leave_one_set_of_open_files_and_a_view_of_the_same_length(spark):
    tables.create_layer(spark, "ret")
    load(spark, "ret.t", frame(spark, [(1, 1, "a", day(1)), (2, 2, "b", day(1))]), T1)
    lengths = []
    for i in range(1, 13):
        load(spark, "ret.t", frame(spark, [(1, 1, f"a{i}", day(1))]), T1 + timedelta(days=i))
        held = partitions(spark, "ret.t_rows")
        assert len([p for p in held if "__HIVE_DEFAULT" in p]) == 2
        assert len(held) == 2 + i
        assert len(partitions(spark, "ret.t_loads")) == 1
        lengths.append(len(spark.sql("SHOW CREATE TABLE ret.t").first()[0]))
    assert len(set(lengths)) == 1
    assert spark.table("ret.t").count() == 14
    assert rows(spark.table("ret.t").filter(filters.is_current()).select("k", "v")) == [(1, "a12"), (2, "b")]
    open_files = spark.table("ret.t_rows").filter("data_valid_to_utc IS NULL").select("_metadata.file_path").distinct()
    assert open_files.count() == 2


def test_kept_attempts_stay_for_readers(spark):
    tables.create_layer(spark, "kept")
    for i in range(4):
        load(spark, "kept.t", frame(spark, [(1, 1, f"a{i}", day(1))]), T1 + timedelta(days=i), keep=1)
    assert len([p for p in partitions(spark, "kept.t_rows") if "__HIVE_DEFAULT" in p]) == 2
    assert len(partitions(spark, "kept.t_loads")) == 2
    assert rows(spark.table("kept.t").filter(filters.is_current()).select("v")) == [("a3",)]


def test_a_stopped_attempt_is_removed_by_the_next_load(spark, monkeypatch):
    tables.create_layer(spark, "dead")
    load(spark, "dead.t", frame(spark, [(1, 1, "a", day(1))]), T1, "updated")
    clean = partitions(spark, "dead.t_rows")
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(spark, "dead.t", frame(spark, [(1, 1, "lost", day(9))]), T2, "updated")
    assert partitions(spark, "dead.t_rows") > clean
    marks = versions.watermarks(spark, "dead.t", "updated", ["scope"])
    assert rows(marks) == [(1, day(1))]  # the stopped load did not move it
    assert rows(spark.table("dead.t").select("v", s.VALID_TO)) == [("a", None)]
    load(spark, "dead.t", frame(spark, [(1, 1, "b", day(2))]), T3, "updated")
    assert rows(spark.table("dead.t").select("v", s.VALID_TO)) == [("a", version_clock(T3)[1]), ("b", None)]
    assert len(partitions(spark, "dead.t_rows")) == 2
    assert rows(versions.watermarks(spark, "dead.t", "updated", ["scope"])) == [(1, day(2))]


def test_a_key_sent_twice_opens_one_version(spark):
    tables.create_layer(spark, "dbl")
    doubled = frame(spark, [(1, 1, "x", day(1)), (1, 1, "y", day(1)), (1, 1, "x", day(1)), (2, 1, "z", day(1)),
                            (None, 1, "n", day(1)), (None, 1, "m", day(1)), (None, 1, "m", day(1))])
    for now in (T1, T2):
        load(spark, "dbl.t", doubled, now)
        now_open = spark.table("dbl.t").filter(filters.is_current())
        assert rows(now_open.groupBy("k").count()) == [(None, 2), (1, 1), (2, 1)]
    first = rows(now_open.filter("k = 1").select("v"))
    load(spark, "dbl.t", doubled.repartition(7), T3)
    assert rows(spark.table("dbl.t").filter("k = 1 AND data_valid_to_utc IS NULL").select("v")) == first


def test_doubled_open_keys_are_not_committed(spark, monkeypatch):
    tables.create_layer(spark, "chk")
    load(spark, "chk.t", frame(spark, [(1, 1, "a", day(1))]), T1)
    with monkeypatch.context() as patch:
        patch.setattr(versions, "one_per_key", lambda df, *_: df)
        with pytest.raises(versions.DoubledKeys, match="1"):
            load(spark, "chk.t", frame(spark, [(5, 1, "x", day(1)), (5, 1, "y", day(1))]), T2)
    assert rows(spark.table("chk.t").select("k", "v", s.VALID_TO)) == [(1, "a", None)]


def test_rows_of_a_slice_are_sorted_in_their_files(spark):
    tables.create_layer(spark, "srt")
    batch = frame(spark, [(k, k % 2, f"v{k * 7919 % 50:02d}", day(1)) for k in range(400)]).repartition(5)
    load(spark, "srt.t", batch, T1, cluster_by=["v", "k"])
    placed = spark.table("srt.t_rows").select("_metadata.file_path", "_metadata.row_index", "v", "k").collect()
    by_file = {}
    for r in sorted(placed, key=lambda r: (r[0], r[1])):
        by_file.setdefault(r[0], []).append((r.v, r.k))
    assert all(part == sorted(part) for part in by_file.values()) and sum(map(len, by_file.values())) == 400


# --- layers -------------------------------------------------------------------------------------


def sources(spark, score, updated, seasons=(1, 2, 3)):
    """Four matches a season, each with passes in several cases, shots and half ends. Season 1 has changed ``score`` and ``updated``."""
    def of(season, late, early):
        return late if season == 1 else early

    competitions = spark.createDataFrame(
        [(43, n, f"20{n}", of(n, updated, day(1))) for n in seasons], "competition_id long, season_id long, season_name string, match_updated timestamp_ntz")
    ids = [(n, 10 * n + m) for n in seasons for m in range(4)]
    matches = spark.createDataFrame(
        [(m, 43, n, of(n, score, 0), of(n, updated, day(1))) for n, m in ids],
        "match_id long, competition_id long, season_id long, home_score long, last_updated timestamp_ntz"
    ).withColumns({"away_score": F.lit(0), "home_team": F.lit("H"), "away_team": F.lit("A"), "home_team_id": F.lit(1),
                   "away_team_id": F.lit(2), "competition_stage": F.lit("Final")})
    kinds = ["Pass", "pass", "PASS", "Shot", "Half End", "Carry"]
    events = spark.createDataFrame(
        [(f"e{m}-{i}", m, kinds[i % 6], "P", 5, i % 2 + 1, 45, 0) for _, m in ids for i in range(60)],
        "id string, match_id long, type string, player string, player_id long, period long, minute long, second long")
    lineups = spark.createDataFrame(
        [(m, "H", 5, "P", None, [], []) for _, m in ids],
        "match_id long, team string, player_id long, player_name string, player_nickname string, "
        f"cards {s.PLAYER_SOURCE['cards'].dataType.simpleString()}, positions {s.PLAYER_SOURCE['positions'].dataType.simpleString()}")
    return Sources(competitions, matches, events, lineups)


def files(spark, table):
    return {r[0] for r in spark.table(table).select("_metadata.file_path").distinct().collect()}


SILVER = ("matches", "lineups", "competition_matches", "combined")


def test_a_load_of_one_season_leaves_the_files_of_the_others(spark):
    run_bronze(spark, sources(spark, 0, day(1)), T1, "isb", [43])
    assert len(run_silver(spark, "isb", "iss")) == 3
    before = {t: files(spark, f"iss.{t}") for t in SILVER}
    assert run_silver(spark, "isb", "iss") == set()  # nothing changed
    assert {t: files(spark, f"iss.{t}") for t in SILVER} == before
    run_bronze(spark, sources(spark, 4, day(8)), T2, "isb", [43])
    assert run_silver(spark, "isb", "iss") == {"43-1"}
    for t in SILVER:
        after = files(spark, f"iss.{t}")
        of_one = {f for f in before[t] if "season_id=1" in f}
        assert of_one and before[t] - of_one < after and not of_one & after
    whole = {t: rows(spark.table(f"iss.{t}")) for t in (*SILVER, "events", "competitions")}
    run_silver(spark, "isb", "isw", whole=True)
    assert whole == {t: rows(spark.table(f"isw.{t}").select(*spark.table(f"iss.{t}").columns)) for t in whole}
    assert rows(spark.table("iss.matches").select("season_id", "home_score").distinct()) == [(1, 4), (2, 0), (3, 0)]
    run_gold(spark, "iss", "isg")
    assert spark.table("isg.combined_passes").count() == 12 * 30


def test_snapshots_can_be_copies_too(spark):
    run_bronze(spark, sources(spark, 0, day(1)), T1, "cpb", [43])
    run_silver(spark, "cpb", "cps", views=())
    assert spark.table("cps.events").count() == 720 and spark.table("cps.competitions").count() == 3
    before = files(spark, "cps.events")
    run_bronze(spark, sources(spark, 4, day(8)), T2, "cpb", [43])
    run_silver(spark, "cpb", "cps", views=())
    after = files(spark, "cps.events")
    assert spark.table("cps.events").count() == 720 and {f for f in before - after} == {f for f in before if "slice=43-1" in f}


def scanned(df):
    """Rows that the scans of a finished query put out."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    assert found
    return found


def test_readers_of_one_type_skip_the_rest(spark):
    """Pages of 200 rows here, as a test has no row groups of 128 MB."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    before = {k: hadoop.get(k) for k in ("parquet.page.row.count.limit", "parquet.page.size.row.check.min")}
    hadoop.set("parquet.page.row.count.limit", "10")
    hadoop.set("parquet.page.size.row.check.min", "1")
    try:
        run_bronze(spark, sources(spark, 0, day(1)), T1, "skb", [43])
        run_silver(spark, "skb", "sks")
    finally:
        for k, v in before.items():
            hadoop.unset(k) if v is None else hadoop.set(k, v)
    combined = spark.table("sks.combined")
    passes = combined.filter(filters.is_pass(combined))
    assert "PushedFilters: [IsNotNull(type_folded), EqualTo(type_folded,pass)]" in passes._jdf.queryExecution().executedPlan().toString().replace("\\n", "")
    assert passes.count() == 360
    assert sum(scanned(passes.select("id"))) < 0.75 * combined.count()
    durations = gold.match_duration_lookup(spark.table("sks.events"))
    assert "EqualTo(type,Half End)" in durations._jdf.queryExecution().executedPlan().toString()
    assert durations.count() == 12
    assert sum(scanned(durations)) < 0.5 * combined.count()


def test_what_is_new_is_told_without_reading_the_rows(spark):
    given = sources(spark, 0, day(1))
    run_bronze(spark, given, T1, "wmb", [43])
    marks = versions.watermarks(spark, "wmb.matches", "last_updated", s.COMPETITION_KEY)
    assert rows(marks) == [(43, n, day(1)) for n in (1, 2, 3)]
    again = sources(spark, 1, day(3))
    new = bronze.pick_matches(again.matches, marks, again.competitions)
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    assert "matches_loads" in plan and "matches_rows" not in plan
    assert rows(new.select("match_id")) == [(10,), (11,), (12,), (13,)]


def test_doubled_events_in_a_load(spark):
    given = sources(spark, 0, day(1))
    twice = Sources(given.competitions, given.matches, given.events.unionAll(given.events.filter("match_id = 10").withColumn("player", F.lit("Q"))),
                    given.lineups.unionAll(given.lineups.filter("match_id = 10").withColumn("player_id", F.lit(None).cast("long"))))
    for now in (T1, T2):
        run_bronze(spark, twice, now, "deb", [43])
        events = spark.table("deb.events").filter(filters.is_current())
        assert events.count() == events.select("id").distinct().count() == 720
    assert spark.table("deb.lineups").filter("player_id IS NULL AND data_valid_to_utc IS NULL").count() == 1


def hot(spark, updated, score=0):
    """Match 10 has a third of all events, competition 99 no match."""
    given = sources(spark, score, updated)
    more = spark.range(300).selectExpr("concat('h', id) AS id", "10L AS match_id", "'Pass' AS type", "'P' AS player", "5L AS player_id",
                                       "1L AS period", "0L AS minute", "0L AS second")
    empty = spark.createDataFrame([(99, 1, "2020", day(1))], given.competitions.schema)
    return Sources(given.competitions.unionAll(empty), given.matches, given.events.unionAll(more), given.lineups)


def test_joins_of_dealt_tables_need_no_exchange(spark):
    layers = {"plain": {}, "dealt": {"buckets": 5, "rows_per_part": 100, "broadcast_bytes": 0}}
    for now, updated in ((T1, day(1)), (T2, day(8))):
        run_bronze(spark, hot(spark, updated, now.month), now, "bkb", [43, 99])
        for name, options in layers.items():
            run_silver(spark, "bkb", f"bks_{name}", **options)
        tables_ = [spark.table(f"bks_{name}.combined") for name in layers]
        assert rows(tables_[0]) == rows(tables_[1].select(*tables_[0].columns))
        assert tables_[0].filter("match_id IS NULL").count() == 1
    events, matches = spark.table("bks_dealt.events"), spark.table("bks_dealt.dealt_matches")
    assert rows(matches.filter("match_id = 10").select("match_part", "match_parts")) == [(p, 4) for p in range(4)]
    assert rows(matches.filter("match_id <> 10").select("match_part").distinct()) == [(0,)]
    sizes = [n for _, n in rows(events.filter("match_id = 10").groupBy("match_part").count())]
    assert len(sizes) == 4 and sum(sizes) == 360 and max(sizes) < 2 * min(sizes)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = silver.combined_in_parts(matches, events)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_point_lookups_read_the_files_that_may_hold_the_id(spark):
    tables.create_layer(spark, "blm")
    declared = s.contract("""
        string     id
        bigint     match_id scope
        timestamp  data_valid_from_utc data_valid_to_utc
    """)
    # ids without order, so that minima and maxima of files tell nothing
    batch = spark.range(4000).selectExpr("md5(cast(id AS string)) AS id", "id * 7919 % 4001 AS match_id", "id % 8 AS scope")
    versions.load_versions(spark, "blm.t", batch, declared, ["id"], ["scope"], T1, looked_up=["id", "match_id"])
    wanted = batch.filter("scope = 3").first()
    found = filters.by_id(spark.table("blm.t"), wanted.id)
    assert rows(found.select("scope")) == [(3,)]
    assert sum(scanned(found)) <= 1000  # one of eight files, or by chance one more
    ids = [r.match_id for r in batch.filter("scope = 5").limit(10).collect()]
    ten = spark.table("blm.t").filter(F.col("match_id").isin(ids))
    assert ten.count() == 10 and sum(scanned(ten)) <= 1000


def test_only_the_listed_seasons_of_a_source_are_read(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.range(400).selectExpr("concat('e', id) AS id", "id % 40 AS match_id", "int(id % 4) AS competition_id", "int(id % 5) AS season_id").write.partitionBy(
        "competition_id", "season_id").parquet(path)
    source = spark.read.parquet(path)
    matches = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 2, 3), (4, None, 1)], "match_id long, competition_id long, season_id long")
    batch = str(tmp_path / "batch")
    matches.write.parquet(batch)
    picked = bronze.in_seasons(source, spark.read.parquet(batch))
    assert "dynamicpruning" in picked._jdf.queryExecution().optimizedPlan().toString().lower()
    assert rows(picked.select("competition_id", "season_id").distinct()) == [(1, 1), (2, 3)]
    # two of twenty seasons; filters on each column by itself would have read four
    assert sum(n for n in scanned(picked) if n > 4) == 40


MARTS = ("team_lookup", "combined_player_playtime", "combined_results", "combined_matches", "combined_passes")


def changed(given, **columns):
    """Sources with other lineups and stages in season 1."""
    lineups, matches = given.lineups, given.matches
    if "nickname" in columns:
        lineups = lineups.withColumn("player_nickname", F.when(F.col("match_id") < 20, F.lit(columns["nickname"])))
    if "stage" in columns:
        matches = matches.withColumn("competition_stage", F.when(F.col("season_id") == 1, F.lit(columns["stage"])).otherwise(F.col("competition_stage")))
    return Sources(given.competitions, matches, given.events, lineups)


def test_marts_are_kept_up_by_season(spark):
    run_bronze(spark, sources(spark, 0, day(1)), T1, "igb", [43])
    run_silver(spark, "igb", "igs")
    assert run_gold(spark, "igs", "igg") == {"43-1", "43-2", "43-3"}
    assert run_gold(spark, "igs", "igg") == set()
    steps = [
        # another score: one season
        (sources(spark, 4, day(8)), T2, {"43-1"}),
        # another nickname, first in order: every season in which the player passes
        (changed(sources(spark, 5, day(9)), nickname="A"), T3, {"43-1", "43-2", "43-3"}),
        # a stage name that was not there: the results of all seasons may show it
        (changed(sources(spark, 6, day(10)), nickname="A", stage="Grand Final"), datetime(2024, 4, 1), {"43-1", "43-2", "43-3"}),
        # the same again with another score: one season
        (changed(sources(spark, 7, day(11)), nickname="A", stage="Grand Final"), datetime(2024, 5, 1), {"43-1"}),
    ]
    for given, now, built in steps:
        run_bronze(spark, given, now, "igb", [43])
        run_silver(spark, "igb", "igs")
        before = {t: files(spark, f"igg.{t}") for t in MARTS}
        assert run_gold(spark, "igs", "igg") == built
        for t in MARTS:
            held = before[t] & files(spark, f"igg.{t}")
            assert len(built) == 3 or held == {f for f in before[t] if "season_id=1" not in f} != set()
        run_gold(spark, "igs", "igw", whole=True)
        for t in (*MARTS, "player_lookup", "match_duration_lookup"):
            kept = spark.table(f"igg.{t}")
            assert rows(kept) == rows(spark.table(f"igw.{t}").select(*kept.columns)), t
