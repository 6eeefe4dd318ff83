"""Sources, sinks, cleaning, filters and history."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake import schemas as s
from matchlake.functions import cleaning
from matchlake.operators import filters, history, joins, shaping
from matchlake.operators.filters import other_stints, relevant_stints
from matchlake.operators.lineups import stint_rows
from matchlake.plans import bronze
from matchlake.sources import readers, tables, versions

from . import columns as c
from .bridge import FIRST_LOAD, RAW_CONTRACT, SECOND_LOAD, STRICT_CONTRACT, Bridge
from .oracle import quoted
from .registry import check

# --- sources and sinks -----------------------------------------------------------


def _written(df: DataFrame, path: str, fmt: str) -> str:
    # JSON repeats every name in every row: packed, in files of a size that one task can unpack
    packed = {"compression": "gzip", "maxRecordsPerFile": "500000"} if fmt == "json" else {}
    df.write.format(fmt).options(**packed).save(path)
    return path


def read_competitions(b: Bridge) -> DataFrame:
    path = _written(b.competitions, b.scratch("competitions"), "json")
    return shaping.clean(readers.read_competitions(b.spark, path), s.COMPETITIONS)


def read_matches(b: Bridge) -> DataFrame:
    path = _written(b.matches, b.scratch("matches"), "parquet")
    pairs = b.competitions.filter("season_name >= '1996'").select(*s.COMPETITION_KEY)
    return readers.read_matches(b.spark, path, "parquet", pairs)


def read_events(b: Bridge) -> DataFrame:
    path = _written(b.line_events, b.scratch("events"), "json")
    changed = b.matches.filter("last_updated >= '1998-06-01'").select("match_id")
    events = readers.read_events(b.spark, path, "json", changed)
    return shaping.clean(events, s.EVENTS)


def team_map(b: Bridge) -> DataFrame:
    """Lineups as a source delivers them: per match a map from team to its players."""
    player = F.struct("player_id", "player_name", "player_nickname", "jersey_number", "country",
                      "cards", "positions")
    per_team = b.lineups.groupBy("match_id", "team").agg(F.collect_list(player).alias("players"))
    entry = F.struct("team", "players")
    return per_team.groupBy("match_id").agg(
        F.map_from_entries(F.collect_list(entry)).alias("lineups")
    )


def read_lineups(b: Bridge) -> DataFrame:
    path = _written(team_map(b), b.scratch("lineups"), "json")
    rows = shaping.clean(readers.read_lineups(b.spark, path), s.LINEUPS)
    return rows.select(
        "match_id", "team", "player_id", "player_name", "player_nickname", "jersey_number",
        "country", F.size("cards").alias("n_cards"), F.size("positions").alias("n_positions"),
    )


check("S1_read_competitions", read_competitions,
      f"SELECT {quoted(s.COMPETITIONS_SOURCE.names)} FROM b_competitions")
check("S2_read_matches", read_matches, "SELECT * FROM b_matches WHERE season >= '1996'")
check("S3_read_events", read_events,
      "SELECT e.* REPLACE (CASE WHEN location NOT IN ('', 'null') THEN location END AS location) "
      "FROM b_events e JOIN b_matches m ON e.match_id = m.match_id "
      "WHERE m.last_updated >= TIMESTAMP '1998-06-01 00:00:00'")
check("S4_read_lineups", read_lineups,
      """SELECT p.match_id, p.team, p.player_id, p.player_name, p.player_nickname,
            p.jersey_number, p.country, CAST(coalesce(n.n, 0) AS INTEGER) AS n_cards,
            CAST(k.n AS INTEGER) AS n_positions
        FROM b_players p
        JOIN (SELECT match_id, player_id, count(*) AS n FROM b_stints GROUP BY ALL) k
            ON p.match_id = k.match_id AND p.player_id = k.player_id
        LEFT JOIN (SELECT match_id, player_id, count(*) AS n FROM b_cards GROUP BY ALL) n
            ON p.match_id = n.match_id AND p.player_id = n.player_id""")


def broken_matches(b: Bridge) -> tuple[DataFrame, DataFrame]:
    """A JSON source in which a tenth of the lines is cut off, a tenth lacks its key and a tenth has one that is no number."""
    names = s.MATCHES_SOURCE.names
    line = F.to_json(F.struct(*names))
    keyless = F.to_json(F.struct(*[n for n in names if n != "match_id"]))
    wrong = F.to_json(F.struct(F.lit("no number").alias("match_id"), *[n for n in names if n != "match_id"]))
    written = F.when(F.expr("match_id % 10 = 0"), F.substring(line, 1, 60)).when(F.expr("match_id % 10 = 3"), keyless).when(
        F.expr("match_id % 10 = 6"), wrong).otherwise(line)
    path = b.scratch("broken")
    b.matches.select(written.alias("value")).write.text(path)
    return readers.read_checked(b.spark, path, s.MATCHES_SOURCE, "json", s.MATCH_KEY)


def kept_matches(b: Bridge) -> DataFrame:
    kept, _ = broken_matches(b)
    return shaping.clean(kept, s.MATCHES)


def rejected_matches(b: Bridge) -> DataFrame:
    """Rejected rows of two loads, the second repeated."""
    _, rejected = broken_matches(b)
    table = f"{b.scratch_schema()}.rejected"
    for now in (FIRST_LOAD, SECOND_LOAD, SECOND_LOAD):
        readers.store_rejected(rejected, table, "matches", now)
    return b.spark.table(table).groupBy("source", "loaded_at", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.length("record") > 0).alias("with_record"))


check("S2_kept_of_broken_source", kept_matches, "SELECT * FROM b_matches WHERE match_id % 10 NOT IN (0, 3, 6)")
check("S2_rejected_of_broken_source", rejected_matches,
      """SELECT 'matches' AS source, loaded_at, CASE WHEN match_id % 10 = 0 THEN 'unreadable' ELSE 'without match_id' END AS reason,
            count(*) AS n, count(*) AS with_record
        FROM b_matches, (VALUES ('2024-02-01 00:00:00'), ('2024-03-01 00:00:00')) t(loaded_at)
        WHERE match_id % 10 IN (0, 3, 6) GROUP BY ALL""")


def stored_matches(b: Bridge) -> str:
    table = f"{b.scratch_schema()}.matches"
    tables.rebuild(b.matches, table)
    return table


def read_stored(b: Bridge) -> DataFrame:
    stored = readers.read_table(b.spark, stored_matches(b))
    return readers.read_sql(
        b.spark,
        "SELECT competition_id, season_id, MAX(last_updated) AS last_updated "
        "FROM {matches} GROUP BY competition_id, season_id",
        matches=stored,
    )


def append_twice(b: Bridge) -> DataFrame:
    table = f"{b.scratch_schema()}.competitions"
    tables.append(b.bronze_competitions, table, s.COMPETITIONS)
    tables.append(b.competitions.drop("match_updated"), table, s.COMPETITIONS)
    return b.spark.table(table)


def create_layer(b: Bridge) -> DataFrame:
    layer = b.scratch_schema() + "_gold"
    tables.create_layer(b.spark, layer, b.scratch("layer"))
    tables.create_layer(b.spark, layer)
    tables.rebuild(b.teams, f"{layer}.team_lookup")
    return b.spark.table(f"{layer}.team_lookup")


def export_csv(b: Bridge) -> DataFrame:
    path = b.scratch("results")
    tables.export_csv(b.results, path)
    wanted = b.results.schema
    return b.spark.read.schema(wanted).option("header", True).csv(path)


def emptied(b: Bridge) -> DataFrame:
    table = stored_matches(b)
    before = b.spark.table(table).count()
    tables.empty(b.spark, table)
    b.spark.catalog.refreshTable(table)
    return b.spark.table(table).agg(
        F.lit(before).cast("bigint").alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    )


def cloned(b: Bridge) -> DataFrame:
    table = stored_matches(b)
    tables.clone_structure(b.spark, table, f"{table}_copy")
    tables.clone_structure(b.spark, table, f"{table}_copy")
    b.spark.table(table).write.insertInto(f"{table}_copy")
    return b.spark.table(f"{table}_copy")


def dropped(b: Bridge) -> DataFrame:
    table = stored_matches(b)
    tables.rebuild(b.competitions, f"{table}_old")
    tables.drop(b.spark, f"{table}_old")
    tables.drop(b.spark, f"{table}_old")
    gone = not b.spark.catalog.tableExists(f"{table}_old")
    return b.spark.table(table).groupBy("competition_id").agg(
        F.count(F.lit(1)).alias("matches")
    ).withColumn("old_gone", F.lit(gone))


check("S5_read_stored_sql", read_stored,
      "SELECT competition_id, season_id, max(last_updated) AS last_updated FROM b_matches GROUP BY ALL")
check("S6_typed_append", append_twice,
      """SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS data_valid_from_utc,
            CAST(NULL AS TIMESTAMP) AS data_valid_to_utc FROM b_competitions
        UNION ALL SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS match_updated), NULL, NULL
        FROM b_competitions""")
check("S7_rebuild_table", lambda b: b.spark.table(stored_matches(b)), "SELECT * FROM b_matches")
check("S8_create_layer", create_layer, "SELECT * FROM team_lookup")
check("S9_csv_export", export_csv, "SELECT * FROM results")
check("S10_empty_table", emptied,
      "SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM b_matches")
check("S11_clone_structure", cloned, "SELECT * FROM b_matches")
check("S12_drop_table", dropped,
      "SELECT competition_id, count(*) AS matches, TRUE AS old_gone FROM b_matches GROUP BY ALL")

# --- cleaning ----------------------------------------------------------------------

_MISSING = "('NaN', 'None', 'Null', 'nan', 'null', '')"


def _kept(name: str) -> str:
    return f"CASE WHEN {name} NOT IN {_MISSING} THEN {name} END"


_INTEGER = ("CAST(CASE WHEN TRY_CAST(trim(amount) AS DECIMAL(38, 18)) % 1 = 0 "
            "THEN TRY_CAST(trim(amount) AS DECIMAL(38, 18)) END AS BIGINT)")
_SEEN = f"TRY_CAST({_kept('seen')} AS TIMESTAMP)"


def one(field: str, rule) -> "callable":
    """Apply one coercion to one raw text column, keeping the key."""
    def build(b: Bridge) -> DataFrame:
        col = cleaning.sentinels_to_null(F.col(field))
        return b.raw.select("order_id", rule(col, b.raw.schema[field].dataType).alias(field))
    return build


check("C1_clean_declared", lambda b: shaping.clean(b.raw, RAW_CONTRACT),
      f"""SELECT order_id, {_kept('name')} AS name, {_INTEGER} AS amount,
            TRY_CAST({_kept('ratio')} AS DOUBLE) AS ratio,
            TRY_CAST({_kept('flagged')} AS BOOLEAN) AS flagged, {_SEEN} AS seen, payload FROM raw""")
check("C2_sentinels", lambda b: b.raw.select(
    "order_id", cleaning.sentinels_to_null(F.col("name")).alias("name")),
    f"SELECT order_id, {_kept('name')} AS name FROM raw")
check("C3_timestamp", one("seen", cleaning.to_timestamp), f"SELECT order_id, {_SEEN} AS seen FROM raw")
check("C4_date", one("seen", cleaning.to_date), f"SELECT order_id, CAST({_SEEN} AS DATE) AS seen FROM raw")
check("C5_integer", one("amount", cleaning.to_integer), f"SELECT order_id, {_INTEGER} AS amount FROM raw")
check("C6_double", one("ratio", cleaning.to_double),
      f"SELECT order_id, TRY_CAST({_kept('ratio')} AS DOUBLE) AS ratio FROM raw")
check("C7_boolean", one("flagged", cleaning.to_boolean),
      f"SELECT order_id, TRY_CAST({_kept('flagged')} AS BOOLEAN) AS flagged FROM raw")
check("C8_text", lambda b: b.table("orders").select(
    "o_orderkey", cleaning.to_text(F.col("o_custkey"), None).alias("customer")),
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer FROM orders")

_WITH_NAN = "CASE WHEN o_orderkey % 4 = 0 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END"
check("C9_nan_to_null", lambda b: shaping.nan_to_null(b.table("orders").select(
    "o_orderkey", F.expr(_WITH_NAN).alias("price"))),
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS price FROM orders")
check("C10_schema_alignment", lambda b: shaping.align(
    b.matches.select(F.lit("x").alias("surplus"), "season_id", "competition_id"),
    s.COMPETITIONS_SOURCE),
    """SELECT competition_id, season_id, CAST(NULL AS VARCHAR) AS country_name,
        CAST(NULL AS VARCHAR) AS competition_name, CAST(NULL AS VARCHAR) AS competition_gender,
        CAST(NULL AS BOOLEAN) AS competition_youth, CAST(NULL AS BOOLEAN) AS competition_international,
        CAST(NULL AS VARCHAR) AS season_name, CAST(NULL AS TIMESTAMP) AS match_updated,
        CAST(NULL AS TIMESTAMP) AS match_updated_360, CAST(NULL AS TIMESTAMP) AS match_available_360,
        CAST(NULL AS TIMESTAMP) AS match_available FROM b_matches""")
check("C11_name_repair", lambda b: shaping.repair_names(
    b.events.select("id", "player", "pass_recipient"), ["player", "pass_recipient"]),
    """SELECT id, replace(player, 'N''''', 'N''') AS player,
        replace(pass_recipient, 'N''''', 'N''') AS pass_recipient FROM b_events""")
check("C12_stamp_versions", lambda b: shaping.stamp_versions(
    b.matches.select("match_id"), FIRST_LOAD),
    """SELECT match_id, TIMESTAMP '2024-02-01 00:00:00' AS data_valid_from_utc,
        CAST(NULL AS TIMESTAMP) AS data_valid_to_utc FROM b_matches""")
check("C13_version_clock", lambda b: b.matches.select(
    "match_id", *[shaping.naive(t).alias(n) for n, t in
                  zip(("starts", "earlier_ends"), shaping.version_clock(SECOND_LOAD))]),
    """SELECT match_id, TIMESTAMP '2024-03-01 00:00:00' AS starts,
        TIMESTAMP '2024-02-29 23:59:59.999' AS earlier_ends FROM b_matches""")
check("C14_drop_columns", lambda b: shaping.drop_columns(
    b.competitions, "match_updated_360", "match_available_360"),
    "SELECT * EXCLUDE (match_updated_360, match_available_360) FROM b_competitions")


def mapped_projection(b: Bridge) -> DataFrame:
    c, m, e = b.competitions.alias("c"), b.matches.alias("m"), b.events.alias("e")
    joined = e.join(m, F.col("e.match_id") == F.col("m.match_id")).join(
        c, (F.col("c.competition_id") == F.col("m.competition_id"))
        & (F.col("c.season_id") == F.col("m.season_id")))
    return joined.select(*shaping.project({
        "c": ["competition_id", "season_name"], "m": ["match_id", "home_team"],
        "e": ["id", "type", "50_50"],
    }))


check("C15_mapped_projection", mapped_projection,
      """SELECT c.competition_id, c.season_name, m.match_id, m.home_team, e.id, e.type, e."50_50"
        FROM b_events e JOIN b_matches m ON e.match_id = m.match_id
        JOIN b_competitions c ON c.competition_id = m.competition_id AND c.season_id = m.season_id""")
check("C16_projection_by_name", lambda b: b.bronze_competitions.select(
    *shaping.names_without(b.bronze_competitions.columns, "360", taken=[s.VALID_TO])),
    """SELECT * EXCLUDE (match_updated_360, match_available_360),
        TIMESTAMP '2024-02-01 00:00:00' AS data_valid_from_utc FROM b_competitions""")


def strict_clean(b: Bridge) -> DataFrame:
    valid = b.raw.select(
        "order_id",
        F.when(F.col("order_id") % 3 != 0, (F.col("order_id") + 1).cast("string"))
        .otherwise(F.lit("None")).alias("amount"),
        F.when(F.col("order_id") % 3 != 1, F.lit("0.5")).otherwise(F.lit("Null")).alias("ratio"),
        F.when(F.col("order_id") % 3 != 2, F.lit("2024-01-02T03:04:05Z"))
        .otherwise(F.lit("NaN")).alias("seen"),
    )
    return shaping.clean(valid, STRICT_CONTRACT, strict=True)


check("C17_strict_clean", strict_clean,
      """SELECT order_id, CASE WHEN order_id % 3 <> 0 THEN order_id + 1 END AS amount,
        CASE WHEN order_id % 3 <> 1 THEN CAST(0.5 AS DOUBLE) END AS ratio,
        CASE WHEN order_id % 3 <> 2 THEN TIMESTAMP '2024-01-02 03:04:05' END AS seen FROM raw""")
check("C18_distinct_values", lambda b: shaping.distinct_values(b.matches, "competition_id").withColumn(
    "data_type", F.lit(dict(b.matches.dtypes)["competition_id"])),
    "SELECT DISTINCT competition_id, 'bigint' AS data_type FROM b_matches")

# --- filters -----------------------------------------------------------------------

check("P1_competition_and_season", lambda b: b.matches.filter(filters.in_scope([3], season=1996)),
      "SELECT * FROM b_matches WHERE competition_id = 3 AND season_id = 1996")
check("P2_min_season", lambda b: b.competitions.filter(filters.in_scope([1, 2], min_season="1996")),
      "SELECT * FROM b_competitions WHERE competition_id IN (1, 2) AND season_name >= '1996'")
check("P3_newer_than_watermark", lambda b: history.newer_rows(
    b.second_batch, b.loaded, "last_updated"),
    """SELECT * FROM second_batch WHERE last_updated > (SELECT max(last_updated) FROM loaded)""")
check("P4_current_version", lambda b: b.loaded.filter(filters.is_current()),
      "SELECT * FROM loaded WHERE data_valid_to_utc IS NULL")
check("P5_drawn_knockouts", lambda b: b.silver_matches.filter(
    filters.is_drawn_knockout()).select("match_id", "home_team", "away_team"),
    """SELECT match_id, home_team, away_team FROM silver_matches
        WHERE competition_stage_ranking > 1 AND winning_team = 'Draw'""")
check("P6_shootout_goals", lambda b: b.events.filter(filters.is_shootout_goal()).select(
    "id", "match_id", "team"),
    """SELECT id, match_id, team FROM b_events
        WHERE period = 5 AND type = 'Shot' AND shot_outcome = 'Goal'""")

_STINTS = 'match_id, player_id, start_reason, end_reason, "from", "to"'
_RELEVANT = """coalesce(start_reason = 'Starting XI' OR contains(start_reason, 'Substitution - On')
    OR contains(end_reason, 'Substitution - Off')
    OR end_reason IN ('Foul Committed (Red Card)', 'Final Whistle'), FALSE)"""
_STINT_COLUMNS = ["match_id", "player_id", "start_reason", "end_reason", "from", "to"]
check("P7_relevant_stints", lambda b: relevant_stints(stint_rows(b.lineups)).select(*_STINT_COLUMNS),
      f"SELECT {_STINTS} FROM b_stints WHERE {_RELEVANT}")
check("P8_other_stints", lambda b: other_stints(stint_rows(b.lineups)).select(*_STINT_COLUMNS),
      f"SELECT {_STINTS} FROM b_stints WHERE NOT {_RELEVANT}")
check("P9_passes_any_case", lambda b: b.events.filter(filters.is_pass()).select("id", "type"),
      "SELECT id, type FROM b_events WHERE lower(type) = 'pass'")
check("P10_half_ends", lambda b: b.events.filter(filters.is_timed_half_end()).select(
    "id", "match_id", "period", "minute", "second"),
    """SELECT id, match_id, period, minute, second FROM b_events
        WHERE type = 'Half End' AND period IN (1, 2, 3, 4)""")
check("P11_finals", lambda b: b.silver_matches.filter(filters.is_final()).select(
    "match_id", "competition_stage", "winning_team"),
    """SELECT match_id, competition_stage, winning_team FROM silver_matches
        WHERE competition_stage_ranking IN (9, 10)""")
check("P12_key_membership", lambda b: joins.only_keys(
    b.bronze_matches, b.first_batch, ["match_id"]).select("match_id", "home_score", s.VALID_TO),
    """SELECT match_id, home_score, CAST(NULL AS TIMESTAMP) AS data_valid_to_utc FROM b_matches
        WHERE match_id IN (SELECT match_id FROM first_batch)
        UNION ALL SELECT match_id, home_score + 1, TIMESTAMP '2024-01-31 23:59:59.999'
        FROM b_matches WHERE match_id % 7 = 0 AND match_id IN (SELECT match_id FROM first_batch)""")
check("P13_event_by_id", lambda b: filters.by_id(
    b.events, b.table("lineitem").agg(F.min(F.expr(c.EVENT["id"]))).scalar()),
    "SELECT * FROM b_events WHERE id = (SELECT min(id) FROM b_events WHERE type <> 'Half End')")
check("P14_type_contains_first_100", lambda b: filters.type_contains(b.events, "pass").select(
    "id", "type", "match_id").orderBy("id").limit(100),
    """SELECT id, type, match_id FROM b_events WHERE lower(type) LIKE '%pass%'
        ORDER BY id LIMIT 100""")


def write_unless_empty(b: Bridge) -> DataFrame:
    """Second load of unchanged rows is empty and skipped; changed rows are written."""
    again = history.newer_rows(b.first_batch, b.loaded, "last_updated")
    new = history.newer_rows(b.second_batch, b.loaded, "last_updated")
    return new.withColumn("repeat_is_empty", F.lit(filters.is_empty(again)))


check("P15_emptiness_test", write_unless_empty,
      """SELECT *, TRUE AS repeat_is_empty FROM second_batch
        WHERE last_updated > (SELECT max(last_updated) FROM loaded)""")

# --- incremental load and history ------------------------------------------------------

_SCOPE = s.COMPETITION_KEY


def newer(b: Bridge) -> DataFrame:
    return history.newer_rows(b.second_batch, b.loaded, "last_updated", _SCOPE)


def versioned_table(b: Bridge) -> str:
    """History table with the first load stored."""
    table = f"{b.scratch_schema()}.changes"
    versions.load_versions(b.spark, table, b.first_batch, _CHANGES, ["match_id"], _SCOPE,
                           FIRST_LOAD, "last_updated")
    return table


_CHANGES = s.contract("""
    bigint     match_id competition_id season_id
    string     status
    timestamp  last_updated data_valid_from_utc data_valid_to_utc
""")


def stored_upsert(b: Bridge) -> DataFrame:
    """Second load into the stored history, sent twice to show that repeating is harmless."""
    table = versioned_table(b)
    # a loaded set is fixed before the load it drives moves the watermark
    batch = b.scratch("batch")
    stored = versions.read_history(b.spark, table, _CHANGES)
    history.newer_rows(b.second_batch, stored, "last_updated", _SCOPE).write.parquet(batch)
    for _ in range(2):
        versions.load_versions(b.spark, table, b.spark.read.parquet(batch), _CHANGES, ["match_id"],
                               _SCOPE, SECOND_LOAD, "last_updated")
    return versions.read_history(b.spark, table, _CHANGES)


def stored_null_keys(b: Bridge) -> DataFrame:
    """Two loads whose key column is NULL in a tenth of the rows, the second sent three times."""
    table = f"{b.scratch_schema()}.changes"
    key = ["match_id", "status"]
    nulled = b.first_batch.withColumn("status", F.expr("if(match_id % 10 = 0, NULL, status)"))
    versions.load_versions(b.spark, table, nulled, _CHANGES, key, _SCOPE, FIRST_LOAD)
    for _ in range(3):
        versions.load_versions(b.spark, table, nulled.filter("match_id % 5 = 0"), _CHANGES, key, _SCOPE, SECOND_LOAD)
    return versions.read_history(b.spark, table, _CHANGES)


def stopped_load(b: Bridge, table: str, batch: DataFrame) -> None:
    """A load that ends with an error where it would commit."""
    commit = versions.commit

    def stop(*_) -> None:
        raise InterruptedError

    versions.commit = stop
    try:
        versions.load_versions(b.spark, table, batch, _CHANGES, ["match_id"], _SCOPE, SECOND_LOAD)
    except InterruptedError:
        pass
    finally:
        versions.commit = commit


def stored_after_half_commit(b: Bridge) -> DataFrame:
    """A second load that stops before its commit, is read over, and is then run again."""
    table = versioned_table(b)
    batch = b.first_batch.filter("match_id % 5 = 0").withColumn("status", F.lit("U"))
    stopped_load(b, table, batch)
    versions.load_versions(b.spark, table, batch, _CHANGES, ["match_id"], _SCOPE, SECOND_LOAD)
    return b.spark.table(table)


def stored_marks(b: Bridge) -> DataFrame:
    """Watermarks kept with the commits of two loads; a third load stopped before its commit."""
    table = versioned_table(b)
    batch = b.scratch("batch")
    newer(b).write.parquet(batch)
    versions.load_versions(b.spark, table, b.spark.read.parquet(batch), _CHANGES, ["match_id"], _SCOPE, SECOND_LOAD, "last_updated")
    late = b.first_batch.filter("match_id % 5 = 0").withColumn("last_updated", F.expr("last_updated + INTERVAL '9000' DAY"))
    stopped_load(b, table, late)
    return versions.watermarks(b.spark, table, "last_updated", _SCOPE)


def doubled_keys(b: Bridge) -> DataFrame:
    """Open versions after two loads without an update time, in which a third of the keys is sent up to three times."""
    table = f"{b.scratch_schema()}.changes"
    twice = b.first_batch.unionByName(b.first_batch.filter("match_id % 3 = 0")).unionByName(
        b.first_batch.filter("match_id % 6 = 0").withColumn("status", F.lit("other")))
    for now in (FIRST_LOAD, SECOND_LOAD):
        versions.load_versions(b.spark, table, twice, _CHANGES, ["match_id"], _SCOPE, now)
    return b.spark.table(table).groupBy("match_id", "data_valid_from_utc", "data_valid_to_utc").agg(F.count(F.lit(1)).alias("versions"))


def many_loads(b: Bridge) -> DataFrame:
    """Six loads of a fifth of the keys after the first: partitions that are left, and versions by end time."""
    table = versioned_table(b)
    for i in range(1, 7):
        batch = b.first_batch.filter("match_id % 5 = 0").withColumn("status", F.lit(f"U{i}"))
        versions.load_versions(b.spark, table, batch, _CHANGES, ["match_id"], _SCOPE, SECOND_LOAD + timedelta(days=i), "last_updated")
    open_parts = b.spark.table(f"{table}_rows").filter("data_valid_to_utc IS NULL").select("slice", "attempt").distinct().groupBy().agg(
        (F.count(F.lit(1)) - F.count_distinct("slice")).alias("superseded_slices"))
    counts = b.spark.table(table).groupBy("status", "data_valid_to_utc").agg(F.count(F.lit(1)).alias("versions"))
    return counts.withColumn("superseded_slices", open_parts.scalar())


check("D1_watermark_stored", stored_marks,
      """SELECT competition_id, season_id, max(last_updated) AS last_updated FROM upserted
        WHERE data_valid_to_utc IS NULL GROUP BY ALL""")
check("D6_doubled_keys", doubled_keys,
      """SELECT match_id, TIMESTAMP '2024-02-01 00:00:00' AS data_valid_from_utc,
            TIMESTAMP '2024-02-29 23:59:59.999' AS data_valid_to_utc, CAST(1 AS BIGINT) AS versions FROM first_batch
        UNION ALL SELECT match_id, TIMESTAMP '2024-03-01 00:00:00', NULL, 1 FROM first_batch""")
check("D6_many_loads", many_loads,
      """WITH loads AS (SELECT i, CASE WHEN i < 6 THEN TIMESTAMP '2024-03-01 00:00:00' + to_days(CAST(i + 1 AS INTEGER)) - INTERVAL '1' MILLISECOND END AS ended
            FROM range(0, 7) t(i)),
        rows AS (SELECT status, 0 AS i FROM first_batch WHERE match_id % 5 = 0 UNION ALL
            SELECT 'U' || i, i FROM first_batch, range(1, 7) t(i) WHERE match_id % 5 = 0)
        SELECT status, ended AS data_valid_to_utc, count(*) AS versions, CAST(0 AS BIGINT) AS superseded_slices FROM (
            SELECT status, ended FROM rows JOIN loads USING (i) UNION ALL SELECT status, NULL FROM first_batch WHERE match_id % 5 <> 0)
        GROUP BY ALL""")
check("D1_watermark_per_scope", lambda b: history.watermark(b.loaded, "last_updated", _SCOPE),
      "SELECT competition_id, season_id, watermark FROM marks")
check("D1_watermark_global", lambda b: history.watermark(b.loaded, "last_updated"),
      "SELECT max(last_updated) AS watermark FROM loaded")
check("D2_incremental_selection", newer, "SELECT * FROM newer")
check("D3_close_versions", lambda b: history.close_versions(
    b.loaded, newer(b), ["match_id"], shaping.version_clock(SECOND_LOAD)[1]),
    "SELECT * FROM closed")
check("D3_close_versions_restamp", lambda b: history.close_versions(
    b.loaded, newer(b), ["match_id"], shaping.version_clock(SECOND_LOAD)[1], restamp=True),
    """SELECT * REPLACE (CASE WHEN match_id IN (SELECT match_id FROM newer)
        THEN TIMESTAMP '2024-02-29 23:59:59.999' ELSE data_valid_to_utc END AS data_valid_to_utc)
        FROM loaded""")
check("D4_close_by_composite_key", lambda b: history.close_versions(
    b.loaded, newer(b), ["competition_id", "season_id"], shaping.version_clock(SECOND_LOAD)[1]),
    """SELECT * REPLACE (CASE WHEN data_valid_to_utc IS NULL AND (competition_id, season_id) IN
        (SELECT (competition_id, season_id) FROM newer)
        THEN TIMESTAMP '2024-02-29 23:59:59.999' ELSE data_valid_to_utc END AS data_valid_to_utc)
        FROM loaded""")
check("D5_close_by_single_key", lambda b: history.close_versions(
    b.open_versions(b.events.select("id", "match_id")),
    joins.only_keys(b.events, newer(b), ["match_id"]),
    ["id"], shaping.version_clock(SECOND_LOAD)[1]),
    """SELECT id, match_id, TIMESTAMP '2024-02-01 00:00:00' AS data_valid_from_utc,
        CASE WHEN match_id IN (SELECT match_id FROM newer)
        THEN TIMESTAMP '2024-02-29 23:59:59.999' END AS data_valid_to_utc FROM b_events""")
check("D6_upsert_versions", lambda b: history.upsert_versions(
    b.loaded, newer(b), ["match_id"], SECOND_LOAD, "last_updated"), "SELECT * FROM upserted")
check("D6_upsert_stored_history", stored_upsert,
      "SELECT * FROM upserted WHERE status <> 'OLD'")
check("D6_stored_null_keys", stored_null_keys,
      """WITH given AS (SELECT * REPLACE (CASE WHEN match_id % 10 <> 0 THEN status END AS status) FROM first_batch)
        SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS data_valid_from_utc,
            CASE WHEN match_id % 5 = 0 THEN TIMESTAMP '2024-02-29 23:59:59.999' END AS data_valid_to_utc FROM given
        UNION ALL SELECT *, TIMESTAMP '2024-03-01 00:00:00', NULL FROM given WHERE match_id % 5 = 0""")
check("D6_stored_after_half_commit", stored_after_half_commit,
      """SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS data_valid_from_utc,
            CASE WHEN match_id % 5 = 0 THEN TIMESTAMP '2024-02-29 23:59:59.999' END AS data_valid_to_utc FROM first_batch
        UNION ALL SELECT * REPLACE ('U' AS status), TIMESTAMP '2024-03-01 00:00:00', NULL FROM first_batch
        WHERE match_id % 5 = 0""")
check("D7_current_snapshot", lambda b: history.current_versions(history.upsert_versions(
    b.loaded, newer(b), ["match_id"], SECOND_LOAD, "last_updated")),
    "SELECT * FROM upserted WHERE data_valid_to_utc IS NULL")


def cascade(b: Bridge) -> DataFrame:
    """Changed competitions, then their newer matches, then the events of those."""
    competitions = bronze.pick_competitions(
        b.competitions, b.bronze_competitions.withColumn(
            "match_updated", F.expr("match_updated - INTERVAL '1' DAY")), [0, 1, 2], min_season="1995")
    held = b.bronze_matches.filter("competition_id < 2").withColumn(
        "last_updated", F.expr("last_updated - INTERVAL '100' DAY"))
    matches = bronze.pick_matches(b.matches, held, competitions)
    return bronze.pick_events(b.events, matches).select("id", "match_id", "player")


check("D8_change_cascade", cascade,
      """SELECT e.id, e.match_id, replace(e.player, 'N''''', 'N''') AS player
        FROM b_events e JOIN b_matches m ON e.match_id = m.match_id
        JOIN (SELECT c.* FROM b_competitions c JOIN
                (SELECT competition_id, max(match_updated) - INTERVAL '1' DAY AS mark
                 FROM b_competitions GROUP BY competition_id) w
                ON c.competition_id = w.competition_id AND c.match_updated > w.mark
              WHERE c.competition_id IN (0, 1, 2) AND c.season_name >= '1995') c
            ON m.competition_id = c.competition_id AND m.season_id = c.season_id
        LEFT JOIN (SELECT competition_id, season_id, max(last_updated) - INTERVAL '100' DAY AS mark
             FROM b_matches WHERE competition_id < 2 GROUP BY ALL) h
            ON m.competition_id = h.competition_id AND m.season_id = h.season_id
        WHERE h.mark IS NULL OR m.last_updated > h.mark""")
check("D9_merge_without_history", lambda b: history.merge_latest(
    b.first_batch, newer(b), ["match_id"]),
    """SELECT * FROM first_batch WHERE match_id NOT IN (SELECT match_id FROM newer)
        UNION ALL SELECT * FROM newer""")
