"""Silver and gold builds over stored tables, and the whole run."""

from __future__ import annotations

from collections.abc import Collection, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as s
from ..operators.joins import BROADCAST_BYTES, broadcast_if_small, sized_strategy
from ..schemas import VALID_TO
from ..session import scratch_path, together, tune
from ..sources import dealt, seasons
from ..sources.tables import create_layer, rebuild, rebuild_view
from ..sources.versions import SLICE, read_history
from . import gold, silver
from .bronze import Sources, run_bronze

HISTORIES = {"competitions": s.COMPETITIONS, "matches": s.MATCHES, "events": s.EVENTS, "lineups": s.LINEUPS}
# histories whose changes reach a silver table
FED_BY = {"lineups": ["lineups"], "matches": ["matches", "events"], "combined": ["competitions", "matches", "events"]}


def run_silver(spark: SparkSession, bronze_layer: str = "bronze", silver_layer: str = "silver",
               views: Collection[str] = ("competitions", "events"), broadcast_bytes: int = BROADCAST_BYTES,
               whole: bool = False, buckets: int | None = None, rows_per_part: int = 2_000_000) -> set[str]:
    """Bring silver up to date with bronze: only the seasons that changed since the last run are built.

    Snapshots named in ``views`` become views instead of copies, by default the smallest and the largest. All other tables
    are partitioned by season. The match grain (``competition_matches``) is stored once: the event-grain
    table and the match-grain marts all start from it. Stored event-grain rows also carry their folded type and are sorted
    by it. ``whole`` builds every season again. Returns the slices of ``combined`` that were built.

    With ``buckets`` events are copied, dealt into that many buckets by match, as is the match grain, so that joining them needs no
    exchange when the grain is too large to broadcast. Matches beyond ``rows_per_part`` events are split over buckets.
    """
    if buckets:
        views = [v for v in views if v != "events"]
    tune(spark)
    create_layer(spark, silver_layer)
    by_match = (buckets, dealt.DEALT_BY) if buckets else None
    now = seasons.newest_attempts(spark, bronze_layer, list(HISTORIES))
    changed = None if whole else seasons.changed_slices(spark, silver_layer, now)

    def slices(target: str) -> set[str]:
        return set().union(*[(now if changed is None else changed)[h] for h in FED_BY[target]])

    def history(name: str, chosen: set[str]) -> DataFrame:
        return read_history(spark, f"{bronze_layer}.{name}", HISTORIES[name], chosen, tagged=name == "events")

    def copy(name: str) -> None:
        target = f"{silver_layer}.{name}"
        if name in views:
            columns = ", ".join(f"`{c}`" for c in HISTORIES[name].names)
            rebuild_view(spark, target, f"SELECT {columns} FROM {bronze_layer}.{name} WHERE {VALID_TO} IS NULL")
        elif name == "events":
            # events carry no season of their own: partitioned by the slice of their match
            chosen = slices("combined") if changed is None else changed["events"]
            if chosen:
                snapshot = silver.snapshot(history(name, chosen))
                if buckets:
                    snapshot = dealt.in_parts(snapshot, rows_per_part, s.EVENT_KEY)
                seasons.replace_seasons(snapshot, target, ["type", "match_id"], [SLICE], by_match)
        else:
            chosen = set(now[name]) if changed is None else changed[name]
            if chosen:
                many = name == "lineups"
                seasons.replace_seasons(silver.snapshot(history(name, chosen)), target, ["match_id"] if many else [], in_place=many)

    def combine() -> set[str]:
        copy("events")
        chosen = slices("matches")
        if chosen:
            matches = silver.silver_matches(history("matches", chosen), history("events", chosen))
            seasons.replace_seasons(matches, f"{silver_layer}.matches", ["match_id"])
        chosen = slices("combined")
        if not chosen:
            return chosen
        read = _reader(spark, silver_layer)
        parents = silver.snapshot(history("competitions", chosen))
        seasons.replace_seasons(silver.competition_matches(parents, seasons.of_slices(read("matches"), chosen)),
                                f"{silver_layer}.competition_matches", ["match_id"])
        grain = seasons.of_slices(read("competition_matches"), chosen)
        strategy = sized_strategy(grain, broadcast_bytes)
        if buckets:
            events = seasons.of_slices(read("events"), chosen, [SLICE])
            seasons.replace_seasons(dealt.for_each_part(grain, events), f"{silver_layer}.dealt_matches", buckets=by_match)
            built = silver.combined_in_parts(seasons.of_slices(read("dealt_matches"), chosen), events, strategy)
        else:
            built = silver.combined(grain, silver.snapshot(history("events", chosen)), strategy)
        # merged rows are written by the tasks that joined them; a broadcast grain leaves events in tasks as large as files, too many wide rows to sort
        seasons.replace_seasons(silver.with_folded_type(built), f"{silver_layer}.combined", s.COMBINED_CLUSTER, in_place=strategy != "broadcast")
        return chosen

    with seasons.only_written_partitions(spark):
        chosen = together(spark, combine, lambda: copy("competitions"), lambda: copy("lineups"))[0]
    seasons.note_built(spark, silver_layer, now)
    return chosen


def run_gold(spark: SparkSession, silver_layer: str = "silver", gold_layer: str = "gold",
             broadcast_bytes: int = BROADCAST_BYTES, whole: bool = False) -> set[str]:
    """Bring the seven marts up to date with silver, in dependency order: only the seasons that changed are built.

    Marts hold rows of one season each and are partitioned by it. What reaches beyond a season is kept in parts that can be
    merged: names of players and of stages by season. Where a merged name differs from before, the seasons it occurs in
    are built again too. Match-grain marts read the match grain rather than the event-grain table. Stored lookups are
    measured before they are broadcast. Returns the slices of ``combined_passes`` that were built.
    """
    tune(spark)
    create_layer(spark, gold_layer)
    slv, gld = _reader(spark, silver_layer), _reader(spark, gold_layer)
    now = seasons.built_from(spark, silver_layer)
    before = None if whole else seasons.changed_slices(spark, gold_layer, now)
    chosen = set().union(*(now if before is None else before).values())
    if not chosen:
        return chosen

    def small(df: DataFrame) -> DataFrame:
        return broadcast_if_small(df, broadcast_bytes)

    def replace(name: str, df: DataFrame, *cluster_by: str) -> None:
        seasons.replace_seasons(df, f"{gold_layer}.{name}", cluster_by)

    def some(layer_reader, name: str, slices: set[str] = chosen) -> DataFrame:
        return seasons.of_slices(layer_reader(name), slices)

    def players() -> DataFrame | None:
        replace("players_by_season", gold.best_names(some(slv, "lineups"), s.COMPETITION_KEY))
        rebuild(gold.merged_players(gld("players_by_season")), f"{gold_layer}.player_lookup")
        return _differing(spark, gold_layer, "player_lookup", ["player_id"])

    def playtime() -> None:
        together(spark, teams, durations)
        replace("combined_player_playtime", gold.combined_player_playtime(
            some(slv, "lineups"), small(some(gld, "durations_by_season").select("match_id", "game_end")), small(some(gld, "team_lookup"))))

    def teams() -> None:
        replace("team_lookup", gold.team_lookup(some(slv, "matches")))

    def durations() -> None:
        replace("durations_by_season", gold.match_duration_lookup(some(slv, "combined"), s.COMPETITION_KEY), "match_id")
        columns = gld("durations_by_season").drop(*s.COMPETITION_KEY).columns
        rebuild_view(spark, f"{gold_layer}.match_duration_lookup",
                     f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {gold_layer}.durations_by_season")

    def results() -> set[str]:
        replace("stages_by_season", gold.stage_names(some(slv, "competition_matches"), s.COMPETITION_KEY))
        stages = gld("stages_by_season").select("competition_stage", "competition_stage_ranking").distinct()
        rebuild(stages, f"{gold_layer}.stages")
        restaged = _differing(spark, gold_layer, "stages", ["competition_stage"])
        # a stage name of its own in one season shows in the results of all
        of_results = chosen if restaged is None else set().union(*now.values())
        replace("combined_results", gold.combined_results(seasons.of_slices(slv("competition_matches"), of_results), gld("stages")))
        return of_results

    def seasons_of_passes() -> set[str]:
        renamed, of_results = together(spark, players, results)
        of_passes = chosen | of_results
        if renamed is not None and before is not None:
            of_passes |= seasons.slices_with(gld("combined_passes"), renamed, {"player_id": ["player_id", "pass_recipient_id"]})
        return of_passes

    def passes() -> None:
        built = gold.combined_passes(some(slv, "combined", of_passes), small(gld("combined_results")), small(gld("player_lookup")))
        seasons.replace_seasons(built, f"{gold_layer}.combined_passes", in_place=True)

    def matches() -> None:
        replace("combined_matches", gold.combined_matches(some(slv, "competition_matches")), "match_id")

    with seasons.only_written_partitions(spark):
        of_passes = together(spark, seasons_of_passes, playtime, matches)[0]
        with seasons.files_at_once(spark):
            passes()
    for name in ("player_lookup", "stages"):
        rebuild(gld(name), f"{gold_layer}.{name}_built")
    seasons.note_built(spark, gold_layer, now)
    return of_passes


def _differing(spark: SparkSession, layer: str, name: str, keys: list[str]) -> DataFrame | None:
    """Keys of a lookup whose rows are not those the marts were last built with; None if there are none, or no marts.

    The comparison is with the copy that is written after the marts, so a run that stopped before that is made up for.
    """
    if not spark.catalog.tableExists(f"{layer}.{name}_built"):
        return None
    old, new = spark.table(f"{layer}.{name}_built"), spark.table(f"{layer}.{name}")
    differ, path = old.exceptAll(new).unionByName(new.exceptAll(old)).select(*keys).distinct(), scratch_path(spark, name)
    differ.write.parquet(path)
    stored = spark.read.schema(differ.schema).parquet(path)
    return None if stored.isEmpty() else stored


def run_pipeline(spark: SparkSession, sources: Sources, now: datetime,
                 competitions: Iterable[int] | None = None, season: int | None = None,
                 min_season: str | None = None,
                 layers: tuple[str, str, str] = ("bronze", "silver", "gold")) -> None:
    """Bronze load of all listed competitions in one pass, then silver, then gold."""
    run_bronze(spark, sources, now, layers[0], competitions, season, min_season)
    run_silver(spark, layers[0], layers[1])
    run_gold(spark, layers[1], layers[2])


def _reader(spark: SparkSession, layer: str):
    return lambda name: spark.table(f"{layer}.{name}")
