"""Match-shaped Spark frames over the driver tables."""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake import schemas as s
from matchlake.operators.joins import sized_strategy
from matchlake.operators.lineups import flatten_lineups
from matchlake.operators.shaping import align, naive, version_clock
from matchlake.plans import gold, silver
from matchlake.session import scratch_path

from . import columns as c

RAW_CONTRACT = s.contract("""
    bigint     order_id
    string     name
    bigint     amount
    double     ratio
    boolean    flagged
    timestamp  seen
    json       payload
    string     not_delivered
""")
STRICT_CONTRACT = s.contract("""
    bigint     order_id amount
    double     ratio
    timestamp  seen
""")
FIRST_LOAD = datetime(2024, 2, 1)
SECOND_LOAD = datetime(2024, 3, 1)


_STORED: dict[tuple[str, str, str], str] = {}


def exprs(rules: dict[str, str]) -> list[str]:
    return [f"{text} AS `{name}`" for name, text in rules.items()]


def stored(build):
    """Property whose frame is written once per session to the shared scratch folder.

    The pipelines read stored layers, not the derivation of their sources, so
    every query starts from tables like they do.
    """
    @cached_property
    def frame(self) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, build.__name__)
        if key not in _STORED:
            path = scratch_path(self.spark, build.__name__)
            build(self).write.parquet(path)
            _STORED[key] = path
        return self.spark.read.parquet(_STORED[key])

    return frame


def sparse(rules: dict[str, str]):
    """Like ``stored``, for a frame most of whose columns are typed NULLs: only the columns in ``rules`` are written,
    the others come back as NULLs by the schema it is read with."""
    def wrap(build):
        @cached_property
        def frame(self) -> DataFrame:
            key = (self.spark.sparkContext.applicationId, self.sf_dir, build.__name__)
            df = build(self)
            if key not in _STORED:
                path = scratch_path(self.spark, build.__name__)
                df.select(*[f"`{n}`" for n in df.columns if n in rules]).write.parquet(path)
                _STORED[key] = path
            return self.spark.read.schema(df.schema).parquet(_STORED[key])

        return frame

    return wrap


def layered(cluster_by: list[str], season: list[str]):
    """Like ``stored``, laid out as silver does it: partitioned by season, sorted inside.

    Each task sorts its own rows and writes a file per season: wide rows are not shuffled a second time for fewer files."""
    def wrap(build):
        @cached_property
        def frame(self) -> DataFrame:
            key = (self.spark.sparkContext.applicationId, self.sf_dir, build.__name__)
            df = build(self)
            if key not in _STORED:
                path = scratch_path(self.spark, build.__name__)
                df.sortWithinPartitions(*season, *cluster_by).write.partitionBy(*season).parquet(path)
                _STORED[key] = path
            # partition values are read as declared, not as their text suggests
            return self.spark.read.schema(df.schema).parquet(_STORED[key])

        return frame

    return wrap


class Bridge:
    """Source frames and layers over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def spread(self, name: str) -> DataFrame:
        """Table whose rows reach all cores: one with fewer partitions than cores
        (one row group per file at test size) is repartitioned, a large one is not."""
        df, cores = self.table(name), self.spark.sparkContext.defaultParallelism
        return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)

    def scratch_schema(self) -> str:
        """A fresh schema in the shared scratch folder."""
        path = scratch_path(self.spark, "check")
        name = "check_" + path.rsplit("-", 1)[1]
        self.spark.sql(f"CREATE SCHEMA {name} LOCATION '{path}'")
        return name

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def _nation(self, prefix: str) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias(f"{prefix}_key"),
            F.col("n_name").alias(f"{prefix}_name"),
            F.col("n_regionkey").alias(f"{prefix}_region"),
        )

    def _with_teams(self, df: DataFrame, home: str, away: str) -> DataFrame:
        df = df.withColumns({"h_key": F.expr(home), "a_key": F.expr(away)})
        return df.join(self._nation("h"), "h_key").join(self._nation("a"), "a_key")

    @cached_property
    def raw(self) -> DataFrame:
        return self.table("orders").selectExpr(*exprs(c.RAW))

    @sparse(c.MATCH)
    def matches(self) -> DataFrame:
        """Source matches (no version columns)."""
        orders = self.table("orders")
        season = Window.partitionBy("competition_id", "season_id").orderBy(F.desc("o_orderkey"))
        # the place filter is applied on each task before the shuffle, so the
        # window sees 16 rows per task and season; its result is 16 per season
        top = orders.select(
            "o_orderkey",
            F.expr(c.COMPETITION_OF_ORDER).alias("competition_id"),
            F.expr(c.SEASON_OF_ORDER).alias("season_id"),
        ).withColumn("place", F.row_number().over(season)).filter("place <= 16")
        region = self.table("region").select(
            F.col("r_regionkey").cast("bigint").alias("r_key"), "r_name"
        )
        placed = self.spread("orders").join(F.broadcast(top.select("o_orderkey", "place")), "o_orderkey", "left")
        placed = placed.withColumn("r_key", F.expr(c.COMPETITION_OF_ORDER)).join(region, "r_key")
        full = self._with_teams(placed, c.HOME_OF_ORDER, c.AWAY_OF_ORDER)
        return align(full.selectExpr(*exprs(c.MATCH)), s.MATCHES_SOURCE)

    @stored
    def competitions(self) -> DataFrame:
        *plain, updated = exprs(c.COMPETITION)
        found = self.matches.groupBy(*c.COMPETITION_GROUP).agg(F.expr(updated)).selectExpr(
            *plain, "match_updated"
        )
        empty = self.spark.range(1).selectExpr(*exprs(c.EMPTY_COMPETITION))
        return align(found, s.COMPETITIONS_SOURCE).unionByName(
            align(empty, s.COMPETITIONS_SOURCE)
        )

    def _event_rows(self, *order: str) -> DataFrame:
        """Line events and half ends, the rows of each task by ``order``: they are sorted while they are narrow."""
        def shaped(df: DataFrame, rules: dict[str, str]) -> DataFrame:
            rows = df.sortWithinPartitions(*[F.expr(rules[name]) for name in order]) if order else df
            return align(rows.selectExpr(*exprs(rules)), s.EVENTS_SOURCE)

        lines = self._with_teams(self.spread("lineitem"), c.HOME_OF_LINE, c.AWAY_OF_LINE)
        halves = self.spread("orders").withColumn(
            "p", F.explode(F.sequence(F.lit(1), F.expr(f"CASE WHEN {c.EXTRA_TIME} THEN 4 ELSE 2 END")))
        )
        halves = self._with_teams(halves, c.HOME_OF_ORDER, c.AWAY_OF_ORDER)
        return shaped(lines, c.EVENT).unionByName(shaped(halves, c.HALF_END))

    @sparse(c.EVENT | c.HALF_END)
    def events(self) -> DataFrame:
        """Source events: line events and half ends."""
        return self._event_rows()

    @cached_property
    def line_events(self) -> DataFrame:
        """Source events worked out where they are read: a query that takes few of their columns has none of the others written."""
        return self._event_rows()

    @cached_property
    def line_combined(self) -> DataFrame:
        """The event grain joined where it is read: a query that takes some of its rows and columns shuffles only these and has none written."""
        return silver.with_folded_type(silver.combined(self.match_grain, self.line_events, sized_strategy(self.match_grain)))

    @cached_property
    def stint_kinds(self) -> DataFrame:
        """Lines reduced to at most 80 stint kinds per match and player.

        The lines are shuffled once, as narrow rows by match: what follows groups and joins inside the match.
        """
        lines = self.spread("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
        keyed = lines.repartition("l_orderkey").selectExpr(
            *exprs(c.STINT_KEYS), "l_suppkey", "l_partkey", "l_quantity"
        )
        return keyed.groupBy(*c.STINT_KEYS).agg(*map(F.expr, exprs(c.STINT_VALUES)))

    @stored
    def lineups(self) -> DataFrame:
        """Source lineups: one row per match and player with nested cards and positions."""
        def packed(rules: dict[str, str], shape: T.StructType):
            fields = [F.expr(rules[n]).alias(n) if n in rules
                      else F.lit(None).cast(shape[n].dataType).alias(n) for n in shape.names]
            return F.struct(*fields)

        nested = self.stint_kinds.groupBy("match_id", "player_id").agg(
            F.max("name_pad").alias("name_pad"),
            F.collect_list(packed(c.STINT, s.STINT)).alias("positions"),
            F.collect_list(F.when(F.col("card_kind") < 3, packed(c.CARD, s.CARD))).alias("cards"),
        )
        matches = self.matches.select(
            "match_id", "competition_id", "season_id", "home_team", "away_team"
        )
        # Spark takes the compressed file for the size of the matches and would broadcast millions of them
        return nested.join(matches.hint("shuffle_hash"), "match_id").selectExpr(
            "competition_id", "season_id", "match_id",
            "CASE WHEN player_id % 2 = 0 THEN home_team ELSE away_team END AS team",
            "player_id",
            *exprs(c.PLAYER_ATTRIBUTES),
            "cards",
            "positions",
        )

    # --- layers -----------------------------------------------------------------

    def open_versions(self, df: DataFrame) -> DataFrame:
        return df.withColumns({s.VALID_FROM: naive(FIRST_LOAD), s.VALID_TO: naive(None)})

    @cached_property
    def bronze_competitions(self) -> DataFrame:
        return self.open_versions(self.competitions)

    @cached_property
    def bronze_matches(self) -> DataFrame:
        """Open versions, and for some matches an older closed version."""
        earlier = self.matches.filter("match_id % 7 = 0").withColumns({
            "home_score": F.col("home_score") + 1,
            s.VALID_FROM: naive(datetime(2024, 1, 1)),
            s.VALID_TO: naive(version_clock(FIRST_LOAD)[1]),
        })
        return self.open_versions(self.matches).unionByName(earlier)

    @cached_property
    def bronze_events(self) -> DataFrame:
        return self.open_versions(self.events)

    def _flat_lineups(self) -> DataFrame:
        return align(self.open_versions(flatten_lineups(self.lineups)), s.LINEUPS)

    @stored
    def bronze_lineups(self) -> DataFrame:
        return self._flat_lineups()

    @stored
    def silver_matches(self) -> DataFrame:
        # shoot-outs take few columns of few events: they are read from the lines, and no event has to be written for them
        return silver.silver_matches(self.bronze_matches, self.open_versions(self._event_rows()))

    @stored
    def match_grain(self) -> DataFrame:
        return silver.competition_matches(self.competitions, self.silver_matches)

    @layered(s.COMBINED_CLUSTER, s.COMPETITION_KEY)
    def combined(self) -> DataFrame:
        return silver.with_folded_type(silver.combined(self.match_grain, self.events, sized_strategy(self.match_grain)))

    @sparse(c.EVENT | c.HALF_END)
    def events_by_type(self) -> DataFrame:
        """Events as the history stores them: sorted by type."""
        return self._event_rows("type", "match_id")

    @stored
    def players(self) -> DataFrame:
        # names alone: Spark leaves the cards and positions of the players out, which a stored layer would hold
        return gold.player_lookup(self._flat_lineups())

    @stored
    def teams(self) -> DataFrame:
        return gold.team_lookup(self.silver_matches)

    @stored
    def durations(self) -> DataFrame:
        return gold.match_duration_lookup(self.events)

    @stored
    def results(self) -> DataFrame:
        return gold.combined_results(self.match_grain)

    # --- two batches of a changing table ------------------------------------------

    @cached_property
    def first_batch(self) -> DataFrame:
        return self.table("orders").filter(c.FIRST_BATCH).selectExpr(*exprs(c.CHANGE))

    @cached_property
    def loaded(self) -> DataFrame:
        """History after the first load: open rows, some with an older closed version."""
        older = self.first_batch.filter("match_id % 11 = 0").withColumns({
            "status": F.lit("OLD"),
            s.VALID_FROM: naive(datetime(2024, 1, 1)),
            s.VALID_TO: naive(version_clock(FIRST_LOAD)[1]),
        })
        return self.open_versions(self.first_batch).unionByName(older)

    @cached_property
    def second_batch(self) -> DataFrame:
        """Redelivery of everything: a fifth changed, new rows, the rest as before."""
        changed = f"{c.FIRST_BATCH} AND o_orderkey % 5 = 0"
        base = self.table("orders").selectExpr(*exprs(c.CHANGE), f"{changed} AS changed")
        later = F.expr("last_updated + INTERVAL '2000' DAY")
        return base.select(
            "match_id", "competition_id", "season_id",
            F.when(F.col("changed"), F.lit("U")).otherwise(F.col("status")).alias("status"),
            F.when(F.col("changed"), later).otherwise(F.col("last_updated")).alias("last_updated"),
        )
