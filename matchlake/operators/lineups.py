"""Nested lineups to one row per match and player."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lineups as lx
from ..schemas import LINEUP_KEY
from .filters import relevant_stints

STINT_PARTS = ["position_id", "position", "from", "to", "from_period", "to_period",
               "start_reason", "end_reason"]


def exploded(lineups: DataFrame, column: str, alias: str) -> DataFrame:
    """One row per list element; an empty or missing list gives one NULL row."""
    return lineups.select(*LINEUP_KEY, F.explode_outer(column).alias(alias))


def card_rows(lineups: DataFrame) -> DataFrame:
    """Exploded cards with their fields spread by card type."""
    rows = exploded(lineups, "cards", "card")
    return rows.select(*LINEUP_KEY, *_named(lx.card_fields(F.col("card"))))


def stint_rows(lineups: DataFrame) -> DataFrame:
    """Exploded position stints as flat columns."""
    rows = exploded(lineups, "positions", "stint")
    return rows.select(*LINEUP_KEY, *[F.col("stint")[p].alias(p) for p in STINT_PARTS])


def stint_flags(stints: DataFrame) -> DataFrame:
    """Playing flags of the relevant stints."""
    rows = relevant_stints(stints)
    parts = F.struct(*[F.col(f"`{p}`") for p in STINT_PARTS])
    return rows.select(*LINEUP_KEY, *_named(lx.stint_fields(parts)))


def card_summary(lineups: DataFrame) -> DataFrame:
    """Largest value of each card column per match and player with a card."""
    carded = lineups.filter(F.size("cards") > 0)
    return _max_per_player(carded.select(*LINEUP_KEY, *_row_cards()), lx.CARD_COLUMNS)


def stint_summary(lineups: DataFrame) -> DataFrame:
    """Settled playing flags per match and player with a relevant stint."""
    played = lineups.filter(_has_relevant_stint())
    flags = _max_per_player(played.select(*LINEUP_KEY, *_row_stints()), lx.STINT_COLUMNS)
    return flags.withColumns(lx.settle_stints())


def flatten_lineups(lineups: DataFrame) -> DataFrame:
    """Nested lineup rows to scalar columns, one output row per input row.

    Lists are reduced inside their row, before the one shuffle, and then over all rows of a match and player: a
    player listed twice in a match gets the summary of both rows. Players without a relevant stint keep NULL flags,
    and rows without a player are nobody's: they keep NULL in all of them.
    """
    columns = [*lx.CARD_COLUMNS, *lx.STINT_COLUMNS, "_played"]
    rest = [name for name in lineups.columns if name not in (*LINEUP_KEY, *columns, "cards", "positions")]
    named = lineups.withColumn("player_nickname", lx.nickname())
    flat = named.select(*LINEUP_KEY, *rest, *_row_cards(), *_row_stints(), _has_relevant_stint().alias("_played"))
    player = Window.partitionBy(*LINEUP_KEY)
    named_player = F.col(LINEUP_KEY[0]).isNotNull() & F.col(LINEUP_KEY[1]).isNotNull()
    summed = flat.select(*LINEUP_KEY, *rest, *[F.when(named_player, F.max(name).over(player)).alias(name) for name in columns])
    settled = {name: F.when(F.col("_played"), col) for name, col in lx.settle_stints().items()}
    return summed.withColumns(settled).drop("_played")


def _row_cards() -> list[Column]:
    return _row_maxima("cards", lx.card_fields)


def _row_stints() -> list[Column]:
    return _row_maxima("positions", lx.stint_fields)


def _row_maxima(column: str, fields) -> list[Column]:
    """Largest value of each derived field over the elements of one list."""
    def largest(name: str) -> Column:
        return F.array_max(F.transform(column, lambda element: fields(element)[name]))

    names = lx.CARD_COLUMNS if column == "cards" else lx.STINT_COLUMNS
    return [largest(name).alias(name) for name in names]


def _has_relevant_stint() -> Column:
    relevant = F.exists(
        "positions", lambda stint: lx.is_relevant(stint["start_reason"], stint["end_reason"])
    )
    return F.coalesce(relevant, F.lit(False))


def _max_per_player(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.groupBy(*LINEUP_KEY).agg(*[F.max(name).alias(name) for name in columns])


def _named(columns: dict) -> list[Column]:
    return [col.alias(name) for name, col in columns.items()]
