"""Lineup expressions over exploded cards and position stints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Card types by column prefix, and the reasons a stint starts or ends.
CARD_TYPES = {
    "first_yellow": "Yellow Card",
    "second_yellow": "Second Yellow",
    "red_card": "Red Card",
}
CARD_FIELDS = ("time", "reason", "period")
STARTED = "Starting XI"
SUB_ON = "Substitution - On"
SUB_OFF = "Substitution - Off"
SENT_OFF = "Foul Committed (Red Card)"
FINISHED = "Final Whistle"

CARD_COLUMNS = [f"{prefix}_{field}" for prefix in CARD_TYPES for field in CARD_FIELDS]
STINT_COLUMNS = ["starting_xi", "sub_off", "sub_on", "removed_due_to_red_card", "ended_game"]


def nickname() -> Column:
    return F.coalesce(F.col("player_nickname"), F.col("player_name"))


def card_fields(card: Column) -> dict[str, Column]:
    """Time, reason and period of a card under the prefix of its type, NULL elsewhere."""
    return {
        f"{prefix}_{field}": F.when(card["card_type"] == kind, card[field])
        for prefix, kind in CARD_TYPES.items()
        for field in CARD_FIELDS
    }


def stint_fields(stint: Column) -> dict[str, Column]:
    """Playing flags of a stint: started, sub times, red-card time, finished."""
    start, end = stint["start_reason"], stint["end_reason"]
    one = F.lit(1).cast("bigint")
    return {
        "starting_xi": F.when(start == STARTED, one),
        "sub_off": F.when(end.contains(SUB_OFF), stint["to"]),
        "sub_on": F.when(start.contains(SUB_ON), stint["from"]),
        "removed_due_to_red_card": F.when(end == SENT_OFF, stint["to"]),
        "ended_game": F.when(end == FINISHED, one),
    }


def is_relevant(start: Column, end: Column) -> Column:
    """Stint that starts or ends play; other reasons and NULL count as false."""
    hit = (
        (start == STARTED) | start.contains(SUB_ON)
        | end.contains(SUB_OFF) | (end == SENT_OFF) | (end == FINISHED)
    )
    return F.coalesce(hit, F.lit(False))


def settle_stints() -> dict[str, Column]:
    """After grouping: a red card means not finished; missing flags become 0."""
    zero = F.lit(0).cast("bigint")
    finished = F.when(F.col("removed_due_to_red_card").isNotNull(), zero)
    return {
        "starting_xi": F.coalesce(F.col("starting_xi"), zero),
        "ended_game": F.coalesce(finished.otherwise(F.col("ended_game")), zero),
    }
