"""Match clock: ``MM:SS`` labels, seconds inside a period, stint length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_END = "Half End"

# Period, column prefix, minute on the clock at which it starts.
PERIODS = ((1, "h1", 0), (2, "h2", 45), (3, "et1", 90), (4, "et2", 105))


def clock_label(minute: Column, second: Column) -> Column:
    """Zero padded ``MM:SS``; a missing part prints as 00."""
    return F.concat(_two_digits(minute), F.lit(":"), _two_digits(second))


def _two_digits(number: Column) -> Column:
    number = F.coalesce(number, F.lit(0))
    text = number.cast("string")
    return F.when(number.between(0, 9), F.concat(F.lit("0"), text)).otherwise(text)


def period_seconds(minute: Column, second: Column, start_minute: int) -> Column:
    return (minute - F.lit(start_minute)) * 60 + second


def is_half_end(period: int | None = None) -> Column:
    half_end = F.col("type") == HALF_END
    return half_end if period is None else (F.col("period") == period) & half_end


def label_minute(label: Column) -> Column:
    return F.get(F.split(label, ":"), F.lit(0)).try_cast("int")


def label_second(label: Column) -> Column:
    return F.get(F.split(label, ":"), F.lit(1)).try_cast("int")


def stint_start(part) -> Column:
    """Start minute or second (``part`` reads it from a label): kick-off or sub on."""
    return F.when(F.col("starting_xi") == 1, F.lit(0)).when(
        F.col("sub_on").isNotNull(), part(F.col("sub_on"))
    )


def stint_end(part) -> Column:
    """End minute or second: final whistle, else sub off, else red card."""
    red = F.col("removed_due_to_red_card")
    return (
        F.when(F.col("ended_game") == 1, part(F.col("game_end")))
        .when(F.col("sub_off").isNotNull(), part(F.col("sub_off")))
        .when(red.isNotNull(), part(red))
    )


def seconds_played() -> Column:
    end = F.col("end_minute") * 60 + F.col("end_second")
    return end - (F.col("start_minute") * 60 + F.col("start_second"))
