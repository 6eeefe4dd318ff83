"""Pass geometry and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bound of the end x, name and rank of each third.
THIRDS = ((80, "Final 3rd", 1.0), (40, "Middle 3rd", 2.0), (0, "Defensive 3rd", 3.0))


def coordinate(location: Column, axis: int) -> Column:
    """Coordinate ``axis`` (0 = x, 1 = y) of ``[x, y]`` text, NULL if it is not a list."""
    bracketed = F.when(location.like("[%,%]"), F.btrim(location, F.lit("[]")))
    if axis:
        bracketed = F.substring_index(bracketed, ",", axis + 1)
        return F.substring_index(bracketed, ",", -1).try_cast("double")
    return F.substring_index(bracketed, ",", 1).try_cast("double")


def half_label(period: Column) -> Column:
    return F.when(period == 1, F.lit("1st Half")).otherwise(F.lit("2nd Half"))


def outcome_or_success(outcome: Column) -> Column:
    return F.coalesce(outcome, F.lit("Success"))


def direction(angle: Column) -> Column:
    forward = F.cos(angle)
    return (
        F.when(forward > 0, F.lit("Forward"))
        .when(forward < 0, F.lit("Backward"))
        .otherwise(F.lit("Lateral"))
    )


def third_name(end_x: Column) -> Column:
    """Third of the pitch; outside it the x value itself as text."""
    named = F
    for bound, name, _ in THIRDS:
        named = named.when(end_x >= bound, F.lit(name))
    return named.otherwise(end_x.cast("string"))


def third_rank(end_x: Column) -> Column:
    ranked = F
    for bound, _, rank in THIRDS:
        ranked = ranked.when(end_x >= bound, F.lit(rank))
    return ranked.otherwise(end_x)


def flag(col: Column) -> Column:
    """Boolean to 0 / 1 with NULL as 0."""
    return F.coalesce(col, F.lit(False)).cast("int")


def equal_flag(left: Column, right: Column) -> Column:
    return F.when(left == right, F.lit(1)).otherwise(F.lit(0))
