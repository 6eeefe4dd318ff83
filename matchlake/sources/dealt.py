"""Rows dealt into buckets by match, in parts where a match is large, so that joins on both need no exchange.

A bucket is one task of a join, and adaptive execution cannot split it. So the rows of a match beyond ``rows_per_part`` are told apart by a
second key, the part, and the table is bucketed by both. The other side of the join has a row for each part of a match.
Buckets lie inside the season partitions: the tables are still brought up to date season by season.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MATCH_KEY

PART, PARTS = "match_part", "match_parts"
DEALT_BY = [*MATCH_KEY, PART]
MOST_SPLIT = 100_000  # so many matches are split at most; their list is broadcast


def split_matches(rows: DataFrame, rows_per_part: int) -> DataFrame:
    """match_id and number of parts of the matches that are split.

    There are at most ``MOST_SPLIT`` of them: parts grow where the table is larger than that many parts.
    """
    counts = rows.groupBy(*MATCH_KEY).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1))).first()[0]
    size = max(rows_per_part, -(-total // MOST_SPLIT))
    return counts.filter((F.col("n") > size) & F.col(MATCH_KEY[0]).isNotNull()).select(
        *MATCH_KEY, F.ceil(F.col("n") / size).cast("int").alias(PARTS))


def in_parts(rows: DataFrame, rows_per_part: int, by: Sequence[str]) -> DataFrame:
    """Rows with the part of their match, dealt by the hash of the columns ``by``."""
    split = F.broadcast(split_matches(rows, rows_per_part))
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by]), F.coalesce(PARTS, F.lit(1))).cast("int")
    return rows.join(split, MATCH_KEY, "left").withColumn(PART, part).drop(PARTS)


def for_each_part(parents: DataFrame, dealt: DataFrame) -> DataFrame:
    """Parents once for each part that their match has in a dealt table, with the number of parts."""
    parts = dealt.filter(F.col(PART) > 0).groupBy(*MATCH_KEY).agg((F.max(PART) + 1).alias(PARTS))
    placed = parents.join(F.broadcast(parts), MATCH_KEY, "left").withColumn(PARTS, F.coalesce(PARTS, F.lit(1)))
    return placed.withColumn(PART, F.explode(F.sequence(F.lit(0), F.col(PARTS) - 1)))


def is_whole() -> Column:
    """Whether a parent of ``for_each_part`` stands there once. Split matches have details in any case."""
    return F.col(PARTS) == 1
