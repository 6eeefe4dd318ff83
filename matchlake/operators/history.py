"""Incremental selection and versioned history (SCD2) on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import VALID_TO
from ..session import scratch_path
from .filters import is_current
from .joins import only_keys, parted_by_keys, sized_strategy, without_keys
from .shaping import naive, stamp_versions, version_clock


def watermark(history: DataFrame, column: str, scope: Sequence[str] = ()) -> DataFrame:
    """Newest loaded update time, overall or per scope."""
    return history.groupBy(*scope).agg(F.max(column).alias("watermark"))


def newer_rows(incoming: DataFrame, history: DataFrame | None, column: str,
               scope: Sequence[str] = ()) -> DataFrame:
    """Incoming rows strictly newer than the watermark of their scope.

    A scope that was never loaded (or an absent history) has no watermark and
    loads whole, rows without update time included; later loads drop those.
    """
    if history is None:
        return incoming
    mark = watermark(history, column, scope)
    if not scope:
        latest = mark.scalar()
        return incoming.filter(latest.isNull() | (F.col(column) > latest))
    joined = incoming.join(mark, list(scope), "left")
    fresh = F.col("watermark").isNull() | (F.col(column) > F.col("watermark"))
    return joined.filter(fresh).select(*incoming.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """One row per key, the one with the newest time.

    The ``rank <= 1`` filter is applied on each task before the shuffle, so a hot
    key sends one row per task. Ties go to the smallest row hash.
    """
    order = [F.col(newest).desc_nulls_last(), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def one_per_key(df: DataFrame, keys: Sequence[str], newest: str | None = None) -> DataFrame:
    """One row per key: the newest, or without an update time the one with the smallest row hash.

    Without an update time, rows with a NULL in the key are nobody's: of these only equal rows become one.
    """
    if newest:
        return latest_per_key(df, keys, newest)
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    named = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])
    # NULL keys are dealt by their content too, so that they are no hot key
    by = [*[F.col(f"`{k}`") for k in keys], F.when(~named, whole)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(whole)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def keys_sent_twice(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that a batch has twice, and keys with a NULL in them. Only the keys are shuffled."""
    counted = batch.groupBy(*[f"`{k}`" for k in keys]).agg(F.count(F.lit(1)).alias("_sent"))
    missing = reduce(Column.__or__, [F.col(f"`{k}`").isNull() for k in keys])
    return counted.filter((F.col("_sent") > 1) | missing).select(*[f"`{k}`" for k in keys])


def sent_twice(batch: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a batch has a key twice or a key with a NULL in it. Without such a key no row of the batch has to be dealt by key and ranked."""
    return not keys_sent_twice(batch, keys).isEmpty()


def parted_by_doubled(batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame | None, DataFrame]:
    """Rows of a stored batch among which ``one_per_key`` has to choose, and the rest.

    Only rows of keys that are sent twice have to be dealt by key and ranked, and a few others (``parted_by_keys``); None if no key is.
    """
    spark, path = batch.sparkSession, scratch_path(batch.sparkSession, "sent-twice")
    keys_sent_twice(batch, keys).write.parquet(path)
    doubled = spark.read.schema(batch.select(*[f"`{k}`" for k in keys]).schema).parquet(path)
    if doubled.isEmpty():
        return None, batch
    return parted_by_keys(batch, keys, doubled) or (batch, batch.limit(0))


def close_versions(history: DataFrame, incoming: DataFrame, keys: Sequence[str],
                   valid_to: datetime, restamp: bool = False) -> DataFrame:
    """Set the end time of the open versions whose key is incoming; NULL in a key equals NULL.

    Closed versions bypass the join; the incoming keys are measured for it. Where they are too many to broadcast, open versions
    whose key is not incoming bypass it too, but for a few (``parted_by_keys``). ``restamp`` also overwrites the end time
    of versions that were closed before.
    """
    sent = incoming.select(*[F.col(f"`{k}`").alias(f"hit.{k}") for k in keys])
    strategy = sized_strategy(sent)
    hits = sent.distinct().withColumn("_hit", F.lit(True)).hint(strategy)
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`hit.{k}`")) for k in keys]
    affected = history if restamp else history.filter(is_current())
    untouched = [] if restamp else [history.filter(~is_current())]
    parted = None if strategy == "broadcast" else parted_by_keys(affected, keys, incoming.select(*[f"`{k}`" for k in keys]))
    if parted:
        affected = parted[0]
        untouched.append(parted[1])
    stamped = affected.join(hits, same, "left").withColumn(
        VALID_TO, F.when(F.col("_hit"), naive(valid_to)).otherwise(F.col(VALID_TO))
    ).select(*history.columns)
    return reduce(DataFrame.unionByName, [*untouched, stamped])


def upsert_versions(history: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
                    now: datetime, newest: str | None = None,
                    restamp: bool = False) -> DataFrame:
    """Close the open versions of the incoming keys and append the new versions.

    A key delivered twice in one batch opens one version (``one_per_key``); ``newest`` names
    the update time by which it is chosen. A batch without such a key is not ranked, so its wide rows are not shuffled.
    """
    valid_from, valid_to = version_clock(now)
    single = one_per_key(incoming, keys, newest) if sent_twice(incoming, keys) else incoming
    fresh = stamp_versions(single, valid_from)
    if history is None:
        return fresh
    closed = close_versions(history, incoming, keys, valid_to, restamp)
    return closed.unionByName(fresh, allowMissingColumns=True)


def current_versions(history: DataFrame) -> DataFrame:
    """Open versions only; on the stored layout this is partition pruning."""
    return history.filter(is_current())


def changed_only(df: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cascade step: rows that belong to a changed parent."""
    return only_keys(df, changed, keys)


def merge_latest(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert without history: staged rows replace the target rows of their key."""
    kept = without_keys(target, stage, keys)
    return kept.unionByName(stage, allowMissingColumns=True)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions"))
    return counted.filter(F.col("versions") > 1)
