"""Stored version history.

A history ``t`` consists of two tables and a view:

    t_rows    the rows, partitioned by end time, slice (competition and season) and attempt
    t_loads   the committed state: per slice its newest attempt and the newest update time in it, partitioned by commit number
    t         the committed rows

An attempt writes, for the slices it touches, all open rows and the versions it closes, beside what is there;
nothing is overwritten. It counts once its state is written as the next commit number, in one file: from then on the open rows of
a slice are those of its newest attempt, and the closed rows are those of all attempts up to that number. An attempt
that stops before its commit leaves files nobody reads; the next load removes them. Slices a load does not touch keep their files.

Neither storage nor the view grows with the number of loads: after a commit the superseded open rows and commits are removed
(``keep`` of them stay for readers that are still at work), and attempts are numbered, so that one comparison instead of a list tells
which closed rows count. What stays for ever is the history itself, each closed version once.

Keys are compared null-safe: a key column may be NULL. A key sent twice in a batch opens one version: the newest, or without an update
time the one with the smallest row hash; rows with a NULL in the key are told apart by their whole content. One load at a time may run per history.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.history import one_per_key, parted_by_doubled, sent_twice  # noqa: F401
from ..operators.joins import sized_strategy
from ..operators.shaping import align, naive, stamp_versions, version_clock
from ..schemas import VALID_FROM, VALID_TO

SLICE, ATTEMPT, MARK, NUMBER = "slice", "attempt", "watermark", "number"


class DoubledKeys(ValueError):
    """A load would have left several open versions of a key; it was not committed."""


@dataclass(frozen=True)
class Committed:
    """Newest state row of each slice (slice, attempt, slice columns, watermark), and the number of commits."""

    newest: dict[str, Row]
    number: int

    def condition(self, slices: Iterable[str] | None = None, closed: bool = True) -> str:
        """SQL condition for the committed rows, on partition columns only."""
        chosen = sorted(self.newest if slices is None else set(slices) & set(self.newest))
        pairs = [f"{name}/{self.newest[name][ATTEMPT]}" for name in chosen]
        parts = [f"{VALID_TO} IS NULL AND concat_ws('/', {SLICE}, {ATTEMPT}) IN ({_literals(pairs)})"] if pairs else []
        if closed and self.number:
            only = "" if slices is None else f" AND {SLICE} IN ({_literals(chosen)})" if chosen else " AND false"
            parts.append(f"{VALID_TO} IS NOT NULL AND {ATTEMPT} < '{numbered(self.number + 1)}'{only}")
        return " OR ".join(f"({p})" for p in parts) or "false"


def numbered(number: int) -> str:
    """Text of a commit number that sorts like it; attempts start with it."""
    return f"{number:010d}"


def create_history(spark: SparkSession, table: str, declared: T.StructType, slice_by: Sequence[str] = (),
                   looked_up: Sequence[str] = ()) -> None:
    """The two tables of a history. Files hold a Bloom filter of every column in ``looked_up``, sized by what is in them."""
    bloom = {f"parquet.bloom.filter.enabled#{c}": "true" for c in looked_up}
    bloom |= {"parquet.bloom.filter.adaptive.enabled": "true"} if bloom else {}
    options = f" OPTIONS ({', '.join(f'{k!r} = {v!r}' for k, v in bloom.items())})" if bloom else ""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in declared.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table}_rows ({columns}, {SLICE} string, {ATTEMPT} string) USING parquet{options} "
        f"PARTITIONED BY ({VALID_TO}, {SLICE}, {ATTEMPT})"
    )
    parts = "".join(f"`{name}` {declared[name].dataType.simpleString()}, " for name in slice_by)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table}_loads ({SLICE} string, {ATTEMPT} string, {parts}{MARK} timestamp_ntz, "
              f"{NUMBER} bigint) USING parquet PARTITIONED BY ({NUMBER})")


def committed(spark: SparkSession, table: str) -> Committed:
    """What counts now: one row per slice reaches the driver."""
    loads = spark.table(f"{table}_loads")
    number = loads.agg(F.max(NUMBER)).first()[0] or 0
    rows = loads.filter(F.col(NUMBER) == number).drop(NUMBER).collect() if number else []
    return Committed({r[SLICE]: r for r in rows}, number)


def history_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(f"{table}_loads")


def read_history(spark: SparkSession, table: str, declared: T.StructType, slices: Iterable[str] | None = None,
                 tagged: bool = False) -> DataFrame:
    """The committed rows, optionally of some slices only, whose partitions alone are read.

    ``tagged`` adds the name of the slice.
    """
    rows = spark.table(f"{table}_rows").filter(committed(spark, table).condition(slices))
    return rows.select(*_cols(declared.names), *([SLICE] if tagged else []))


def watermarks(spark: SparkSession, table: str, column: str, slice_by: Sequence[str]) -> DataFrame:
    """Newest update time of each slice, as ``column`` beside the slice columns.

    It was stored with the commit: the rows themselves are not read.
    """
    loads = spark.table(f"{table}_loads")
    number = loads.agg(F.max(NUMBER)).first()[0] or 0
    return loads.filter(F.col(NUMBER) == number).select(*_cols(slice_by), F.col(MARK).alias(column))


def load_versions(spark: SparkSession, table: str, incoming: DataFrame, declared: T.StructType,
                  keys: Sequence[str], slice_by: Sequence[str], now: datetime,
                  newest: str | None = None, cluster_by: Sequence[str] = (), looked_up: Sequence[str] = (), keep: int = 0,
                  at_once: bool = True) -> Callable[..., Callable[[], None]]:
    """Close the open versions of the incoming keys and add the new ones.

    ``slice_by`` names columns of ``incoming`` that are part of the key or fixed by it. ``incoming`` is read
    several times: pass a stored batch. ``newest`` names the update time; its maximum per slice is stored with the
    commit. Rows are sorted by ``cluster_by`` in their files, so that readers that filter on these columns
    skip what they do not need; files tell by Bloom filters which values of the columns in ``looked_up`` they lack. ``keep`` superseded attempts of a slice are left for readers that still use them.

    Without ``at_once`` the rows are written and verified, and count once the returned function is called. Called with False it
    only commits and returns what is left to do: to point the view at the rows and to drop what they replaced.
    """
    create_history(spark, table, declared, [c for c in slice_by if c in declared.names], looked_up)
    state = committed(spark, table)
    remove_unfinished(spark, table, state)
    valid_from, valid_to = version_clock(now)
    sliced = incoming.withColumn(SLICE, slice_name(slice_by))
    named = [c for c in slice_by if c in declared.names]
    touched = sorted(sliced.select(SLICE, *[F.col(f"`{c}`").cast(declared[c].dataType).alias(c) for c in named]).distinct().collect())
    if touched:
        with_slice = T.StructType([*declared.fields, T.StructField(SLICE, T.StringType())])
        doubled, single = parted_by_doubled(sliced, keys)
        if doubled is not None:
            single = single.unionByName(one_per_key(doubled, keys, newest))
        fresh = align(stamp_versions(single, valid_from), with_slice)
        names = [r[SLICE] for r in touched]
        open_rows = spark.table(f"{table}_rows").filter(state.condition(names, closed=False)).drop(ATTEMPT)
        # keys are compared as declared
        sent = align(incoming, declared).select(*[F.col(f"`{k}`").alias(f"hit.{k}") for k in keys])
        hits = sent.distinct().withColumn("hit", F.lit(True)).hint(sized_strategy(sent))
        same = reduce(Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(f"`hit.{k}`")) for k in keys])
        marked = open_rows.join(hits, same, "left")
        hit = F.coalesce("hit", F.lit(False))
        kept = marked.filter(~(hit & (F.col(VALID_FROM) == naive(valid_from)))).withColumn(
            VALID_TO, F.when(hit, naive(valid_to)).otherwise(F.col(VALID_TO)))
        attempt = f"{numbered(state.number + 1)}-{uuid.uuid4().hex[:12]}"
        order = spark.table(f"{table}_rows").columns
        result = kept.select(*_cols(fresh.columns)).unionByName(fresh).withColumn(ATTEMPT, F.lit(attempt))
        # rebalance splits an oversized slice and merges small ones per write
        spread = result.select(*_cols(order)).hint("rebalance", VALID_TO, SLICE)
        spread.sortWithinPartitions(*_cols([VALID_TO, SLICE, ATTEMPT, *cluster_by])).write.mode("append").insertInto(f"{table}_rows")
        marks = verified(spark, table, attempt, keys, newest)
        fresh_state = {r[SLICE]: Row(slice=r[SLICE], attempt=attempt, **{c: r[c] for c in named}, watermark=marks.get(r[SLICE])) for r in touched}

    def tidy() -> None:
        publish(spark, table, declared)
        if touched:
            remove_superseded(spark, table, [(r[SLICE], r[ATTEMPT]) for n, r in state.newest.items() if n in fresh_state], keep)

    def finish(whole: bool = True) -> Callable[[], None]:
        if touched:
            commit(spark, table, {**state.newest, **fresh_state}, state.number + 1)
        if whole:
            tidy()
        return tidy

    if at_once:
        finish()
    return finish


def verified(spark: SparkSession, table: str, attempt: str, keys: Sequence[str], newest: str | None) -> dict[str, datetime | None]:
    """Newest update time of each slice an attempt wrote, after making sure that it opened each key once.

    Reads the key columns and the update time of the attempt; one row per slice reaches the driver.
    """
    open_rows = spark.table(f"{table}_rows").filter((F.col(ATTEMPT) == attempt) & F.col(VALID_TO).isNull())
    mark = F.max(newest) if newest else F.lit(None).cast("timestamp_ntz")
    per_key = open_rows.groupBy(SLICE, *_cols(keys)).agg(F.count(F.lit(1)).alias("versions"), mark.alias(MARK))
    whole = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])
    per_slice = per_key.groupBy(SLICE).agg(F.max(F.when(whole, F.col("versions"))).alias("versions"), F.max(MARK).alias(MARK)).collect()
    doubled = [r[SLICE] for r in per_slice if (r["versions"] or 1) > 1]
    if doubled:
        raise DoubledKeys(f"{table}: several open versions of a key in {', '.join(sorted(doubled)[:5])}; the load was not committed")
    return {r[SLICE]: r[MARK] for r in per_slice}


def commit(spark: SparkSession, table: str, newest: dict[str, Row], number: int) -> None:
    """Make an attempt count: the whole state as one file of the next number, so it is there or it is not."""
    shape = T.StructType([f for f in spark.table(f"{table}_loads").schema.fields if f.name != NUMBER])
    rows = spark.createDataFrame([tuple(r[n] for n in shape.names) for r in newest.values()], shape)
    spark.sql(f"INSERT OVERWRITE TABLE {table}_loads PARTITION ({NUMBER} = {number}) SELECT * FROM {{rows}}", rows=rows.coalesce(1))


def publish(spark: SparkSession, table: str, declared: T.StructType) -> None:
    """Point the view at the committed rows."""
    columns = ", ".join(_cols(declared.names))
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {columns} FROM {table}_rows "
              f"WHERE {committed(spark, table).condition()}")


def remove_superseded(spark: SparkSession, table: str, replaced: Sequence[tuple[str, str]], keep: int = 0) -> None:
    """Drop what a commit replaced: open rows of earlier attempts of its slices, and earlier states.

    With ``keep`` the partitions of a slice are listed, and that many attempts before the newest stay.
    """
    for name, attempt in replaced:
        gone = [attempt]
        if keep:
            held = spark.table(f"{table}_rows").filter(F.col(VALID_TO).isNull() & (F.col(SLICE) == name) & (F.col(ATTEMPT) <= attempt))
            gone = sorted(r[0] for r in held.select(ATTEMPT).distinct().collect())[:-keep]
        for old in gone:
            _drop_partition(spark, f"{table}_rows", {VALID_TO: None, SLICE: name, ATTEMPT: old})
    numbers = sorted(r[0] for r in spark.table(f"{table}_loads").select(NUMBER).distinct().collect())
    for number in numbers[:-1 - keep]:
        _drop_partition(spark, f"{table}_loads", {NUMBER: number})


def remove_unfinished(spark: SparkSession, table: str, state: Committed) -> None:
    """Drop what attempts wrote that stopped before their commit. Only their own partitions are listed."""
    dead = spark.table(f"{table}_rows").filter(F.col(ATTEMPT) >= numbered(state.number + 1))
    for row in dead.select(VALID_TO, SLICE, ATTEMPT).distinct().collect():
        _drop_partition(spark, f"{table}_rows", row.asDict())


def _drop_partition(spark: SparkSession, table: str, values: dict) -> None:
    def literal(value) -> str:
        return "NULL" if value is None else str(value) if isinstance(value, int) else _literals([str(value)])

    spec = ", ".join(f"{name} = {literal(value)}" for name, value in values.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def slice_name(columns: Sequence[str]) -> Column:
    return F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in columns])


def _literals(texts: Sequence[str]) -> str:
    return ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in texts)


def _cols(names: Sequence[str]) -> list[str]:
    return [f"`{name}`" for name in names]
