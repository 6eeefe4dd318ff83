"""Layer tables partitioned by competition and season, of which a run replaces only the seasons that changed.

What a layer was built from is kept in its table ``built``: the newest attempt of every slice of every history (see ``versions``). The seasons
whose attempts differ now are the changed ones. They are noted only after all tables are written, so a run that stopped half
way repeats its seasons. Partitions of other seasons keep their files.

Inside a season rows are sorted by the columns that readers filter on, so the minima and maxima that Parquet keeps of row groups and
pages let them skip the rest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import COMPETITION_KEY
from .versions import ATTEMPT, SLICE, committed, history_exists, slice_name

BUILT = "history string, slice string, attempt string"


def arranged(df: DataFrame, cluster_by: Sequence[str] = (), season: Sequence[str] = COMPETITION_KEY) -> DataFrame:
    """Rows of a season together, oversized seasons split, each part sorted. Without season columns parts are of even size."""
    return df.hint("rebalance", *season).sortWithinPartitions(*season, *cluster_by)


def replace_seasons(df: DataFrame, table: str, cluster_by: Sequence[str] = (), season: Sequence[str] = COMPETITION_KEY,
                    buckets: tuple[int, Sequence[str]] | None = None, in_place: bool = False) -> None:
    """Write the seasons of ``df`` in place of the stored ones; creates the table on first use.

    Seasons are replaced by dynamic partition overwrite: those without a row in ``df`` stay. A history only grows, so no season
    loses its last row. A table that is there without these columns or partitions is built anew. ``buckets`` (how many, by which
    columns) deals the rows of each season into that many files. ``in_place`` leaves the rows with the tasks that hold them, which
    write a file per season: wide rows that were just joined or read season by season are not shuffled once more.
    """
    spark = df.sparkSession
    if in_place:
        spread = df.sortWithinPartitions(*season, *cluster_by) if cluster_by else df
    else:
        spread = df.repartition(buckets[0], *buckets[1]) if buckets else arranged(df, cluster_by, season)
    if not fits(spark, table, df, season):
        writer = spread.write.mode("overwrite").partitionBy(*season)
        (writer.bucketBy(buckets[0], *buckets[1]).sortBy(*buckets[1]) if buckets else writer).saveAsTable(table)
        return
    order = [f"`{c}`" for c in spark.table(table).columns]
    with only_written_partitions(spark):
        spread.select(*order).write.mode("overwrite").insertInto(table)


@contextmanager
def only_written_partitions(spark: SparkSession) -> Iterator[None]:
    """Dynamic partition overwrite. The setting is the session's: around tables that are written at the same time it is set once."""
    with _set(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        yield


@contextmanager
def files_at_once(spark: SparkSession, most: int = 64) -> Iterator[None]:
    """Tasks keep a file open for each of up to ``most`` seasons, so that wide rows which come season by season are not sorted
    to be written. The setting is the session's: no other table is written meanwhile."""
    with _set(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most)):
        yield


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fits(spark: SparkSession, table: str, df: DataFrame, season: Sequence[str]) -> bool:
    """Whether a stored table has the columns of ``df`` and is partitioned by season."""
    if not spark.catalog.tableExists(table):
        return False
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    return parts == list(season) and sorted(spark.table(table).dtypes) == sorted(df.dtypes)


def newest_attempts(spark: SparkSession, layer: str, names: Sequence[str]) -> dict[str, dict[str, str]]:
    """Per history of a layer: the newest attempt of each slice. One row per slice reaches the driver."""
    return {name: {n: r[ATTEMPT] for n, r in committed(spark, f"{layer}.{name}").newest.items()} for name in names}


def changed_slices(spark: SparkSession, layer: str, now: dict[str, dict[str, str]]) -> dict[str, set[str]] | None:
    """Per history: slices whose attempt is not the one ``layer`` was built from; None if it was never built."""
    if not spark.catalog.tableExists(f"{layer}.built"):
        return None
    before = {(r["history"], r[SLICE]): r[ATTEMPT] for r in spark.table(f"{layer}.built").collect()}
    return {name: {n for n, attempt in slices.items() if before.get((name, n)) != attempt} for name, slices in now.items()}


def built_from(spark: SparkSession, layer: str) -> dict[str, dict[str, str]]:
    """Per history: the attempt of each slice from which a layer was built."""
    found: dict[str, dict[str, str]] = {}
    for r in spark.table(f"{layer}.built").collect():
        found.setdefault(r["history"], {})[r[SLICE]] = r[ATTEMPT]
    return found


def slices_with(df: DataFrame, keys: DataFrame, columns: dict[str, Sequence[str]], season: Sequence[str] = COMPETITION_KEY) -> set[str]:
    """Slices of a stored table in which one of the ``columns`` of a key holds a listed key. Reads these columns only."""
    found: set[str] = set()
    for key, names in columns.items():
        for name in names:
            hits = df.select(*season, F.col(name).alias(key)).join(keys.select(key), key, "left_semi")
            found |= {r[0] for r in hits.select(slice_name(season)).distinct().collect()}
    return found


def note_built(spark: SparkSession, layer: str, now: dict[str, dict[str, str]]) -> None:
    rows = [(name, n, attempt) for name, slices in now.items() for n, attempt in slices.items()]
    spark.createDataFrame(rows, BUILT).coalesce(1).write.mode("overwrite").saveAsTable(f"{layer}.built")


def of_slices(df: DataFrame, slices: set[str] | None, season: Sequence[str] = COMPETITION_KEY) -> DataFrame:
    """Rows of the given slices; the condition is on partition columns only, so other seasons are not read."""
    return df if slices is None else df.filter(slice_name(season).isin(sorted(slices)))


def is_history(spark: SparkSession, layer: str, names: Sequence[str]) -> bool:
    return all(history_exists(spark, f"{layer}.{name}") for name in names)
