"""Sums of large arrays of counts that every task fills for its rows."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

KIND = "slice long, part long, counts binary"


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts in the narrowest of 1, 2, 4 or 8 bytes, compressed: most counts of a task are very small."""
    width = next(w for w in (1, 2, 4, 8) if int(counts.max(initial=0)) < 1 << min(8 * w, 63))
    return bytes([width]) + zlib.compress(counts.astype(f"<u{width}").tobytes(), 1)


def unpacked_counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(memoryview(raw)[1:]), f"<u{raw[0]}").astype(np.int64)


def summed(rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int,
           finish: Callable[[np.ndarray], np.ndarray] = lambda counts: counts, slices: int = 64) -> np.ndarray:
    """The sum over all partitions of what ``count`` makes of each, an array of fixed ``size``, passed through ``finish``.

    Arrays are cut into slices and added in two steps, first within groups of about the square root of all
    partitions, so that no task reads more than that many arrays' slices. ``finish`` works on each slice in its
    task; the driver gets one array of what it returns.
    """
    groups = max(1, math.isqrt(rows.rdd.getNumPartitions()))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % groups
        for k, piece in enumerate(np.array_split(count(batches), slices)):
            yield _row(k, part, packed_counts(piece))

    def added(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, int], np.ndarray]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, part, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                counts = unpacked_counts(raw)
                if (k, part) in total:
                    total[k, part] += counts
                else:
                    total[k, part] = counts
        return total

    def within_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (k, _), counts in added(batches).items():
            yield _row(k, 0, packed_counts(counts))

    def over_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (k, _), counts in added(batches).items():
            yield _row(k, 0, finish(counts).tobytes())

    grouped = rows.mapInArrow(fill, KIND).repartition("slice", "part").mapInArrow(within_groups, KIND)
    done = sorted(grouped.repartition("slice").mapInArrow(over_groups, KIND).collect(), key=lambda r: r["slice"])
    kind = finish(np.zeros(1, np.int64)).dtype
    return np.concatenate([np.frombuffer(r["counts"], kind) for r in done]) if done else finish(np.zeros(size, np.int64))


def _row(k: int, part: int, counts: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k], pa.int64()), pa.array([part], pa.int64()), pa.array([counts], pa.binary())], ["slice", "part", "counts"])
