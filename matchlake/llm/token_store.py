"""Token ids of documents in Re-Pair compressed shards.

Layout: a Parquet folder, one row per shard, written by Spark so that a lost executor or a repeated
task leaves no half shard. All numbers in the binary columns are little-endian.

    part, shard      position of the shard: shards in (part, shard) order hold the documents in doc_id order
    doc_ids, starts  per document: its id, and its first symbol in ``symbols``
    n_ids            number of ids in the shard
    base             symbols below it are token ids, the others are rules
    rules            uint32 pairs: left and right symbol of rule 0, 1, ...
    expansions       uint32: number of ids behind each rule
    symbols          the compressed sequence: uint16 if all symbols fit, else uint32

A document ends with the end id and is a whole number of symbols, so any document, and any position
in it, is decoded by itself.

Edge cases: a null or empty text is the end id alone; null doc_ids come first; rows with the same
doc_id are ordered by the hash of their text and keep their own entries; a text larger than a shard is a
shard of its own; an empty table gives an empty folder; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .encoders import token_ids
from .packed import pack, release, slices
from .repair import Grammar, compress

SHARD = ("shard int, doc_ids array<long>, starts array<int>, n_ids long, base int, "
         "rules binary, expansions binary, symbols binary")


def write_tokens(documents: DataFrame, out: str, path: str, end_id: int, base: int,
                 shard_bytes: int = 6 << 20, slice_bytes: int = 1 << 20) -> None:
    """Encode (doc_id, text) with the vocabulary at ``path`` and write the shards to ``out``.

    ``base`` is larger than every id of the vocabulary; a shard holds about ``shard_bytes`` of text, of which
    ``slice_bytes`` are encoded at once.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, size = 0, [], 0
        for batch in batches:
            for part in slices(batch, "text", slice_bytes):
                ids, lengths = token_ids(part.column("text"), path)
                waiting.append((part.column("doc_id").to_pylist(), ids, lengths))
                size += int(pack(part.column("text"))[1][-1])
                if size >= shard_bytes:
                    yield _shard(number, waiting, end_id, base)
                    number, waiting, size = number + 1, [], 0
        if waiting:
            yield _shard(number, waiting, end_id, base)
        waiting = None
        release()

    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys)
    shards = dealt.mapInArrow(encode, SHARD)
    shards.select(F.spark_partition_id().alias("part"), "*").write.option("compression", "zstd").parquet(out)


def _shard(number: int, waiting: list, end_id: int, base: int) -> pa.RecordBatch:
    doc_ids = [d for docs, _, _ in waiting for d in docs]
    lengths = np.concatenate([n for _, _, n in waiting])
    ids = np.concatenate([i for _, i, _ in waiting]).astype(np.uint32)
    ends = np.cumsum(lengths + 1) - 1
    full = np.empty(int(ends[-1]) + 1, np.uint32)
    last = np.zeros(len(full), dtype=bool)
    last[ends] = True
    full[~last] = ids
    full[last] = end_id
    symbols, last, grammar = compress(full, last, base)
    starts = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    kind = "<u2" if base + len(grammar.left) <= 1 << 16 else "<u4"
    rules = np.column_stack([grammar.left, grammar.right]).astype("<u4")
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int32()), pa.array([doc_ids], pa.list_(pa.int64())),
        pa.array([starts.tolist()], pa.list_(pa.int32())), pa.array([len(full)], pa.int64()),
        pa.array([base], pa.int32()), pa.array([rules.tobytes()]),
        pa.array([grammar.expansions.astype("<u4").tobytes()]), pa.array([symbols.astype(kind).tobytes()]),
    ], ["shard", "doc_ids", "starts", "n_ids", "base", "rules", "expansions", "symbols"])


def open_shard(row: dict) -> tuple[np.ndarray, Grammar]:
    """Symbols and grammar of one shard row."""
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2).astype(np.int64)
    expansions = np.frombuffer(row["expansions"], "<u4").astype(np.int64)
    kind = "<u2" if row["base"] + len(rules) <= 1 << 16 else "<u4"
    return np.frombuffer(row["symbols"], kind), Grammar(row["base"], rules[:, 0], rules[:, 1], expansions)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, n_symbols: decoded from the shards."""
    table = spark.read.parquet(folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                symbols, grammar = open_shard(row)
                ids = grammar.decode(symbols).astype("<u4")
                symbol_ends = np.cumsum(grammar.lengths(symbols))
                starts = np.array(row["starts"], np.int64)
                heads = np.concatenate([[0], symbol_ends])[starts]
                tails = np.append(heads[1:], len(ids))
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * h:4 * t]) for h, t in zip(heads.tolist(), tails.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["before"]] * len(crc), pa.int64()), pa.array(row["doc_ids"], pa.int64()), pa.array(heads),
                     pa.array(tails - heads), pa.array(crc, pa.int64()),
                     pa.array(np.diff(np.append(starts, len(symbols))))],
                    ["before", "doc_id", "offset", "n_tokens", "ids_crc32", "n_symbols"])
        release()

    # one small row per shard: the ids in all shards before it
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = table.select("part", "shard", "n_ids")
    before = sizes.select("part", "shard", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    return table.drop("n_ids").join(before, ["part", "shard"]).mapInArrow(
        decode, "before long, doc_id long, offset long, n_tokens long, ids_crc32 long, n_symbols long",
    ).select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "n_symbols")
