"""Documents packed into sequences of a fixed number of tokens, by minimum bin slack.

A task encodes its documents as they come and packs them in groups of ``group_tokens``, so its memory is bounded and nothing is
shuffled. Documents longer than a sequence give whole sequences first. What remains of all documents of a group is a
multiset of lengths, from which each sequence is filled as close to the capacity as any choice can (``bin_slack``).
Slack that is left, because no choice fits, is filled by the head of the longest remaining document, which is cut there. The last,
incomplete sequence of a group opens the next group of the task. That of the whole task is cut at powers of two, where
sequences need no padding. So no sequence is padded, and a document is cut only where it is too long or nothing else fits.

Sequences are numbered by task and place in it. A task that is repeated on the same rows gives the same sequences; they count
once Spark has written them.

Edge cases: a null or empty text is the end id alone; null doc_ids are kept; rows with the same doc_id are packed each for
itself; a text of any length is encoded whole and cut; an empty table gives no sequence; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .bin_slack import Lengths, powers
from .encoders import token_ids
from .packed import pack, slices

SEQUENCES = ("sequence_id long, id_bytes int, ids binary, doc_ids array<long>, starts array<long>, "
             "lengths array<int>, doc_tokens array<long>")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

# document, first token in it, number of tokens
Piece = tuple[int, int, int]


class Group:
    """Documents that are packed together: their ids, and the pieces that are left of them by length."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.doc_ids: list[int | None] = []
        self.ids: list[np.ndarray] = []
        self.open: list[Piece] = []
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.open.append((len(self.ids), 0, len(ids)))
        self.doc_ids.append(doc_id)
        self.ids.append(ids)
        self.tokens += len(ids)

    def sequences(self) -> Iterator[list[Piece]]:
        """Full sequences; the pieces of the incomplete one are left in ``open``."""
        capacity, by_length = self.capacity, {}
        for doc, start, length in self.open:
            while length >= capacity:
                yield [(doc, start, capacity)]
                start, length = start + capacity, length - capacity
            if length:
                by_length.setdefault(length, []).append((doc, start, length))
        self.open = []
        left = Lengths()
        for length, pieces in by_length.items():
            left.counts[length] = len(pieces)
            pieces.reverse()  # taken from the end, so in the order of the documents
        left.keys = sorted(left.counts)
        while left.keys:
            picked, times = left.window(capacity)
            slack = capacity - sum(length * n for length, n in picked.items())
            for _ in range(times):
                window = [by_length[length].pop() for length, n in picked.items() for _ in range(n)]
                if slack and left.keys:  # whatever is left is longer than the slack, else it would be in the window
                    longest = left.longest()
                    left.take(longest, 1)
                    doc, start, _ = by_length[longest].pop()
                    window.append((doc, start, slack))
                    rest = (doc, start + slack, longest - slack)
                    by_length.setdefault(longest - slack, []).append(rest)
                    left.add(longest - slack)
                elif slack:
                    self.open = window
                    return
                yield window

    def carried(self) -> Group:
        """The next group of the task: it starts with what is open here."""
        group = Group(self.capacity)
        group.open = [(i, start, length) for i, (_, start, length) in enumerate(self.open)]
        group.doc_ids = [self.doc_ids[doc] for doc, _, _ in self.open]
        group.ids = [self.ids[doc] for doc, _, _ in self.open]
        group.tokens = sum(length for _, _, length in self.open)
        return group

    def tail(self) -> Iterator[list[Piece]]:
        """What is open, cut at powers of two."""
        pieces = list(reversed(self.open))
        for room in powers(sum(length for _, _, length in pieces)):
            window = []
            while room:
                doc, start, length = pieces.pop()
                part = min(room, length)
                window.append((doc, start, part))
                room -= part
                if part < length:
                    pieces.append((doc, start + part, length - part))
            yield window


def pack_sequences(documents: DataFrame, path: str, end_id: int, capacity: int = 4096,
                   group_tokens: int = 1 << 22, batch_bytes: int = 4 << 20) -> DataFrame:
    """Sequences of (doc_id, text): the ids and, piece by piece, which tokens of which document they are.

    ``path`` names the vocabulary, ``end_id`` follows every document. ``ids`` holds little-endian unsigned integers of
    ``id_bytes`` bytes each; ``starts`` counts the ids of the document before the piece, ``doc_tokens`` all of its ids.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        group = Group(capacity)

        def rows(windows: Iterator[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            waiting: list[list[Piece]] = []
            for window in windows:
                waiting.append(window)
                if len(waiting) == 256:
                    yield _rows(number, waiting, group)
                    number, waiting = number + len(waiting), []
            if waiting:
                yield _rows(number, waiting, group)
                number += len(waiting)

        for batch in batches:
            for part in slices(batch, "text", batch_bytes):
                ids, lengths = token_ids(part.column("text"), path)
                ends = np.cumsum(lengths)
                full = np.insert(ids, ends, end_id).astype(np.uint16 if max(ids.max(initial=0), end_id) < 1 << 16 else np.uint32)
                bounds = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]).tolist()
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), bounds[:-1], bounds[1:]):
                    group.add(doc_id, full[a:b])
                    if group.tokens >= group_tokens:
                        yield from rows(group.sequences())
                        group = group.carried()
        yield from rows(group.sequences())
        yield from rows(group.tail())

    given = documents.selectExpr("cast(doc_id as long) as doc_id", "text")
    return given.mapInArrow(fill, SEQUENCES)


def _rows(number: int, windows: list[list[Piece]], group: Group) -> pa.RecordBatch:
    wide = any(group.ids[doc].itemsize == 4 for window in windows for doc, _, _ in window)
    kind = "<u4" if wide else "<u2"
    ids = [np.concatenate([group.ids[doc][s:s + n] for doc, s, n in w]).astype(kind).tobytes() for w in windows]
    return pa.RecordBatch.from_arrays([
        pa.array(range(number, number + len(windows)), pa.int64()),
        pa.array([4 if wide else 2] * len(windows), pa.int32()), pa.array(ids, pa.binary()),
        pa.array([[group.doc_ids[doc] for doc, _, _ in w] for w in windows], pa.list_(pa.int64())),
        pa.array([[s for _, s, _ in w] for w in windows], pa.list_(pa.int64())),
        pa.array([[n for _, _, n in w] for w in windows], pa.list_(pa.int32())),
        pa.array([[len(group.ids[doc]) for doc, _, _ in w] for w in windows], pa.list_(pa.int64())),
    ], ["sequence_id", "id_bytes", "ids", "doc_ids", "starts", "lengths", "doc_tokens"])


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece of the sequences, with the crc32 of its ids as unsigned 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(raw.as_py(), f"<u{width.as_py()}").astype("<u4")
                   for raw, width in zip(batch.column("ids"), batch.column("id_bytes"))]
            lengths = batch.column("lengths")
            n = lengths.flatten().to_numpy().astype(np.int64)
            counts = lengths.value_lengths().to_numpy()
            raw = memoryview(np.concatenate([*ids, np.empty(0, "<u4")]).tobytes())
            ends = np.cumsum(n)
            crc = [zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), n.tolist())]
            heads = np.cumsum([len(i) for i in ids]) - [len(i) for i in ids]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_ids").flatten(), batch.column("starts").flatten(), pa.array(n), pa.array(crc, pa.int64()),
                batch.column("doc_tokens").flatten(), pa.array(np.repeat(batch.column("sequence_id").to_numpy(), counts)),
                pa.array(ends - n - np.repeat(heads, counts).astype(np.int64)),
            ], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return sequences.mapInArrow(digest, PIECES)
