"""Batch encoding of distinct text segments between safe boundaries.

A text is cut before blanks where no token of the vocabulary can cross, every
distinct segment of a batch is encoded once by the tokenizer library, and the
results are put together again per text. Segments seen before by the same worker
come from a memo of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .packed import flags, ranges, span_hashes

BLANK = 0x20
# after a blank: ASCII letters and signs, and lead bytes of blocks without white space characters
SOLID_NEXT = flags([*range(0x21, 0x7F), *range(0xC3, 0xE1), *range(0xE4, 0xF5)])
ALNUM = flags([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)])
SIGN = flags([*range(0x09, 0x0E), *range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])
# before a blank: ASCII letters and signs, and last bytes of characters other than U+2581
SOLID_LAST = flags([*range(0x21, 0x7F), 0x80, *range(0x82, 0xC0)])

# texts to (ids one text after the other, number of ids of each, the order in which the texts were taken)
Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]


def cuts(data: np.ndarray, offsets: np.ndarray, before_ok: np.ndarray | None,
         next_ok: np.ndarray | None, behind_words: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all segments, and the first segment of each text. Empty texts have none.

    Cuts lie before blanks with an accepted byte on either side; ``behind_words`` adds those
    between an ASCII letter or digit and a sign or white space other than a blank.
    """
    n = len(data)
    cut = np.zeros(n, dtype=bool)
    if n > 2:
        cut[1:-1] = data[1:-1] == BLANK
        if before_ok is not None:
            cut[1:-1] &= before_ok[data[:-2]]
        if next_ok is not None:
            cut[1:-1] &= next_ok[data[2:]]
        if behind_words:
            cut[1:-1] |= SIGN[data[1:-1]] & ALNUM[data[:-2]]
    # neither neighbour of a cut may belong to another text
    edges = offsets[1:][offsets[1:] > 0] - 1
    cut[edges] = False
    edges = offsets[:-1][offsets[:-1] < n]
    cut[edges] = True
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(starts, offsets)


class Memo:
    """Encoded segments by hash: token ids and lengths of each, at most ``limit`` segments.

    An open hash table of two arrays: a free slot is -1, a collision moves on by one. When it is
    full it starts anew; that costs time, never results.
    """

    def __init__(self, encode: Encode, limit: int = 1_500_000) -> None:
        self.encode, self.limit = encode, limit
        self.size = 1 << max(10, (2 * limit).bit_length())
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(self.size, np.uint64)
        self.slots = np.full(self.size, -1, np.int32)
        self.starts, self.ids = [np.zeros(1, np.int64)], [np.empty(0, np.uint32)]
        self.count = self.total = 0

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each hash or -1, and the place in the table where it is or would be."""
        place = (hashes & np.uint64(self.size - 1)).astype(np.int64)
        slot = self.slots[place]
        open_ = np.flatnonzero((slot >= 0) & (self.hashes[place] != hashes))
        while len(open_):
            place[open_] = (place[open_] + 1) & (self.size - 1)
            slot[open_] = self.slots[place[open_]]
            open_ = open_[(slot[open_] >= 0) & (self.hashes[place[open_]] != hashes[open_])]
        return slot, place

    def _insert(self, hashes: np.ndarray, slots: np.ndarray) -> None:
        """Put distinct new hashes into the table; those that meet on one place try again."""
        while len(hashes):
            _, place = self._find(hashes)
            self.slots[place] = slots
            self.hashes[place] = hashes
            lost = self.slots[place] != slots
            hashes, slots = hashes[lost], slots[lost]

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slot of each segment; unknown ones are encoded, each distinct one once."""
        hashes = span_hashes(data, starts, ends)
        slot, _ = self._find(hashes)
        new = np.flatnonzero(slot < 0)
        if len(new):
            distinct, example = np.unique(hashes[new], return_index=True)
            if self.count and self.count + len(distinct) > self.limit:
                self.clear()
                return self.lookup(data, starts, ends)
            if 2 * (self.count + len(distinct)) > self.size:  # one batch larger than the memo
                self.size = 1 << (4 * len(distinct)).bit_length()
                self.clear()
            example = new[example]
            raw = data.tobytes()
            texts = [raw[s:e] for s, e in zip(starts[example].tolist(), ends[example].tolist())]
            ids, lengths, order = self.encode(texts)
            self._insert(distinct[order], np.arange(self.count, self.count + len(distinct), dtype=np.int32))
            self.starts.append(self.total + np.cumsum(lengths))
            self.ids.append(ids.astype(np.uint32))
            self.count, self.total = self.count + len(distinct), self.total + len(ids)
            slot[new] = self._find(hashes[new])[0]
        return slot

    def _whole(self, parts: list[np.ndarray]) -> np.ndarray:
        if len(parts) > 1:
            parts[:] = [np.concatenate(parts)]
        return parts[0]

    def lengths(self, slots: np.ndarray) -> np.ndarray:
        starts = self._whole(self.starts)
        return starts[slots + 1] - starts[slots]

    def tokens(self, slots: np.ndarray) -> np.ndarray:
        """Ids of the segments one after the other."""
        return self._whole(self.ids)[ranges(self._whole(self.starts)[slots], self.lengths(slots))]
