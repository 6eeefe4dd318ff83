"""Encoders of the installed tokenizer libraries, one per worker process, behind the segment memo.

A vocabulary is named by its path: ``.json`` is read by tokenizers, ``.model`` by sentencepiece.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from .packed import pack
from .segments import SOLID_LAST, SOLID_NEXT, Memo, cuts

CHUNK_BYTES = 1 << 16
# fixed value: the words of the public CLIP vocabulary
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteLevel:
    """Byte-level BPE: a pre-token starts at a blank before a visible character, and behind letters and digits."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():  # every character of a token stands for one byte
            self.width[number] = len(token)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(b" " in token for token in self.special):
            raise ValueError(f"{path}: a special string with a blank, texts cannot be cut before blanks")
        self.memo = Memo(self._encode)

    def spans(self, data, offsets):
        raw = data.tobytes()
        plain = not any(token in raw for token in self.special)
        starts, first = cuts(data, offsets, None, SOLID_NEXT, behind_words=plain)
        return starts, np.append(starts[1:], len(data)), first

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in encoded]

    def _encode(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segments that start at a safe blank are encoded in chunks; token widths tell them apart again."""
        joined, single = [], []
        for i, s in enumerate(segments):
            (joined if len(s) > 1 and s[0] == 0x20 and SOLID_NEXT[s[1]] else single).append(i)
        order = np.array(joined + single, dtype=np.int64)
        sizes = np.array([len(segments[i]) for i in joined], dtype=np.int64)
        chunk = (np.cumsum(sizes) - sizes) // CHUNK_BYTES
        bounds = np.flatnonzero(np.diff(chunk, prepend=-1, append=-1))
        texts = [b"".join(segments[i] for i in joined[a:b]).decode() for a, b in zip(bounds[:-1], bounds[1:])]
        together = self._ids(texts)
        ids = np.concatenate(together) if together else np.empty(0, np.uint32)
        ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(sizes), side="right")
        alone = self._ids([segments[i].decode() for i in single])
        lengths = np.concatenate([np.diff(ends, prepend=0), np.fromiter(map(len, alone), np.int64, len(alone))])
        return np.concatenate([ids, *alone]), lengths, order

class Pieces:
    """sentencepiece BPE: no piece holds the blank sign after another character, and every text gets one in front.

    So a text may be cut before any blank that follows a visible character, and that blank is left to
    the one the library puts in front.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError(f"{path}: blanks inside pieces, texts cannot be cut before blanks")
        if self.model.encode("a", out_type=str)[0][0] != "▁" or self.model.encode("a  b") == self.model.encode("a b"):
            raise ValueError(f"{path}: its normalisation of blanks is not the expected one")
        self.memo = Memo(self._encode)

    def spans(self, data, offsets):
        starts, first = cuts(data, offsets, SOLID_LAST, None)
        ends = np.append(starts[1:], len(data))
        later = np.ones(len(starts), dtype=np.int64)
        later[first[:-1][first[:-1] < first[1:]]] = 0
        return starts + later, ends, first

    def _encode(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        encoded = self.model.encode([s.decode() for s in segments], num_threads=1)
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ids = np.fromiter(chain.from_iterable(encoded), np.uint32, int(lengths.sum()))
        return ids, lengths, np.arange(len(segments))


class Words:
    """BPE with word ends over words that a pattern finds; white space is dropped, texts are composed (NFC) and lower-cased.

    No word holds white space, a letter and a sign are never in one word, and neither composing nor lower-casing
    looks across them, so a text may be cut before any blank, and behind ASCII letters and digits before a sign.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(b" " in token for token in self.special):
            raise ValueError(f"{path}: a special string with a blank, texts cannot be cut before blanks")
        self.memo = Memo(self._encode)

    @staticmethod
    def fits(tokenizer) -> bool:
        """Whether a tokenizer is of this kind."""
        form = json.loads(tokenizer.to_str())
        normal = [n["type"] for n in (form["normalizer"] or {}).get("normalizers", [])]
        before = (form["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        return (form["model"].get("end_of_word_suffix") is not None and normal == ["NFC", "Replace", "Lowercase"]
                and form["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
                and [b.get("type") for b in before] == ["Split", "ByteLevel"] and before[0]["pattern"] == {"Regex": WORD_PATTERN}
                and before[0]["invert"] and before[0]["behavior"] == "Removed")

    def spans(self, data, offsets):
        raw = data.tobytes()
        plain = not any(token in raw for token in self.special)
        starts, first = cuts(data, offsets, None, None, behind_words=plain)
        return starts, np.append(starts[1:], len(data)), first

    def _encode(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast([s.decode() for s in segments], add_special_tokens=False)
        ids = [e.ids for e in encoded]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths, np.arange(len(segments))


class WholeTexts:
    """Any other vocabulary: whole texts, no cuts."""

    def __init__(self, path: str) -> None:
        self.inner = ByteLevel(path) if path.endswith(".json") else None
        if self.inner is None:
            raise ValueError(f"no library for {path}")
        self.memo = Memo(self._encode, limit=100_000)

    def spans(self, data, offsets):
        starts, first = cuts(data, offsets, np.zeros(256, dtype=bool), None)
        return starts, np.append(starts[1:], len(data)), first

    def _encode(self, segments):
        ids = self.inner._ids([s.decode() for s in segments])
        return np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids)), np.arange(len(ids))


@lru_cache(maxsize=4)
def encoder(path: str):
    """The encoder of a vocabulary; workers that Spark reuses keep it, with its memo, over tasks."""
    if path.endswith(".model"):
        return Pieces(path)
    from tokenizers import Tokenizer

    given = Tokenizer.from_file(path)
    kind = type(given.pre_tokenizer).__name__
    return ByteLevel(path) if kind == "ByteLevel" else Words(path) if Words.fits(given) else WholeTexts(path)


def encode_texts(texts: pa.Array, path: str):
    """(slots of all segments, first segment of each text, memo) of a batch of texts."""
    enc = encoder(path)
    data, offsets = pack(texts)
    starts, ends, first = enc.spans(data, offsets)
    return enc.memo.lookup(data, starts, ends), first, enc.memo


def token_lengths(texts: pa.Array, path: str) -> np.ndarray:
    """Number of tokens of each text."""
    slots, first, memo = encode_texts(texts, path)
    total = np.concatenate([[0], np.cumsum(memo.lengths(slots))])
    return total[first[1:]] - total[first[:-1]]


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts one after the other, and the number of each text."""
    slots, first, memo = encode_texts(texts, path)
    total = np.concatenate([[0], np.cumsum(memo.lengths(slots))])
    return memo.tokens(slots), total[first[1:]] - total[first[:-1]]
