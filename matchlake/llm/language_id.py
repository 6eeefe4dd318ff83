"""Language identification with error-correcting output codes.

Every language has a codeword of bits. One binary classifier per bit tells the languages with a one
from those with a zero: a linear model over hashed byte n-grams whose weights are the log odds of the n-gram counts
of both sides, counted over all training texts. A text gets the language whose codeword has the smallest
loss, a sum over the bits of the logistic loss of the classifier's margin, weighted by how well that classifier
does on each language in a sample of the training texts, about ``WEIGHT_ROWS`` different ones, whose margins are worked out
where they are read. A text whose two best languages lie
closer than ``margin`` is flagged as ambiguous.

Edge cases: null text, and text without a letter, is ``und`` with score 0; without any training text every text is ``und``;
with one language all other texts get that one; null lang is never learned from; repeated rows are learned from
and predicted each; texts of any length are read whole; other columns are ignored, and those named like a result
are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .counters import summed
from .packed import LOWER, keys, pack, release, slices

UND = "und"
ORDERS = (2, 3, 4)
BITS = 16
WEIGHT_ROWS = 2000


def codewords(classes: int) -> np.ndarray:
    """Rows of -1 / +1: all different splits up to 7 classes, beyond that seeded random ones."""
    if classes <= 7:
        splits = np.arange(1 << max(0, classes - 1)) | (1 << max(0, classes - 1))
        codes = (splits[None, :] >> np.arange(classes)[:, None]) & 1
        codes = codes[:, :-1] if classes > 1 else codes
    else:
        length = 12 * int(np.ceil(np.log2(classes)))
        codes = (keys(classes * length, 0x0C0DE).reshape(classes, length) >> np.uint64(63)).astype(np.int64)
        mixed = (codes.min(axis=0) == 0) & (codes.max(axis=0) == 1)
        codes = codes[:, mixed]
    return codes * 2 - 1


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each byte (of the shorter array of starts)."""
    n = len(data) - order + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    code = data[:n].astype(np.uint32)
    for k in range(1, order):
        code = (code << np.uint32(8)) | data[k:n + k]
    if order > 2:
        code *= np.uint32(0x9E3779B1)
        code >>= np.uint32(32 - BITS)
    return code


def inner(offsets: np.ndarray, order: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First n-gram of each text and the one after its last."""
    starts = np.minimum(offsets[:-1], n)
    return starts, np.maximum(starts, np.minimum(offsets[1:] - order + 1, n))


def count_grams(texts: pa.Array, label: np.ndarray, classes: int) -> np.ndarray:
    """Counts by class, order and bucket."""
    data, offsets = pack(texts)
    data = LOWER[data]
    out = np.zeros((classes, len(ORDERS), 1 << BITS), np.int64)
    lengthened = np.repeat(label.astype(np.int64), np.diff(offsets))
    for o, order in enumerate(ORDERS):
        code = grams(data, order)
        owner = lengthened[:len(code)].copy()
        for k in range(1, order):  # an n-gram may not run over the end of its text
            ends = offsets[1:] - k
            owner[ends[(ends >= offsets[:-1]) & (ends < len(code))]] = -1
        valid = owner >= 0
        cell = owner[valid] * (1 << BITS) + code[valid]
        out[:, o] += np.bincount(cell, minlength=classes << BITS).reshape(classes, -1)
    return out


def margins(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Mean log odds of each text, a column per bit. ``weights``: bit, order, bucket."""
    data, offsets = pack(texts)
    data = LOWER[data]
    total = np.zeros((len(offsets) - 1, weights.shape[0]))
    number = np.zeros(len(offsets) - 1)
    for o, order in enumerate(ORDERS):
        code = grams(data, order)
        starts, stops = inner(offsets, order, len(code))
        number += stops - starts
        for b in range(weights.shape[0]):
            sums = np.zeros(len(code) + 1)
            np.cumsum(weights[b, o][code], dtype=np.float64, out=sums[1:])
            total[:, b] += sums[stops] - sums[starts]
    return total / np.maximum(number, 1)[:, None]


class CodeModel:
    """Languages, their codewords, the bit classifiers and the weight of each bit for each language."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages = languages
        self.codes = codewords(len(languages))
        self.bit_weights = np.ones(self.codes.shape) / max(1, self.codes.shape[1])
        share = counts / np.maximum(counts.sum(axis=(1, 2), keepdims=True), 1)  # each language counts alike
        weights = []
        for b in range(self.codes.shape[1]):
            side = [share[self.codes[:, b] == s].sum(axis=0) for s in (1, -1)]
            smooth = [(x / max(x.sum(), 1e-12) + 1e-8) for x in side]
            weights.append(np.log(smooth[0] / smooth[1]) if len(languages) > 1 else np.zeros_like(smooth[0]))
        self.weights = np.array(weights, dtype=np.float32).reshape(self.codes.shape[1], *counts.shape[1:])
        self.scale = 8.0

    def losses(self, m: np.ndarray) -> np.ndarray:
        """Weighted loss of each text to each codeword."""
        loss = np.logaddexp(0, -self.scale * m[:, None, :] * self.codes[None, :, :])
        return (loss * self.bit_weights[None, :, :]).sum(axis=2)

    def weigh(self, m: np.ndarray, label: np.ndarray) -> None:
        """Weight of a bit for a language: how often its classifier is right there, above chance."""
        for c in range(len(self.languages)):
            if (label == c).any():
                right = (np.sign(m[label == c]) == self.codes[c]).mean(axis=0)
                w = np.maximum(right - 0.5, 0.01)
                self.bit_weights[c] = w / w.sum()

    def predict(self, m: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score (0 to 1) and ambiguity of each text."""
        loss = self.losses(m)
        belief = np.exp(loss.min(axis=1, keepdims=True) - loss)
        belief /= belief.sum(axis=1, keepdims=True)
        ordered = np.sort(loss, axis=1)
        gap = ordered[:, 1] - ordered[:, 0] if loss.shape[1] > 1 else np.full(len(loss), np.inf)
        return loss.argmin(axis=1), belief.max(axis=1), gap < margin


def held_out(doc_id, modulus: int = 4, remainder: int = 2):
    """Whether crc32 of the id, as text, leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def train(labelled: DataFrame, batch_bytes: int = 4 << 20) -> CodeModel | None:
    """Learn from all rows of (text, lang) with a lang. None if there is nothing to learn from.

    The driver gets the number of texts of each language, one count for each language and bucket, and the margins of the sample.
    """
    labelled = labelled.select("text", "lang").filter("lang is not null and text is not null")
    rows = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(rows)
    if not languages:
        return None
    place = {lang: i for i, lang in enumerate(languages)}
    shape = (len(languages), len(ORDERS), 1 << BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(shape, np.int64)
        for batch in batches:
            for part in slices(batch, "text", batch_bytes):
                label = np.array([place[x] for x in part.column("lang").to_pylist()])
                total += count_grams(part.column("text"), label, len(languages))
        return total.ravel()

    flat = summed(labelled, count, int(np.prod(shape)))
    model = CodeModel(languages, flat.reshape(shape))
    sample = sampled_margins(labelled, model, min(1.0, WEIGHT_ROWS / sum(rows.values())), batch_bytes).collect()
    if sample:
        model.weigh(np.array([r["margins"] for r in sample]).reshape(len(sample), -1), np.array([place[r["lang"]] for r in sample]))
    return model


def sampled_margins(labelled: DataFrame, model: CodeModel, share: float, batch_bytes: int) -> DataFrame:
    """lang, hash, margins: one row per language and different text among this share of all text hashes. No text is moved."""
    shared = labelled.sparkSession.sparkContext.broadcast(model.weights)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", batch_bytes):
                found = list(margins(part.column("text"), shared.value))
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("hash"), pa.array(found, pa.list_(pa.float64()))], ["lang", "hash", "margins"])
        release()

    hashed = labelled.select("lang", F.xxhash64("text").alias("hash"), "text")
    below = hashed.filter(F.col("hash") <= F.lit(min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))))
    found = below.mapInArrow(measure, "lang string, hash long, margins array<double>")
    return found.groupBy("lang", "hash").agg(F.first("margins").alias("margins"))


def has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predict(documents: DataFrame, model: CodeModel | None, margin: float = 0.05, batch_bytes: int = 4 << 20) -> DataFrame:
    """The columns of the documents and lang_pred, score, ambiguous. Only the text is looked at."""
    documents = documents.drop("lang_pred", "score", "ambiguous")
    known = documents.withColumn("has#letter", has_letter())
    if model is None:
        return known.drop("has#letter").select("*", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        names = np.array(found.languages, dtype=object)
        for batch in batches:
            for part in slices(batch, "text", batch_bytes):
                best, score, unsure = found.predict(margins(part.column("text"), found.weights), margin)
                letter = part.column("has#letter").to_numpy(zero_copy_only=False).astype(bool)
                kept = [part.column(i) for i, n in enumerate(part.schema.names) if n != "has#letter"]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(np.where(letter, names[best], UND), pa.string()), pa.array(np.where(letter, score, 0.0)),
                     pa.array(unsure & letter)],
                    [*(n for n in part.schema.names if n != "has#letter"), "lang_pred", "score", "ambiguous"])
        release()

    schema = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes)
    return known.mapInArrow(run, f"{schema}, lang_pred string, score double, ambiguous boolean")
