"""Benchmark decontamination by a broadcast set of benchmark windows.

Benchmark texts are cut into windows of consecutive words (a shorter item is one window). The set of window
hashes goes to every task, which slides over the words of its documents, looks every window up by hash and
confirms hits on the words themselves. Windows are counted first: a set beyond ``block`` windows is
taken in blocks of that size, one step over the documents each, so that no broadcast grows with the benchmark.

Edge cases: null and empty texts have no words and are clean; items without words match nothing; item texts
that repeat all count; an item with null id counts as the empty string; repeated rows are each returned; an empty
table or benchmark gives no hits; other columns of the documents are kept by ``clean``, not by ``scan``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packed import LOWER, NOT_ALNUM, keys, mix, pack, release, slices, span_hashes, word_spans
from .scratch import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FACTOR = np.uint64(int(keys(1, 0x77)[0]) | 1)
INVERSE = np.uint64(pow(int(FACTOR), -1, 1 << 64))


def item_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """window (its words joined by blanks), n (its words), items (sorted ids): one row per distinct window."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (width - 1)))
    windows = items.select("item", "words", F.explode(starts).alias("at")).select(
        "item", F.slice("words", F.col("at"), F.lit(width)).alias("w"))
    return windows.groupBy(F.array_join("w", " ").alias("window"), F.size("w").alias("n")).agg(
        F.array_sort(F.collect_set("item")).alias("items"))


def _powers(count: int, base: np.uint64) -> np.ndarray:
    out = np.ones(max(count, 1), np.uint64)
    if count > 1:
        np.multiply.accumulate(np.full(count - 1, base, np.uint64), out=out[1:])
    return out


class WindowSet:
    """Window hashes of a block of benchmark windows, by number of words."""

    def __init__(self, windows: list[str], items: list[list[str]]) -> None:
        self.windows = {w: i for w, i in zip(windows, items)}
        texts = pa.array(windows, pa.large_string())
        sums, first = _prefix(*pack(texts))[2:]
        sizes = np.diff(first)
        self.by_size = {int(n): np.unique(_window_hashes(sums, first[:-1][sizes == n], int(n)))
                        for n in np.unique(sizes)}
        self.tables = {}
        for n, hashes in self.by_size.items():
            self.tables[n] = np.zeros(1 << 20, dtype=bool)
            self.tables[n][hashes >> np.uint64(44)] = True


def _prefix(data: np.ndarray, offsets: np.ndarray):
    """Word starts and ends, prefix sums of word hashes times powers, and first words of the texts."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, NOT_ALNUM)
    hashes = span_hashes(data, starts, ends)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(len(hashes), FACTOR))])
    return starts, ends, sums, first


def _window_hashes(sums: np.ndarray, at: np.ndarray, n: int, inverse: np.ndarray | None = None) -> np.ndarray:
    inverse = _powers(len(sums), INVERSE) if inverse is None else inverse
    return mix((sums[at + n] - sums[at]) * inverse[at])


def hits(texts: pa.Array, found: WindowSet) -> Iterator[tuple[int, int, int, str]]:
    """(text, first word of the window in the text, words, window) of every confirmed occurrence."""
    data, offsets = pack(texts)
    starts, ends, sums, first = _prefix(data, offsets)
    inverse = _powers(len(sums), INVERSE)
    for n, hashes in found.by_size.items():
        at = np.arange(max(0, len(starts) - n + 1))
        h = _window_hashes(sums, at, n, inverse)
        at = at[found.tables[n][h >> np.uint64(44)]]
        at = at[np.isin(h[at], hashes)]
        text = np.searchsorted(first, at, side="right") - 1
        inside = at + n <= first[text + 1]
        for i, t in zip(at[inside].tolist(), text[inside].tolist()):
            window = " ".join(LOWER[data[s:e]].tobytes().decode() for s, e in zip(starts[i:i + n], ends[i:i + n]))
            if window in found.windows:
                yield t, i - int(first[t]), n, window


HIT = {"hit#n_words": "long", "hit#words": "array<int>", "hit#spans": "array<struct<first:int,stop:int>>", "hit#items": "array<string>"}


def marked(documents: DataFrame, benchmark: DataFrame, width: int = 10, block: int = 200_000,
           batch_bytes: int = 8 << 20) -> DataFrame:
    """The columns of the documents and those of ``HIT``: number of words, words that are hit, their byte ranges, sorted item ids."""
    spark = documents.sparkSession
    windows = stored(item_windows(benchmark, width), "windows")
    blocks = max(1, -(-windows.count() // block))
    out = documents
    for k in range(blocks):
        rows = windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).collect()  # about ``block`` rows
        shared = spark.sparkContext.broadcast(([r["window"] for r in rows], [r["items"] for r in rows]))
        schema = ", ".join(f"`{n}` {t}" for n, t in {**dict(documents.dtypes), **HIT}.items())
        out = out.mapInArrow(_scanner(shared, batch_bytes), schema)
    return out


def _scanner(shared, batch_bytes: int):
    built: list[WindowSet] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not built:
            built.append(WindowSet(*shared.value))
        for batch in batches:
            for part in slices(batch, "text", batch_bytes):
                yield _scan_batch(part, built[0])
        release()

    return run


def _scan_batch(part: pa.RecordBatch, found: WindowSet) -> pa.RecordBatch:
    texts = part.column("text")
    data, offsets = pack(texts)
    starts, ends, first = word_spans(LOWER[data], offsets, NOT_ALNUM)
    by_text: dict[int, tuple[set, set]] = {}
    names = part.schema.names
    if "hit#words" in names:  # hits of the blocks before
        for t, (words, items) in enumerate(zip(part.column("hit#words").to_pylist(), part.column("hit#items").to_pylist())):
            if words:
                by_text[t] = (set(words), set(items))
    for t, at, n, window in hits(texts, found):
        words, items = by_text.setdefault(t, (set(), set()))
        words.update(range(at, at + n))
        items.update(found.windows[window])
    words_out, spans_out, items_out = [], [], []
    for t in range(part.num_rows):
        words, items = by_text.get(t, ((), ()))
        words = sorted(words)
        spans: list[dict] = []
        for k, w in enumerate(words):
            s, e = int(starts[first[t] + w] - offsets[t]), int(ends[first[t] + w] - offsets[t])
            if k and words[k - 1] == w - 1:
                spans[-1]["stop"] = e
            else:
                spans.append({"first": s, "stop": e})
        words_out.append(words)
        spans_out.append(spans)
        items_out.append(sorted(items))
    given = [n for n in names if n not in HIT]
    return pa.RecordBatch.from_arrays(
        [*(part.column(n) for n in given), pa.array(np.diff(first)), pa.array(words_out, pa.list_(pa.int32())),
         pa.array(spans_out, pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))),
         pa.array(items_out, pa.list_(pa.string()))],
        [*given, *HIT])


def scan(documents: DataFrame, benchmark: DataFrame, width: int = 10, block: int = 200_000) -> DataFrame:
    """doc_id, n_words, n_hit, spans (first byte, byte after the last), items (sorted ids): one row per row of (doc_id, text)."""
    found = marked(documents.select("doc_id", "text"), benchmark, width, block)
    return found.select("doc_id", F.col("`hit#n_words`").alias("n_words"), F.size("`hit#words`").alias("n_hit"),
                        F.col("`hit#spans`").alias("spans"), F.col("`hit#items`").alias("items"))


def clean(documents: DataFrame, benchmark: DataFrame, width: int = 10, spans: bool = False, block: int = 200_000) -> DataFrame:
    """Documents without contamination: hit documents go, or with ``spans`` only the words that were hit.

    Documents keep all their columns; the text is the only one that changes.
    """
    found = marked(documents, benchmark, width, block)
    if spans:
        found = found.withColumn("text", _cut(F.col("text"), F.col("`hit#spans`")))
    else:
        found = found.filter(F.size("`hit#words`") == 0)
    return found.select(*[F.col(f"`{c}`") for c in documents.columns])


def digest(items) -> F.Column:
    """Lower-case SHA-256 of the item ids, joined by commas."""
    return F.sha2(F.array_join(items, ","), 256)


def _cut(text, spans):
    """Text without the byte ranges, which are ascending and do not overlap."""
    raw = F.encode(text, "UTF-8")
    piece = lambda start, stop: F.decode(F.substring(raw, start + 1, stop - start), "UTF-8")
    zero = F.struct(F.lit("").alias("kept"), F.lit(0).alias("at"))
    folded = F.aggregate(spans, zero, lambda acc, s: F.struct(
        F.concat(acc["kept"], piece(acc["at"], s["first"])).alias("kept"), s["stop"].alias("at")))
    whole = F.concat(folded["kept"], piece(folded["at"], F.octet_length(text)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
