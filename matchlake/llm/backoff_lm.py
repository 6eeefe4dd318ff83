"""Scoring with an n-gram model held as a weighted backoff automaton.

States are contexts of up to ``order - 1`` words. An arc of a state carries the log-probability of a next
word; a word without an arc follows the failure arc to the next shorter context and pays its backoff weight.
The last state, the empty context, knows every word of the training texts. An arc leads to the longest suffix of
its n-gram that is a state.

The automaton grows with the corpus: every n-gram that occurs at least ``LEAST`` times is an arc, at every size. Counts are
exact. States and arcs are one table for each length of n-gram, dealt by range of the hash; no task and no broadcast holds a whole one.

Texts are encoded once, into chunks of about ``CHUNK`` tokens: the sorted hashes of the chunk's words, and for each token its place
among them. A chunk asks for the arcs it may pass, each once, and in order of length: an n-gram only if its prefix and its suffix
were found, as every prefix and suffix of an arc is an arc. With these arcs each text is read from left to right with its state. Long
texts are cut into lanes of ``LANE`` tokens, which are stepped side by side; a lane starts ``order - 1`` tokens early, after which its
state is that of the whole text. Hashes have 64 bits; log-probabilities travel as 32-bit floats and are added up in 64 bits.

``ngram_share`` prunes n-grams below that share of the training tokens; it is 0 (no pruning) unless given.

Smoothing: a discount ``DISCOUNT`` is taken from each count of an arc; what an unpruned state has left goes to
shorter contexts. The empty context gives (c + 0.5) / (N + 0.5 (V + 1)), where V counts distinct tokens and one more
share stands for all unseen ones.

Edge cases: null and empty texts are the end token alone; without training rows N and V are 0 and every token has
probability 1 / 1; null doc_ids are training rows; repeated rows count and are scored each; texts of any length
are scored whole, a text longer than a chunk is a chunk; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .packed import END_OF_TEXT, SPACES, keys, mix, ranges, release, slices, words
from .scratch import removed, stored

DISCOUNT = 0.5
#: count from which an n-gram of two words or more is an arc
LEAST = 2
JOIN = keys(2, 0x33) | np.uint64(1)
#: n-grams that meet in one partition, tokens of a chunk, tokens of a lane
PER_PART, CHUNK, LANE = 2 << 20, 1 << 20, 256
#: shares of the chunks that ask and are read one after the other, so that only one share's requests and arcs are on disk
WAVES = 2
#: bits by which a request is longer than it takes to number all tokens: one in 2^12 is answered with an arc of another n-gram too
SPARE = 12
#: packed columns that go to the partition of their hashes; a chunk below 0 stands for the model
CELL = "part int, chunk long, size int, data binary"
#: columns of a cell: counted n-grams (hash, prefix, count), arcs (hash, count of a word, log-probability, backoff of its state), requests
COUNTED, ARCS, ASKED, VALUES = ["u8", "u8", "u4"], ["u8", "i8", "f4", "f4"], ["u8"], ["i8", "f4", "f4"]


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text closed by the end token, and the first token of each text."""
    hashes, first = words(texts, SPACES)
    n = len(first) - 1
    out = np.empty(len(hashes) + n, np.uint64)
    ends = first[1:] + np.arange(n)
    out[ends] = END_OF_TEXT
    inside = np.ones(len(out), dtype=bool)
    inside[ends] = False
    out[inside] = hashes
    return out, np.concatenate([[0], ends + 1])


def longer(prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Hash of the n-gram with this prefix and suffix, both one word shorter; order matters."""
    return mix(prefix * JOIN[0] + suffix * JOIN[1])


def find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted table, -1 where it is not in it."""
    if not len(table):
        return np.full(len(values), -1, np.int64)
    place = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[place] == values, place, -1)


def shorter_by_one(ids: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Suffix of n-grams from their hash and prefix: ``longer`` can be undone, as each of its steps can."""
    x = ids
    for shift, factor in ((31, 0x94D049BB133111EB), (27, 0xBF58476D1CE4E5B9), (30, None)):
        x = x ^ (x >> np.uint64(shift)) ^ (x >> np.uint64(2 * shift))
        if factor is not None:
            x = x * np.uint64(pow(factor, -1, 1 << 64))
    return (x - prefix * JOIN[0]) * np.uint64(pow(int(JOIN[1]), -1, 1 << 64))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def squeezed(columns: list[np.ndarray]) -> bytes:
    """Columns compressed, of numbers but floats the first bytes of all values first; of the first column, which ascends, the differences."""
    columns = [np.diff(columns[0], prepend=columns[0].dtype.type(0)), *columns[1:]]
    raw = b"".join((c if c.dtype.kind == "f" else np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)
    return pa.compress(raw, codec="zstd", asbytes=True)


def opened(data: bytes, sizes: list[int], types: list[str]) -> list[np.ndarray]:
    """Columns of those sizes and types, as ``squeezed`` packed them."""
    dtypes = [np.dtype(t) for t in types]
    total = sum(n * t.itemsize for n, t in zip(sizes, dtypes, strict=True))
    raw, out, at = pa.decompress(data, decompressed_size=total, codec="zstd", asbytes=True), [], 0
    for n, t in zip(sizes, dtypes, strict=True):
        if t.kind == "f":
            out.append(np.frombuffer(raw, t, n, at))
        else:
            given = np.frombuffer(raw, np.uint8, n * t.itemsize, at).reshape(t.itemsize, n)
            out.append(np.ascontiguousarray(given.T).view(t).reshape(n))
        at += n * t.itemsize
    out[0] = np.cumsum(out[0], dtype=out[0].dtype)
    return out


def cells(chunk: int, columns: list[np.ndarray], parts: int, cut: int = 0) -> pa.RecordBatch:
    """Columns in ascending order of the first one, a hash (without its last ``cut`` bits), cut where its part changes."""
    part = ((((columns[0] << np.uint64(cut)) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int32)
    heads = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(heads[1:], len(part))
    data = [squeezed([c[a:b] for c in columns]) for a, b in zip(heads, ends, strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(part[heads]), pa.array(np.full(len(heads), chunk, np.int64)), pa.array((ends - heads).astype(np.int32)),
         pa.array(data, pa.binary())], ["part", "chunk", "size", "data"])


@contextmanager
def freed(spark: SparkSession):
    """Shuffle files are removed as soon as the table they fed is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def parts_for(spark: SparkSession, total: int, order: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-total * (order - 1) // PER_PART))


@dataclass
class Chunk:
    """Texts as numbers: the words in ascending order, each token's place among them, the first token of each text."""

    words: np.ndarray
    places: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(data: bytes, distinct: int, size: int, rows: int) -> Chunk:
        found, places, lengths = opened(data, [distinct, size, rows], ["u8", "u4", "u4"])
        return Chunk(found, places, np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]))

    @property
    def tokens(self) -> np.ndarray:
        return self.words[self.places]

    def ngrams(self, length: int, tables: list[Arcs] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hash and prefix of every occurrence of an n-gram of that length whose prefix and suffix are among the arcs, if given."""
        ids = self.tokens
        if length == 1:
            return ids, np.zeros(len(ids), np.uint64)
        place = np.arange(len(ids)) - np.repeat(self.first[:-1], np.diff(self.first))
        known = np.ones(len(ids), dtype=bool) if tables is None else (find(tables[0].ids, self.words) >= 0)[self.places]
        for n in range(2, length + 1):
            at = np.flatnonzero(known[1:] & known[:-1] & (place[1:] >= n - 1)) + 1
            prefix = ids[at - 1]
            gram = longer(prefix, ids[at])
            if n == length:
                return gram, prefix
            ids = np.zeros(len(place), np.uint64)
            ids[at] = gram
            known = np.zeros(len(place), dtype=bool)
            known[at] = True if tables is None else find(tables[n - 1].ids, gram) >= 0
        raise AssertionError


@dataclass
class Arcs:
    """Arcs of one length in ascending order of their hash."""

    ids: np.ndarray
    n: np.ndarray
    logp: np.ndarray
    backoff: np.ndarray

    @staticmethod
    def of(given: list[list[np.ndarray]]) -> Arcs:
        columns = [np.concatenate(c) for c in zip(*given, strict=True)] if given else [np.empty(0, t) for t in ARCS]
        at = np.argsort(columns[0])
        return Arcs(*(c[at] if len(c) else c for c in columns))


def encode(documents: DataFrame, per_chunk: int = CHUNK, batch_bytes: int = 8 << 20) -> DataFrame:
    """chunk, training, doc_ids, number of distinct words (n_words) and of tokens (size), packed data, from (doc_id, text, training).

    Written once and read by all later steps. Texts for training and others are in different chunks; without the column none is for training.
    """
    kind = dict(documents.dtypes)["doc_id"]
    if "training" not in documents.columns:
        documents = documents.withColumn("training", F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        waiting, size = ([], []), [0, 0]

        def full(training: int):
            nonlocal chunk
            given = waiting[training]
            ids = pa.concat_arrays([w[0] for w in given])
            found, places = np.unique(np.concatenate([w[1] for w in given]), return_inverse=True)
            lengths = np.concatenate([w[2] for w in given]).astype(np.uint32)
            given.clear()
            chunk, size[training] = chunk + 1, 0
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([bool(training)]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.array([len(found)], pa.int32()), pa.array([len(places)], pa.int32()),
                 pa.array([squeezed([found, places.astype(np.uint32), lengths])], pa.binary())],
                ["chunk", "training", "doc_ids", "n_words", "size", "data"])

        def filled(part: pa.RecordBatch, training: int):
            found, first = tokens(part.column("text"))
            # a slice of short texts is cut where it fills the chunk
            row = 0
            while row < part.num_rows:
                stop = int(np.searchsorted(first, first[row] + per_chunk - size[training], side="right")) - 1
                stop = max(stop, row if waiting[training] else row + 1)
                if stop > row:
                    waiting[training].append((part.column("doc_id").slice(row, stop - row), found[first[row]:first[stop]], np.diff(first[row:stop + 1])))
                    size[training] += int(first[stop] - first[row])
                if stop < part.num_rows or size[training] >= per_chunk:
                    yield full(training)
                row = stop

        for batch in batches:
            learned = batch.column("training").to_numpy(zero_copy_only=False).astype(bool)
            for training in (0, 1):
                for part in slices(batch.filter(pa.array(learned == bool(training))), "text", batch_bytes):
                    yield from filled(part, training)
        for training in (0, 1):
            if waiting[training]:
                yield full(training)
        release()

    return stored(documents.select("doc_id", "text", F.coalesce("training", F.lit(False)).alias("training")).mapInArrow(
        run, f"chunk long, training boolean, doc_ids array<{kind}>, n_words int, size int, data binary"), "chunks")


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, Chunk]]:
    names = ("chunk", "data", "n_words", "size", "rows")
    for chunk, *rest in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
        yield chunk, Chunk.of(*rest)


def _texts(chunks: DataFrame) -> DataFrame:
    return chunks.select("chunk", "data", "n_words", "size", F.size("doc_ids").alias("rows"))


def word_counts(chunks: DataFrame) -> DataFrame:
    """id (token hash), n: exact counts of all tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, chunk in _chunks(batch):
                n = np.bincount(chunk.places, minlength=len(chunk.words))
                yield pa.RecordBatch.from_arrays([pa.array(signed(chunk.words)), pa.array(n)], ["id", "n"])
        release()

    return _texts(chunks).mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def ngram_counts(chunks: DataFrame, length: int, least: int, parts: int) -> DataFrame:
    """id, prefix, suffix (hashes), n of all n-grams of one length: exact counts from ``least`` on."""
    def tally(ids: np.ndarray, prefix: np.ndarray, n: np.ndarray | None):
        at = np.argsort(ids)
        ids = ids[at]
        heads = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        count = np.diff(np.append(heads, len(ids))) if n is None else np.add.reduceat(n[at].astype(np.int64), heads)
        return ids[heads], prefix[at[heads]], count

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, chunk in _chunks(batch):
                ids, prefix = chunk.ngrams(length)
                if len(ids):
                    ids, prefix, count = tally(ids, prefix, None)
                    yield cells(number, [ids, prefix, count.astype(np.uint32)], parts)
        release()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [opened(data, [size] * 3, COUNTED) for batch in batches
                 for size, data in zip(batch.column("size").to_pylist(), batch.column("data").to_pylist(), strict=True)]
        if given:
            ids, prefix, count = tally(*(np.concatenate(c) for c in zip(*given, strict=True)))
            given.clear()
            kept = np.flatnonzero(count >= least)
            ids, prefix = ids[kept], prefix[kept]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(signed(c)) for c in (ids, prefix, shorter_by_one(ids, prefix))), pa.array(count[kept])],
                ["id", "prefix", "suffix", "n"])
        release()

    return _texts(chunks).mapInArrow(pack, CELL).repartitionById(parts, F.col("part")).mapInArrow(
        merge, "id long, prefix long, suffix long, n long")


@dataclass
class Model:
    """Sizes, and for each length of n-gram its arcs, with the state they lead on to: id, n, logp, backoff."""

    order: int
    total: int
    distinct: int
    parts: int
    tables: list[DataFrame]

    @property
    def mass(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    @property
    def unseen(self) -> float:
        return float(np.log10(0.5 / self.mass))


def train(training: DataFrame, order: int = 3, ngram_share: float = 0.0, per_chunk: int = CHUNK, batch_bytes: int = 8 << 20) -> Model:
    """The automaton, from rows of (text)."""
    chunks = encode(training.select(F.lit(None).cast("int").alias("doc_id"), "text"), per_chunk, batch_bytes)
    model = learn(chunks, order, ngram_share)
    removed(chunks)
    return model


def learn(chunks: DataFrame, order: int = 3, ngram_share: float = 0.0) -> Model:
    """The automaton, from encoded texts."""
    spark = chunks.sparkSession
    with freed(spark):
        counts = stored(word_counts(chunks), "words")
        total, distinct = (int(x) for x in counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first())
        model = Model(order, total, distinct, parts_for(spark, total, order), [])
        least = max(LEAST, int(np.ceil(ngram_share * total)))
        # n-grams one word shorter: count and probability
        shorter = counts.select("id", "n", ((F.col("n") + 0.5) / model.mass).alias("p"))
        for length in range(2, order + 1):
            grams = stored(ngram_counts(chunks, length, least, model.parts), "ngrams")
            # the suffix of an arc is an arc: it is at least as frequent
            arcs = stored(grams.join(shorter.select(F.col("id").alias("suffix"), F.col("p").alias("lower")), "suffix").drop("suffix"), "arcs")
            removed(grams)
            states = arcs.groupBy("prefix").agg(F.sum(F.col("n") - DISCOUNT).alias("kept"), F.sum("lower").alias("below")).join(
                shorter.select(F.col("id").alias("prefix"), F.col("n").alias("of")), "prefix")
            left = lambda x: F.greatest(1 - x, F.lit(1e-12))
            states = stored(states.select("prefix", "of", F.log10(left(F.col("kept") / F.col("of")) / left(F.col("below"))).alias("backoff")), "states")
            own = states.select(F.col("prefix").alias("id"), F.col("backoff").cast("float"))
            model.tables.append(stored(_arcs(shorter.join(own, "id", "left"), length - 1), "model"))
            removed(counts if length == 2 else shorter)
            shorter = stored(arcs.join(states, "prefix").select("id", "n", ((F.col("n") - DISCOUNT) / F.col("of")).alias("p")), "arcs")
            removed(arcs)
            removed(states)
        model.tables.append(_arcs(shorter.withColumn("backoff", F.lit(None).cast("float")), order))
    return model


def _arcs(ngrams: DataFrame, length: int) -> DataFrame:
    """id, n (of words only, whose probability follows from it), logp, backoff; n-grams that are no states have no backoff to pay."""
    zero = F.lit(0.0).cast("float")
    n, logp = (F.col("n"), zero) if length == 1 else (F.lit(0).cast("long"), F.log10("p").cast("float"))
    return ngrams.select("id", n.alias("n"), logp.alias("logp"), F.coalesce("backoff", zero).alias("backoff"))


ROWS = "chunk long, length int, size int, data binary, more binary"


def _meet(asked: DataFrame, table: DataFrame, length: int, parts: int, cut: int) -> DataFrame:
    """chunk, length, size, hashes (data) and values (more): arcs whose hash begins as one that the chunk asks for."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def full():
            arcs = Arcs.of(waiting)
            waiting.clear()
            return cells(-1, [arcs.ids, arcs.n, arcs.logp, arcs.backoff], parts)

        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("id", "n", "logp", "backoff")]
            waiting.append([columns[0].view(np.uint64), *columns[1:]])
            size += len(columns[0])
            if size >= CHUNK:
                yield full()
                size = 0
        if size:
            yield full()
        release()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the arcs come first, requests stream past them
        given, arcs, begins = [], None, None
        for batch in batches:
            out = []
            for chunk, size, data in zip(*(batch.column(c).to_pylist() for c in ("chunk", "size", "data")), strict=True):
                if chunk < 0:
                    given.append(opened(data, [size] * 4, ARCS))
                    continue
                if arcs is None:
                    arcs = Arcs.of(given)
                    given.clear()
                    begins = arcs.ids >> np.uint64(cut)
                wanted = opened(data, [size], ASKED)[0]
                low = np.searchsorted(begins, wanted)
                # mostly one arc or none begins so; whoever asked tells them apart by the whole hash
                same = begins[np.minimum(low, len(begins) - 1)] == wanted if len(begins) else np.zeros(len(wanted), dtype=bool)
                low, wanted = low[same], wanted[same]
                place = ranges(low, np.searchsorted(begins, wanted, side="right") - low)
                if len(place):
                    out.append((chunk, length, len(place), squeezed([arcs.ids[place]]), squeezed([c[place] for c in (arcs.n, arcs.logp, arcs.backoff)])))
            if out:
                types = pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 ["chunk", "length", "size", "data", "more"])
        release()

    return stored(table.mapInArrow(pack, CELL).unionAll(asked).repartitionById(parts, F.col("part")).sortWithinPartitions("chunk").mapInArrow(
        meet, ROWS), "found")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Chunk, pa.Array | None, list[list]]]:
    """Each chunk with its doc_ids and, for each length, the columns found for it (hashes alone if there are no values); texts come before arcs."""
    now = None
    for batch in batches:
        names = batch.schema.names
        columns = [batch.column(c).to_pylist() for c in ("chunk", "length", "size", "data", "n_words", "rows")]
        values = batch.column("more").to_pylist() if "more" in names else [None] * batch.num_rows
        for i, (chunk, length, size, data, n_words, rows, more) in enumerate(zip(*columns, values, strict=True)):
            if length == 0:
                if now:
                    yield now
                ids = batch.column("doc_ids")[i].values if "doc_ids" in names else None
                now = chunk, Chunk.of(data, n_words, size, rows), ids, []
            else:
                found = now[3]
                while len(found) < length:
                    found.append([])
                of_hash = opened(more, [size] * 3, VALUES) if more is not None else [np.empty(0, t) for t in VALUES]
                found[length - 1].append([*opened(data, [size], ASKED), *of_hash])
    if now:
        yield now


def _tables(found: list[list], lengths: int) -> list[Arcs]:
    return [Arcs.of(found[n] if n < len(found) else []) for n in range(lengths)]


def score(documents: DataFrame, model: Model, per_chunk: int = CHUNK, batch_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every row of (doc_id, text)."""
    chunks = encode(documents, per_chunk, batch_bytes)
    scores = read_through(chunks, model)
    removed(chunks)
    return scores


def read_through(chunks: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every encoded text."""
    spark = chunks.sparkSession
    parts, order, mass, unseen = model.parts, model.order, model.mass, model.unseen
    cut = max(0, 64 - max(32, model.total.bit_length() + SPARE))
    kind = dict(chunks.dtypes)["doc_ids"][len("array<"):-1]

    def request(length: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for number, chunk, _, found in _together(batches):
                ids = chunk.words if length == 1 else chunk.ngrams(length, _tables(found, length - 1))[0]
                if len(ids):
                    yield cells(number, [np.unique(ids >> np.uint64(cut))], parts, cut)
            release()
        return run

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk, ids, found in _together(batches):
            tables = _tables(found, order)
            place = find(tables[0].ids, chunk.words)
            known = place >= 0
            of_word = np.full(len(known), unseen)
            of_word[known] = np.log10((tables[0].n[place[known]] + 0.5) / mass)
            owner = np.repeat(np.arange(len(ids)), np.diff(chunk.first))
            total = lambda values: np.bincount(owner, values[chunk.places], len(ids))  # noqa: E731,B023
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(chunk.first)), pa.array(np.rint(total(known)).astype(np.int64)), pa.array(total(of_word)),
                 pa.array(traverse(chunk, tables, of_word))], ["doc_id", "n_tokens", "n_known", "base_score", "score"])
        release()

    def gathered(found: list[DataFrame], texts: DataFrame) -> DataFrame:
        for f in found:
            texts = texts.unionByName(f, allowMissingColumns=True)
        return texts.repartition(parts, "chunk").sortWithinPartitions("chunk", "length") if found else texts

    scores = []
    with freed(spark):
        for wave in range(WAVES):
            own = chunks.filter(F.pmod("chunk", F.lit(WAVES)) == wave).withColumn("length", F.lit(0)).withColumn("rows", F.size("doc_ids"))
            found = []
            for length in range(1, order + 1):
                asked = gathered([f.drop("more") for f in found], own.drop("doc_ids", "training")).mapInArrow(request(length), CELL)
                found.append(_meet(asked, model.tables[length - 1], length, parts, cut))
            scores.append(stored(gathered(found, own).mapInArrow(
                walk, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double"), "scores"))
            for f in found:
                removed(f)
    out = scores[0]
    for s in scores[1:]:
        out = out.unionAll(s)
    return out


def traverse(chunk: Chunk, tables: list[Arcs], of_word: np.ndarray) -> np.ndarray:
    """Log10 probability of each text: all lanes step from state to state, a token at a time.

    A lane stands in the state of its longest known context (``depth`` words); ``context[k]`` is its last k + 1 words, the
    state that the failure arcs lead to. ``of_word`` is what the last state, the empty context, gives each word of the chunk.
    """
    order, first = len(tables), chunk.first
    lanes = -(-np.diff(first) // LANE)
    owner = np.repeat(np.arange(len(lanes)), lanes)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    begin = first[owner] + number * LANE
    start = np.maximum(begin - (order - 1), first[owner])
    length = np.minimum(begin + LANE, first[owner + 1]) - start
    at = np.argsort(-length, kind="stable")
    owner, begin, start, length = owner[at], begin[at], start[at], length[at]

    word = find(tables[0].ids, chunk.words)
    of_state = np.where(word >= 0, tables[0].backoff[word], 0.0) if len(tables[0].ids) else np.zeros(len(word))
    context = [np.zeros(len(owner), np.uint64) for _ in range(order - 1)]
    depth, total = np.zeros(len(owner), np.int64), np.zeros(len(owner))
    # place of the state among those of its depth where the arc that led there told it, and the last token
    number, last = np.full(len(owner), -1), np.zeros(len(owner), np.int64)
    for step in range(int(length.max(initial=0))):
        n_on = int(np.searchsorted(-length, -step))  # lanes that go on: the longest come first
        token = chunk.places[start[:n_on] + step]
        grams = [chunk.words[token]]
        for c in context:
            grams.append(longer(c[:n_on], grams[-1]))
        paid, reached = np.zeros(n_on), np.zeros(n_on, np.int64)
        waiting, stand, led = np.arange(n_on), depth[:n_on].copy(), np.full(n_on, -1)
        for state in range(order - 1, 0, -1):  # from states of so many words along an arc, or along the failure arc
            here = waiting[stand[waiting] == state]
            if not len(here):
                continue
            place = find(tables[state].ids, grams[state][here])
            passed = place >= 0
            paid[here[passed]] += tables[state].logp[place[passed]]
            reached[here[passed]] = state + 1
            failed = here[~passed]
            if state == 1:
                paid[failed] += of_state[last[failed]]
            else:
                own = np.where(depth[failed] == state, number[failed], -1)
                lost = own < 0
                own[lost] = find(tables[state - 1].ids, context[state - 1][failed[lost]])
                paid[failed] += tables[state - 1].backoff[own]
            led[here[passed]] = place[passed] if state < order - 1 else -1
            stand[failed] = state - 1
            stand[here[passed]] = -1
            waiting = waiting[stand[waiting] >= 0]
        paid[waiting] += of_word[token[waiting]]
        reached[waiting] = word[token[waiting]] >= 0
        counted = start[:n_on] + step >= begin[:n_on]
        total[:n_on] += np.where(counted, paid, 0)
        depth[:n_on], number[:n_on], last[:n_on] = np.minimum(reached, order - 1), led, token
        for c, gram in zip(context, grams, strict=False):
            c[:n_on] = gram
    return np.bincount(owner, total, len(lanes))
