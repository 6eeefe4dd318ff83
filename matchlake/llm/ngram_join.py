"""Exact Jaccard self-join of the word n-gram sets of documents, by set relations.

1.  Equal sets are one node, named by a number of its own: neither repeated nor missing doc_ids can confuse two sets.
    Of the texts of a node one is moved, found again by its doc_id and hash.
2.  A set is indexed under its prefix, the elements of which two linked sets share at least one. Elements are ordered
    by how many sets may hold them, rarest first, so that passages shared by many documents come last.
    The order rests on a table of ``SKETCH`` counters; any order gives the same links.
3.  The sets of an index list whose sizes may link hang under the smallest of them (their hub), so any two sets that
    share a list meet in the group of one hub. Members whose parity sketch rules out all others of the group go; the sets of the
    rest go to one task for each group. A group beyond ``block`` elements is cut into blocks that meet in pairs.
4.  In a task, index lists are kept in blocks of equal set size and equal position; one bound per block skips
    all of its sets at once. A set's overlaps with all others are derived from those of a highly similar set that
    was answered before: only the lists of the elements in which the two differ are read. Sets that are already connected
    are not compared again, as that cannot change the classes.

Elements are 64-bit hashes of n-grams and sets are told apart by 128 bits: links are exact up to collisions of these.

Edge cases: null text, and text without words, has an empty set and is linked with nothing; fewer than ``words`` words are one
n-gram; a null doc_id has no class of its own (component_id is the smallest id linked to its text, null if there is none), but its text
links others like any; rows with the same doc_id have the links of all their texts; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .counters import summed
from .packed import SPACES, keys, mix, release, slices, words
from .scratch import removed, stored

SKETCH = 1 << 22
SKETCH_SHIFT = np.uint64(64 - 22)
#: bits of the parity sketch of a set: those of two sets differ in no more bits than the sets in elements
PARITY_BITS = 2048


def ngram_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    hashes, first = words(texts, SPACES)
    factor = keys(n, 0x22) | np.uint64(1)
    grams = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        grams += hashes[k:k + len(grams)] * factor[k]
    grams = mix(grams + np.uint64(n))
    for start, stop in zip(first[:-1].tolist(), first[1:].tolist()):
        if stop - start >= n:
            yield np.unique(grams[start:stop - n + 1])
        elif stop > start:
            few = (hashes[start:stop] * factor[:stop - start]).sum(dtype=np.uint64) + np.uint64(stop - start)
            yield mix(np.array([few], np.uint64))
        else:
            yield np.empty(0, np.uint64)


def prefix_length(size: int, percent: int) -> int:
    """Elements of which a set of this size shares at least one with every linked set."""
    return size - -(-percent * size // 100) + 1


def parity_sketch(s: np.ndarray) -> bytes:
    """Each element turns one bit."""
    place = (s & np.uint64(PARITY_BITS - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=PARITY_BITS) & 1).astype(np.uint8)).tobytes()


def element_counts(documents: DataFrame, n: int, batch_bytes: int) -> np.ndarray:
    """How many texts hold the elements of each of ``SKETCH`` classes, as 16-bit logarithms; the table has a fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for part in slices(batch, "text", batch_bytes):
                sets = list(ngram_sets(part.column("text"), n))
                total += np.bincount((np.concatenate(sets) >> SKETCH_SHIFT).astype(np.int64), minlength=SKETCH)
        return total

    # only the order of the classes matters: fine steps of the logarithm keep it, in a quarter of the bytes
    return summed(documents.select("text"), count, SKETCH, lambda c: np.minimum(np.log2(c + 1.0) * 1024, 65_535).astype(np.uint16))


def set_table(documents: DataFrame, n: int, percent: int, batch_bytes: int) -> DataFrame:
    """doc_id, text_hash, size, d1 and d2 (a 128-bit digest of the set), parity, prefix: one row per row of (doc_id, text)."""
    counts = documents.sparkSession.sparkContext.broadcast(element_counts(documents, n, batch_bytes))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = counts.value
        for batch in batches:
            for part in slices(batch, "text", batch_bytes):
                sizes, first, second, parity, prefixes = [], [], [], [], []
                for s in ngram_sets(part.column("text"), n):
                    sizes.append(len(s))
                    first.append(int(mix(s + np.uint64(0x1F)).sum(dtype=np.uint64)))
                    second.append(int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)))
                    parity.append(parity_sketch(s))
                    p = prefix_length(len(s), percent) if len(s) else 0
                    ranked = np.lexsort((s, order[(s >> SKETCH_SHIFT).astype(np.int64)]))[:p]
                    prefixes.append(s[ranked].view(np.int64))
                stops = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
                flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
                digest = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(sizes, pa.int64()), digest(first), digest(second), pa.array(parity, pa.binary()),
                     pa.ListArray.from_arrays(stops, pa.array(flat))], ["doc_id", "text_hash", "size", "d1", "d2", "parity", "prefix"])
        release()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    shape = "doc_id long, text_hash long, size long, d1 long, d2 long, parity binary, prefix array<long>"
    built = stored(rows.mapInArrow(build, shape), "sets")
    counts.destroy()
    return built


def text_hash() -> Column:
    return F.xxhash64("text")


def node_table(sets: DataFrame) -> DataFrame:
    """d1, d2, node, size, parity, prefix, least_id and first of each distinct set: ``first`` says which text stands for it.

    Equal sets are combined on each task first. Numbers are unique and fixed, as the table is written once.
    """
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    distinct = sets.filter("size > 0").groupBy("d1", "d2").agg(
        F.min(place).alias("first"), F.min("doc_id").alias("least_id"), F.first("size").alias("size"),
        F.first("parity").alias("parity"), F.first("prefix").alias("prefix"))
    return stored(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")


def may_link(group: pa.Table, percent: int) -> np.ndarray:
    """Which sets of a block pair may be linked with another of it, by size and parity sketch."""
    size = group.column("size").to_numpy()
    bits = np.frombuffer(b"".join(group.column("parity").to_pylist()), np.uint64).reshape(len(size), -1)
    node = group.column("node").to_numpy()
    out = np.zeros(len(size), dtype=bool)
    for k in range(0, len(size), 32):
        differ = np.bitwise_count(bits[k:k + 32, None] ^ bits[None]).sum(axis=2, dtype=np.int64)
        both = size[k:k + 32, None] + size[None]
        # overlap o is at most (both - differ) / 2 and links when 100 o >= percent (both - o)
        good = (100 + percent) * (both - differ) >= 2 * percent * both
        good &= node[k:k + 32, None] != node[None]
        out[k:k + 32] = good.any(axis=1)
    return out


def in_blocks(members: DataFrame, weight, block: int) -> DataFrame:
    """members with side, left and right: groups beyond ``block`` are cut into blocks that meet in pairs (left, right)."""
    groups = members.groupBy("hub").agg(F.ceil(F.sum(weight) / F.lit(block)).cast("int").alias("blocks"))
    dealt = members.join(groups, "hub").withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return dealt.select(*members.columns, "side", other).select(
        *members.columns, "side", F.least("side", "other").alias("left"), F.greatest("side", "other").alias("right"))


def plausible_members(nodes: DataFrame, members: DataFrame, percent: int, block: int) -> DataFrame:
    """The members that may be linked within the group of their hub; only their sets are moved."""
    dealt = in_blocks(members, F.lit(1), block)

    def keep(group: pa.Table) -> pa.Table:
        return group.select(["hub", "node", "size"]).filter(pa.array(may_link(group, percent)))

    found = nodes.select("node", "size", "parity").join(dealt, "node").groupBy("hub", "left", "right").applyInArrow(keep, "hub long, node long, size long")
    return found.groupBy("hub", "node").agg(F.max("size").alias("size"))


def hub_members(nodes: DataFrame, percent: int) -> DataFrame:
    """hub, node: every two nodes that share an index list and may link by size have a hub in common. A stored table."""
    # size classes by the factor within which sets can link, a trifle wider against rounding
    level = F.floor(F.log("size") / (math.log(100 / percent) + 1e-9)).cast("int").alias("level")
    lists = nodes.select("node", level, F.explode("prefix").alias("element"))
    # a node holds an element once, so a count tells shared ones; most rows of this shuffle differ in the element alone
    shared = lists.groupBy("element").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("element")
    kept = stored(lists.join(shared, "element", "left_semi"), "lists")
    entries = kept.select("element", "node", F.explode(F.array("level", F.col("level") + 1)).alias("level"))
    hubs = entries.groupBy("element", "level").agg(F.min("node").alias("hub"), F.max("node").alias("top")).filter("hub < top")
    members = stored(entries.join(hubs.drop("top"), ["element", "level"]).select("hub", "node").distinct(), "members")
    removed(kept)
    return members


class IndexBlock:
    """Inverted lists over the sets of a block, in skip blocks of equal set size and position."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.elements, inverse, df = np.unique(flat, return_inverse=True, return_counts=True)
        # rarest first; unknown elements of a probe come before all
        self.rank = np.empty(len(df), np.int64)
        self.rank[np.lexsort((self.elements, df))] = np.arange(len(df))
        by_list = np.lexsort((self.sizes[owner], inverse))
        self.lists, self.list_at = owner[by_list], np.searchsorted(inverse[by_list], np.arange(len(df) + 1))
        # prefix entries: (element, size, position), one skip block for each
        ranks = self.rank[inverse]
        inside = np.lexsort((ranks, owner))
        position = np.arange(len(flat)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        short = np.array([prefix_length(int(s), percent) for s in self.sizes])
        kept = position < np.repeat(short, self.sizes)
        owner_p, element_p, position_p = owner[inside][kept], inverse[inside][kept], position[kept]
        at = np.lexsort((position_p, self.sizes[owner_p], element_p))
        self.entry, element_p, position_p = owner_p[at], element_p[at], position_p[at]
        size_p = self.sizes[self.entry]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (element_p[1:] != element_p[:-1]) | (size_p[1:] != size_p[:-1]) | (position_p[1:] != position_p[:-1])
        self.block_start = np.flatnonzero(new)
        self.block_stop = np.append(self.block_start[1:], len(at))
        self.block_size, self.block_position = size_p[self.block_start], position_p[self.block_start]
        self.block_at = np.searchsorted(element_p[self.block_start], np.arange(len(df) + 1))

    def numbers(self, s: np.ndarray) -> np.ndarray:
        """Element numbers of a probe set, -1 for those that no set of the block holds."""
        place = np.minimum(np.searchsorted(self.elements, s), len(self.elements) - 1)
        return np.where(self.elements[place] == s, place, -1)

    def candidates(self, numbers: np.ndarray) -> np.ndarray:
        """Sets that share a prefix element with a probe, in blocks that the bound does not rule out."""
        size = len(numbers)
        order = np.sort(np.where(numbers >= 0, self.rank[np.maximum(numbers, 0)] + 1, 0))
        ranked = self.by_rank()[np.maximum(order[:prefix_length(size, self.percent)] - 1, 0)]
        position = np.arange(len(ranked))
        known = order[:len(ranked)] > 0
        ranked, position = ranked[known], position[known]
        n = self.block_at[ranked + 1] - self.block_at[ranked]
        heads = np.cumsum(n) - n
        blocks = np.arange(int(n.sum())) + np.repeat(self.block_at[ranked] - heads, n)
        mine, other, at = np.repeat(position, n), self.block_size[blocks], self.block_position[blocks]
        most = np.minimum(mine, at) + np.minimum(size - mine, other - at)
        # overlap o links when 100 o >= percent (size + other - o)
        good = (100 + self.percent) * most >= self.percent * (size + other)
        good &= (100 * other >= self.percent * size) & (100 * size >= self.percent * other)
        blocks = blocks[good]
        n = self.block_stop[blocks] - self.block_start[blocks]
        heads = np.cumsum(n) - n
        return np.unique(self.entry[np.arange(int(n.sum())) + np.repeat(self.block_start[blocks] - heads, n)])

    def by_rank(self) -> np.ndarray:
        if not hasattr(self, "_by_rank"):
            self._by_rank = np.argsort(self.rank)
        return self._by_rank

    def overlaps(self, numbers: np.ndarray) -> np.ndarray:
        """Overlap with every set of the block, from the lists of these elements."""
        numbers = numbers[numbers >= 0]
        n = self.list_at[numbers + 1] - self.list_at[numbers]
        heads = np.cumsum(n) - n
        entries = np.arange(int(n.sum())) + np.repeat(self.list_at[numbers] - heads, n)
        return np.bincount(self.lists[entries], minlength=len(self.sets))


class Forest:
    """Union-find over the nodes of a task."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def link(nodes: list[int], sets: list[np.ndarray], probes: list[int], probe_sets: list[np.ndarray],
         percent: int, derive_from: int = 4) -> list[tuple[int, int]]:
    """Edges that connect what is linked between the indexed sets and the probes (the same lists for one block).

    Probes with at least ``derive_from`` open candidates are answered by overlap vectors, others by comparing.
    """
    index, forest, edges = IndexBlock(sets, percent), Forest(), []
    answered: list[tuple[np.ndarray, np.ndarray]] = []  # elements and overlap vector of the latest answered sets
    for k in sorted(range(len(probes)), key=lambda i: (len(probe_sets[i]), probes[i])):
        node, probe = probes[k], probe_sets[k]
        numbers = index.numbers(probe)
        open_ = [c for c in index.candidates(numbers).tolist() if nodes[c] != node and forest.root(nodes[c]) != forest.root(node)]
        if not open_:
            continue
        if len(open_) < derive_from:
            found = {c: len(np.intersect1d(probe, sets[c], assume_unique=True)) for c in open_}
        else:
            vector = _answer(index, numbers[numbers >= 0], answered)
            found = {c: int(vector[c]) for c in open_}
        for c, overlap in found.items():
            if 100 * overlap >= percent * (len(probe) + len(sets[c]) - overlap) and forest.join(nodes[c], node):
                edges.append((nodes[c], node))
    return edges


def _answer(index: IndexBlock, numbers: np.ndarray, answered: list) -> np.ndarray:
    """Overlap vector of a set: derived from the most similar answered set if that reads fewer lists."""
    best = None
    for elements, vector in answered:
        common = np.isin(numbers, elements, assume_unique=True)
        differ = int((~common).sum()) + len(elements) - int(common.sum())
        if differ < len(numbers) and (best is None or differ < best[0]):
            best = (differ, elements, vector, common)
    if best is None:
        vector = index.overlaps(numbers)
        answered.append((numbers, vector))
        del answered[:-6]
        return vector
    _, elements, vector, common = best
    gone = elements[~np.isin(elements, numbers, assume_unique=True)]
    return vector + index.overlaps(numbers[~common]) - index.overlaps(gone)


def _linker(percent: int):
    def run(group: pa.Table) -> pa.Table:
        rows: dict[int, dict[int, np.ndarray]] = {}
        for side, node, raw in zip(*(group.column(c).to_pylist() for c in ("side", "node", "elements"))):
            rows.setdefault(side, {})[node] = np.frombuffer(raw, np.uint64)
        pair = group.column("left")[0].as_py(), group.column("right")[0].as_py()
        left, right = rows.get(pair[0], {}), rows.get(pair[1], {})
        edges = link(list(left), list(left.values()), list(right), list(right.values()), percent) if left and right else []
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})

    return run


def link_edges(documents: DataFrame, nodes: DataFrame, members: DataFrame, n: int, percent: int, block: int, batch_bytes: int) -> DataFrame:
    """Edges (a, b) between nodes that connect all linked sets."""
    dealt = in_blocks(stored(members, "plausible"), F.col("size"), block).drop("size")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", batch_bytes):
                raw = pa.array([s.tobytes() for s in ngram_sets(part.column("text"), n)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("hub", "node", "side", "left", "right")), raw],
                    ["hub", "node", "side", "left", "right", "elements"])
        release()

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    # equal texts without an id are one before they are moved
    nameless = texts.filter("doc_id is null").groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"))
    of_node = dealt.join(nodes.select("node", "first"), "node").select(
        *dealt.columns, F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    with_text = texts.filter("doc_id is not null").unionAll(nameless).join(of_node, same).select("hub", "node", "side", "left", "right", "text")
    with_sets = with_text.mapInArrow(sets, "hub long, node long, side int, left int, right int, elements binary")
    return with_sets.groupBy("hub", "left", "right").applyInArrow(_linker(percent), "a long, b long")


def classed_rows(documents: DataFrame, n: int = 5, percent: int = 80, block: int = 1_000_000, batch_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, text_hash, size, component_id, keeper of each row of (doc_id, text).

    Rows without words have component_id doc_id and no keeper. ``keeper`` is the place (nameless, doc_id, text_hash) of the text that comes
    first in the class: of those with the smallest doc_id the one with the smallest hash.
    """
    whole = set_table(documents, n, percent, batch_bytes)
    nodes = node_table(whole)
    # sketches and prefixes are with the nodes now
    sets = stored(whole.select("doc_id", "text_hash", "size", "d1", "d2"), "set-rows")
    removed(whole)
    members = plausible_members(nodes, hub_members(nodes, percent), percent, max(2, block // 500))
    edges = link_edges(documents, nodes, members, n, percent, block, batch_bytes)
    rows = sets.join(nodes.select("d1", "d2", "node"), ["d1", "d2"], "left").drop("d1", "d2")
    # texts under one id belong together
    ids = rows.filter("doc_id is not null and node is not null").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z")
    several = rows.join(ids.select("doc_id", "a"), "doc_id").filter("node > a").select("a", F.col("node").alias("b"))
    labels = components(edges.unionAll(several))
    labelled = nodes.select("node", "least_id", "first").join(labels, "node", "left").withColumn("class", F.coalesce("component", "node"))
    named = labelled.groupBy("class").agg(F.min("least_id").alias("component_id"), F.min("first").alias("keeper"))
    per_node = labelled.select("node", "class").join(named, "class").drop("class")
    return rows.join(per_node, "node", "left").select(
        "doc_id", "text_hash", "size", F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "keeper")


def ngram_classes(documents: DataFrame, n: int = 5, percent: int = 80, block: int = 1_000_000,
                  batch_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of (doc_id, text).

    Two documents link when 100 * intersection >= percent * union of their sets of word n-grams.
    """
    return classed_rows(documents, n, percent, block, batch_bytes).select("doc_id", F.col("size").alias("n_shingles"), "component_id")


def without_near_copies(documents: DataFrame, n: int = 5, percent: int = 80, block: int = 1_000_000, batch_bytes: int = 4 << 20) -> DataFrame:
    """The rows of a table with doc_id and text, whatever its other columns, of which one stays in every class.

    It is the one whose text comes first (``classed_rows``). Rows without words stay, each of them. A row is dropped for its own text, never
    because its doc_id occurs again. Of rows with the same id and text the one with the smallest row hash stays.
    """
    classes = stored(classed_rows(documents, n, percent, block, batch_bytes), "classes")
    worded = classes.filter("keeper is not null").select("doc_id", "text_hash", F.col("keeper.doc_id").alias("kept_id"), F.col("keeper.text_hash").alias("kept_hash"))
    kept = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    place = [F.col("doc_id").alias("place#id"), F.col("text_hash").alias("place#hash")]
    gone = worded.filter(~kept).select(*place).distinct()
    again = worded.filter(kept).groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*place)
    here = F.col("doc_id").cast("long").eqNullSafe(F.col("place#id")) & (text_hash() == F.col("place#hash"))
    rest = documents.join(gone, here, "left_anti")
    names = [f"`{c}`" for c in documents.columns]
    # of repeated rows each task keeps one before they are dealt
    order = Window.partitionBy(F.col("doc_id"), text_hash()).orderBy(F.xxhash64(*[F.col(c) for c in names]))
    doubled = rest.join(again, here, "left_semi").withColumn("place#rank", F.row_number().over(order)).filter(F.col("`place#rank`") == 1).select(*names)
    return rest.join(again, here, "left_anti").unionAll(doubled)
