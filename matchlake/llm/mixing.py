"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a share of a word budget, by weight, up to ``repeats`` times its own size; what is above
goes to the others by weight. A source takes whole copies of itself as long as they fit, then a subset of its
documents for the rest: documents are counted by exact size, every size class gives the same fraction, the
words still open are filled from the largest size down, and the last of them by a bounded knapsack over the
documents left of each size. Which documents of a size class are taken follows a seeded hash.

Edge cases: null text has size 0, takes nothing and is kept out of the mix; a null source is a source of its
own, ordered last; a source without words has target 0; repeated rows are rows of their own, ties of the seeded
order are broken by doc_id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096


def targets(sizes: DataFrame, weights: Sequence[int], share: float, repeats: int) -> DataFrame:
    """source, source_size, target: one row per source.

    Weights follow the code point order of the sources. The level up to which capped sources fill is found in
    one pass over the sources in the order in which they reach their cap.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    cap = (F.lit(float(repeats)) * F.col("source_size")).alias("cap")
    rows = per_source.select("source", "source_size", weight.alias("weight"), cap)
    everything = Window.partitionBy(F.lit(0))
    by_level = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*", F.least(share * F.sum("source_size").over(everything), F.sum("cap").over(everything)).alias("budget"),
        F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)).alias("full"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))).alias("open"))
    level = (F.col("budget") - F.col("full")) / F.col("open")
    # the first source, in this order, that the level does not fill sets the level of all behind it
    rows = rows.withColumn("reached", F.row_number().over(by_level)).withColumn("own", level)
    first = F.min(F.when(F.col("own") * F.col("weight") < F.col("cap"), F.struct("reached", "own"))).over(everything)
    return rows.withColumn("level", first["own"]).select(
        "source", "source_size", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), "cap").alias("target"))


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, exact: int = 1 << 16) -> np.ndarray:
    """How many documents of each size sum to the budget, or as close to it as the last step allows.

    ``exact`` is the number of words up to which the knapsack is solved exactly.
    """
    total = int((sizes * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = np.array([int(c) * budget // total for c in counts], dtype=np.int64)
    open_ = budget - int((sizes * taken).sum())
    order = np.argsort(-sizes, kind="stable")
    for i in order:
        if open_ <= exact:
            break
        more = min(int(counts[i] - taken[i]), max(0, open_ - exact // 2) // int(sizes[i]))
        taken[i] += more
        open_ -= more * int(sizes[i])
    # reachable sums as the bits of one number, a step per size and power of two of its documents
    reach, steps = 1, []
    top = 2 * open_
    full = (1 << (top + 1)) - 1
    for i in order[::-1]:
        left, power = int(counts[i] - taken[i]), 1
        while left > 0 and int(sizes[i]) <= top and not reach >> open_ & 1:
            n = min(power, left)
            steps.append((i, n, reach))
            reach |= reach << n * int(sizes[i]) & full
            left, power = left - n, power * 2
    below = (reach & (1 << (open_ + 1)) - 1).bit_length() - 1
    above = reach >> open_ + 1
    # lowest sum above the budget, if it is nearer
    over = open_ + (above & -above).bit_length() if above else below
    goal = over if above and over - open_ < open_ - below else below
    for i, n, before in reversed(steps):
        if not before >> goal & 1:
            taken[i] += n
            goal -= n * int(sizes[i])
    return taken


def _plan(batch: pa.Table) -> pa.Table:
    """Documents to take of each size class of one source, from (size, n, target, source_size)."""
    size = batch.column("size").to_numpy()
    size_of_source = int(batch.column("source_size")[0].as_py())
    goal = int(batch.column("target")[0].as_py() + 0.5)
    copies = goal // size_of_source if size_of_source else 0
    picked = fit(size, batch.column("n").to_numpy(), goal - copies * size_of_source)
    rest = batch.select(["source", "size", "source_size", "target"])
    return rest.append_column("copies", pa.array(np.full(len(size), copies))).append_column("picked", pa.array(picked))


KEYS = ("doc_id", "place")


def _same(left: DataFrame, right: DataFrame, *names: str, how: str = "inner") -> DataFrame:
    """Join on columns of the same name, null being equal to null; the columns of the left stay."""
    renamed = right.withColumnsRenamed({n: f"right#{n}" for n in names})
    on = reduce(Column.__and__, [left[n].eqNullSafe(renamed[f"right#{n}"]) for n in names])
    return left.join(renamed, on, how).drop(*[f"right#{n}" for n in names])


def sized(documents: DataFrame) -> DataFrame:
    """The documents with their size and their place among the rows of the same doc_id, which tells them apart."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    same_id = Window.partitionBy("doc_id").orderBy("source", "mix#size", "mix#text")
    rows = documents.withColumn("mix#size", size).withColumn("mix#text", F.xxhash64("text"))
    return rows.withColumn("mix#place", F.row_number().over(same_id))


def mix(documents: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, repeats: int = 2,
        seed: int = 17) -> DataFrame:
    """doc_id, place, size, source_size, target, taken, copies: one row per row of (doc_id, source, text).

    ``place`` numbers the rows of one doc_id.
    """
    text = documents.select("doc_id", "source", "text")
    rows = stored(sized(text).select("doc_id", "source", F.col("`mix#size`").alias("size"), F.col("`mix#place`").alias("place")), "sizes")
    goals = targets(rows, weights, share, repeats)
    # a class has one row per size and source, however many documents it has
    classes = rows.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    classes = _same(classes, goals, "source")
    plan = stored(classes.groupBy("source").applyInArrow(
        _plan, "source string, size long, source_size long, target double, copies long, picked long"), "plan")
    # seeded order within a class, cut into buckets so that no class has to be sorted as a whole
    order = F.xxhash64(F.lit(seed), "doc_id")
    seeded = rows.filter("size > 0").withColumn("order", order).withColumn("bucket", F.pmod("order", F.lit(BUCKETS)))
    part = seeded.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    part = _same(part, plan.drop("source_size", "target"), "source", "size")
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.col("picked") - F.coalesce(F.sum("n").over(before), F.lit(0))
    part = stored(part.select("source", "size", "bucket", "copies", "n",
                              F.greatest(F.lit(0), F.least("n", quota)).alias("quota")), "quota")
    joined = _same(seeded, part, "source", "size", "bucket")
    whole = joined.filter("quota = 0 or quota = n").select(*KEYS, F.expr("copies + if(quota = n, 1, 0)").alias("copies"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("order", *KEYS))
    split = joined.filter("quota > 0 and quota < n").withColumn("rank", rank).select(
        *KEYS, F.expr("copies + if(rank <= quota, 1, 0)").alias("copies"))
    copies = whole.unionAll(split)
    out = _same(rows, copies, *KEYS, how="left").withColumn("copies", F.coalesce("copies", F.lit(0)))
    return _same(out, goals, "source").select(
        *KEYS, "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def repeat(documents: DataFrame, **options) -> DataFrame:
    """The documents as often as the mix takes them, in their own columns."""
    taken = mix(documents, **options).filter("copies > 0").select(
        F.col("doc_id").alias("mix#id"), F.col("place").alias("mix#at"), F.col("copies").alias("mix#copies"))
    rows = sized(documents)
    joined = rows.join(taken, F.col("doc_id").eqNullSafe(F.col("`mix#id`")) & (F.col("`mix#place`") == F.col("`mix#at`")))
    once = joined.withColumn("mix#copy", F.explode(F.sequence(F.lit(1), F.col("`mix#copies`").cast("int"))))
    return once.select(*[F.col(f"`{c}`") for c in documents.columns])
