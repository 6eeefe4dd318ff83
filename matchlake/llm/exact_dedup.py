"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

Misra-Gries (``freqItems``) names every digest that may hold more than ``support`` of the rows, at most
``1 / support`` of them. Those are counted exactly; the ones that really are that frequent are broadcast
and their rows are settled where they are, without a shuffle. All other digests go through an ordinary
shuffle: their rows are combined by digest in the tasks, and the digests that occur again are joined to the rows, which are
the side of the join that adaptive execution can split. Texts are equal if their SHA-256 is.

Edge cases: null text counts as empty and is returned with the digest of the empty text; of rows with the
same text and the same doc_id exactly one is kept; a null doc_id is smaller than any other; an empty table
gives an empty result; other columns are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, text_sha256 and a row number that is written down once, so that ties have one winner."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", F.sha2(text, 256).alias("text_sha256"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


def exact_groups(documents: DataFrame, support: float = 0.001) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of (doc_id, text)."""
    rows = digests(documents)
    best = F.max(F.struct("doc_id", "row"))
    # at most 1 / support candidates
    found = rows.freqItems(["text_sha256"], support).select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    counted = rows.join(F.broadcast(found), "text_sha256").groupBy("text_sha256").agg(
        best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    heavy = stored(counted.filter(F.col("group_size") > support * rows.count()), "heavy")
    settled = rows.join(F.broadcast(heavy), "text_sha256")
    light = rows.join(F.broadcast(heavy), "text_sha256", "left_anti")
    again = light.groupBy("text_sha256").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    rest = light.join(again, "text_sha256", "left").select(
        "text_sha256", "doc_id", "row", F.coalesce("best", F.struct("doc_id", "row")).alias("best"), F.coalesce("group_size", F.lit(1)).alias("group_size"))
    return settled.select(*rest.columns).unionAll(rest).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256")
