"""Token counts: texts are encoded in Arrow batches and only the lengths come back.

Edge cases: null and empty texts have 0 bytes and 0 tokens; a text longer than a batch is a
batch of its own and is cut at safe boundaries; repeated rows are counted each; an empty table
gives an empty result; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .encoders import token_lengths
from .packed import pack, slices


def count_tokens(documents: DataFrame, path: str, limit: int = 4096, batch_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row of (doc_id, text).

    ``path`` names the vocabulary file on the executors. Batches hold about ``batch_bytes`` of text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", batch_bytes):
                n = token_lengths(part.column("text"), path)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(pack(part.column("text"))[1])),
                     pa.array(n), pa.array(n > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
