"""Array sums over partitions."""

import numpy as np
import pytest

from matchlake.llm.counters import summed


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_summed(session, partitions):
    def count(batches):
        total = np.zeros(1000, np.int64)
        for batch in batches:
            np.add.at(total, batch.column(0).to_numpy() % 1000, 1)
        return total

    rows = session.range(0, 5500, 1, partitions)
    assert summed(rows, count, 1000).tolist() == [6 if i < 500 else 5 for i in range(1000)]
    assert summed(rows.limit(0), count, 1000).tolist() == [0] * 1000
