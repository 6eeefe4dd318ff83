"""What the tests share. Not in a conftest: there are two modules of that name."""

from __future__ import annotations



def rows(df) -> list[tuple]:
    """Collected rows as sorted tuples, NULLs first."""
    key = lambda row: [(v is not None, str(v)) for v in row]
    return sorted((tuple(r) for r in df.collect()), key=key)
