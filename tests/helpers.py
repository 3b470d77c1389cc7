from __future__ import annotations

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    """All rows as sorted tuples; NULLs first."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, v) for v in r))
