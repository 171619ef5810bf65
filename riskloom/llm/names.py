"""Names for columns of the library's own that no column of the caller has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with as many underscores before it as no column of df has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
