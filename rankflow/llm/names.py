"""Names for helper columns next to columns of any name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """A name for each of ``wanted`` that no column of ``df`` has, in whatever case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
