"""Equality joins whose hot keys can be split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_ranked(left: DataFrame, ranked: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join to a table that was just ranked or grouped by the same keys, hot keys of ``left`` split.

    At run time Spark splits a hot key only where both inputs are shuffled for the join. A
    table ranked by the keys is already partitioned by them and would not be; a hash of the
    keys as a further join column makes it so. The ranked side holds few rows per key.
    """
    differing = [c for c in keys if left.schema[c].dataType != ranked.schema[c].dataType]
    if differing:
        raise ValueError(f"join columns must have the same type on both sides: {differing}")
    mark = F.xxhash64(*keys)
    joined = left.withColumn("_mark", mark).join(
        ranked.withColumn("_mark", mark), ["_mark", *keys], how
    )
    return joined.drop("_mark")
