"""Joint means and the last value per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joint_means(dfs: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """One row: the mean of each column over all tables together; 0 where no value exists."""
    merged = reduce(DataFrame.unionByName, [df.select(*cols) for df in dfs])
    return merged.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in cols])


def impute_joint_mean(dfs: Sequence[DataFrame], cols: Sequence[str]) -> list[DataFrame]:
    """Each table with nulls in ``cols`` replaced by the joint mean, column types kept.

    All means come from one pass and enter as a scalar subquery: no value passes through user
    code on the driver and nothing is joined.
    """
    means = joint_means(dfs, cols).select(F.struct(*cols).alias("means")).scalar()
    filled = []
    for df in dfs:
        new = {c: F.coalesce(c, means[c].cast(df.schema[c].dataType)) for c in cols}
        filled.append(df.withColumns(new))
    return filled


def last_write_wins(df: DataFrame, key: str, values: Sequence[str], seq: Column | str) -> DataFrame:
    """The values of the row with the greatest ``seq`` per key. ``seq`` must be unique per key."""
    last = F.max_by(F.struct(*values), seq).alias("_last")
    return df.groupBy(key).agg(last).select(key, *[F.col("_last")[v].alias(v) for v in values])

