"""Average precision of a ranked list, as one expression per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def average_precision(
    predicted: Column,
    actual: Column,
    k: int | None = None,
    empty_value: float = 0.0,
    dedupe: bool = False,
) -> Column:
    """Sum over hits of (hits so far / position), over the number of actual items.

    ``k`` cuts the predicted list and also caps the divisor at ``k``. ``empty_value`` is the
    score when there is nothing to find. ``dedupe`` drops repeated predictions first and reads
    ``actual`` as a set; without it each repeated prediction counts as a hit again, so the
    score may exceed 1. A null list counts as an empty one.
    """
    no_items = F.array().cast("array<int>")
    predicted = F.coalesce(predicted, no_items)
    actual = F.coalesce(actual, no_items)
    if dedupe:
        predicted, actual = F.array_distinct(predicted), F.array_distinct(actual)
    if k is not None:
        predicted = F.slice(predicted, 1, k)

    def step(acc: Column, item: Column) -> Column:
        hit = F.coalesce(F.array_contains(actual, item), F.lit(False))
        position = acc["position"] + 1
        hits = acc["hits"] + F.when(hit, 1).otherwise(0)
        gain = F.when(hit, hits / position).otherwise(F.lit(0.0))
        return F.struct(
            position.alias("position"), hits.alias("hits"), (acc["score"] + gain).alias("score")
        )

    start = F.struct(
        F.lit(0).alias("position"), F.lit(0).alias("hits"), F.lit(0.0).alias("score")
    )
    score = F.aggregate(predicted, start, step, lambda acc: acc["score"])
    wanted = F.size(actual) if k is None else F.least(F.size(actual), F.lit(k))
    return F.when(F.size(actual) == 0, F.lit(float(empty_value))).otherwise(score / wanted)
