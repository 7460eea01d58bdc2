"""Positions and running totals over a whole table, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.operators.joins import join_ranked
from rankflow.sources.workspace import ensure_checkpoint_dir


def running_total(
    df: DataFrame, order_by: Sequence[Column], value: str, total_col: str = "before"
) -> DataFrame:
    """Sum of ``value`` over all rows that come strictly earlier in the order.

    The table is range-partitioned and checkpointed, so that both readers below see the same
    partitions even when an executor is lost. Totals per partition (one row each) give the
    offset, and each partition then runs its own window. ``order_by`` must order rows uniquely.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order_by).withColumn("_part", F.spark_partition_id()).checkpoint()
    parts = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = (
        Window.partitionBy("_part").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    )
    here = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return (
        ranged.withColumn("_here", here)
        .join(offsets, "_part")
        .withColumn(total_col, F.col("_here") + F.col("_offset"))
        .drop("_part", "_here", "_offset")
    )


def category_index(df: DataFrame, col: str, index_col: str = "index") -> DataFrame:
    """Distinct values numbered from 0 by falling frequency, then by value.

    The numbering of an ML string indexer as a table, for any number of distinct values.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_one", F.lit(1))
    numbered = running_total(counts, [F.desc("_n"), F.asc(col)], "_one", index_col)
    return numbered.select(col, F.col(index_col).cast("bigint").alias(index_col))


def label_order(df: DataFrame, col: str, label: str, order_col: str = "order") -> DataFrame:
    """``col``, n, mean (of ``label``, 0 or 1) and ``order_col``: categories numbered from 0 by rising mean, alike for equal ones.

    For two classes the best split of a tree on a category is one place in this order, so a category with any number of
    values serves as one ordered feature. Null is a category like others.
    """
    means = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"), (F.sum(F.col(label).cast("double")) / F.count(F.lit(1))).alias("mean"))
    numbered = running_total(means.select("mean").distinct().withColumn("_one", F.lit(1)), [F.asc("mean")], "_one", order_col)
    return join_ranked(means, numbered.select("mean", F.col(order_col).cast("bigint").alias(order_col)), ["mean"], "inner")


def with_label_order(df: DataFrame, col: str, orders: DataFrame, order_col: str) -> DataFrame:
    """``df`` with the number of its category from ``label_order``, -1 where training rows did not hold it."""
    places = orders.select(F.col(col).alias("_category"), order_col)
    joined = join_ranked(df.withColumn("_category", F.col(col)), places, ["_category"], "left").drop("_category")
    return joined.withColumn(order_col, F.coalesce(F.col(order_col), F.lit(-1)).cast("double"))


def rank_sum_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row with the exact area under the ROC curve, ties counted half; null for one class only.

    Rows collapse to counts per distinct score before anything is ordered.
    """
    positive = F.col(label) == 1
    counts = df.groupBy(score).agg(
        F.count_if(positive).alias("_pos"), F.count_if(~positive).alias("_neg")
    )
    below = running_total(counts, [F.asc(score)], "_neg", "_below")
    won = F.col("_pos").cast("double") * (F.col("_below") + F.col("_neg") / 2)
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return below.agg(F.try_divide(F.sum(won), pairs).alias("auc"))
