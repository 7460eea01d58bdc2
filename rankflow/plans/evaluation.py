"""Mean average precision of stored or computed predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.arrays import distinct_items, parse_int_list
from rankflow.functions.metrics import average_precision
from rankflow.operators.aggregates import last_write_wins
from rankflow.operators.joins import join_ranked
from rankflow.sources.readers import read_list_file


def map_at_k(
    predictions: DataFrame,
    actual: DataFrame,
    id_col: str,
    predicted_col: str,
    actual_col: str,
    k: int = 5,
) -> DataFrame:
    """One row, ``map``: precision summed over predictions with a truth, over all predictions.

    ``actual`` holds one item per row. Users without a truth score nothing but still count;
    without predictions the result is 0.

    Against a single item, the precision is a sum over the places where the list holds it:
    how often it came so far, over the place. So each place is looked up on its own among the
    counted truth rows. The predictions are computed once, for the sum and the count alike,
    and a user with very many truth rows is counted before the join.
    """
    items = F.slice(F.coalesce(predicted_col, F.array()), 1, k)

    def place(item: Column, index: Column) -> Column:
        so_far = F.size(F.filter(F.slice(items, 1, index + 1), lambda x: x == item))
        return F.struct(item.alias(actual_col), (so_far / (index + 1)).alias("_gain"))

    places = predictions.select(
        id_col, F.posexplode_outer(F.transform(items, place)).alias("_index", "_place")
    ).select(id_col, "_index", "_place.*")
    truth = actual.groupBy(id_col, actual_col).agg(F.count(F.lit(1)).alias("_n"))
    found = join_ranked(places, truth, [id_col, actual_col], "left")
    totals = found.agg(
        F.sum(F.col("_gain") * F.col("_n")).alias("total"),
        F.count_if(F.coalesce("_index", F.lit(0)) == 0).alias("predictions"),
    )
    mean = F.try_divide("total", "predictions")
    return totals.select(F.coalesce(mean, F.lit(0.0)).alias("map"))


def mean_average_precision(
    predictions: DataFrame, actual: DataFrame, id_col: str, predicted_col: str, actual_col: str
) -> DataFrame:
    """One row, ``map``: mean over all predictions, no cut-off; an id without truth scores 0.

    Repeated predictions count once. ``actual`` holds one list per id.
    """
    truth = actual.select(id_col, actual_col)
    joined = join_ranked(predictions.select(id_col, predicted_col), truth, [id_col], "left")
    ap = average_precision(F.col(predicted_col), F.col(actual_col), dedupe=True)
    return joined.agg(F.coalesce(F.avg(ap), F.lit(0.0)).alias("map"))


def score_list_files(spark: SparkSession, predicted_path: str, actual_path: str) -> DataFrame:
    """``mean_average_precision`` of two ``id,v1 v2 v3`` files; a later truth line replaces an
    earlier one of the same id."""
    predicted = read_list_file(spark, predicted_path)
    actual = last_write_wins(read_list_file(spark, actual_path), "id", ["items"], "seq")
    return mean_average_precision(
        predicted.select("id", distinct_items(parse_int_list("items")).alias("predicted")),
        actual.select("id", distinct_items(parse_int_list("items")).alias("actual")),
        "id",
        "predicted",
        "actual",
    )
