"""Five items per request from rules in priority order, filled from the most popular items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.arrays import join_items
from rankflow.functions.columns import booking_weight, in_year, scaled_key
from rankflow.operators.cascade import match_lists, merge_lists
from rankflow.operators.topk import Rule, rule_lists
from rankflow.sources.audit import read_clean
from rankflow.sources.schemas import interaction_schema
from rankflow.sources.sinks import write_csv

# What a booking adds to an interaction's weight, for the rules and for the
# global list; the factor for the distance key; the year of the second rule.
RULE_BOOKING = 12
POPULAR_BOOKING = 5
DISTANCE_SCALE = 100000
RECENT_YEAR = 2014


def recommend(
    train: DataFrame,
    requests: DataFrame,
    rules: Sequence[Rule],
    popular_weight: Column | None,
    *,
    id_col: str,
    item: str,
    k: int = 5,
    dedupe: bool = False,
) -> DataFrame:
    """``id, items`` for every request id: ``k`` items as an array.

    One pass over ``train`` ranks the candidates of all rules and the global list, the latter as
    a rule without keys. One join matches requests to candidate lists, one shuffle by id merges
    the matches. Requests that no rule matched come out of the same join, so there is no set
    difference. Items may repeat, within the rules' matches and from padding; ``dedupe``
    prevents that.
    """
    all_rules = [Rule(keys=(), weight=popular_weight), *rules]
    lists = rule_lists(train, all_rules, item, k, first_number=0)
    popular = _global_list(lists)
    matched = match_lists(requests, lists, rules, id_col)
    return merge_lists(matched, id_col, item, popular, k, dedupe)


def _global_list(lists: DataFrame) -> Column:
    """Items of rule 0 as an array constant; empty without training rows.

    Rule 0 is picked inside the aggregate and not by a filter: a filter would sink to the scan,
    and the subquery could no longer reuse the shuffled candidates of the main plan.
    """
    row = lists.agg(F.max(F.when(F.col("rule") == 0, F.col("_items"))).alias("best"))
    none = F.array().cast(lists.schema["_items"].dataType)
    return row.select(F.coalesce("best", none).alias("best")).scalar()


def hotel_rules() -> list[Rule]:
    """Same city and distance; same destination and market, recent year; same destination."""
    weight = booking_weight("is_booking", RULE_BOOKING)
    return [
        Rule(("user_location_city", "distance_key")),
        Rule(
            ("srch_destination_id", "hotel_country", "hotel_market"),
            weight,
            in_year("date_time", RECENT_YEAR, "timestamp"),
        ),
        Rule(("srch_destination_id",), weight),
    ]


def recommend_hotels(train: DataFrame, requests: DataFrame, dedupe: bool = False) -> DataFrame:
    """``recommend`` over interaction tables: ``id, hotel_cluster`` as a blank-separated list."""
    distance = scaled_key("orig_destination_distance", DISTANCE_SCALE)
    lists = recommend(
        train.withColumn("distance_key", distance),
        requests.withColumn("distance_key", distance),
        hotel_rules(),
        booking_weight("is_booking", POPULAR_BOOKING),
        id_col="id",
        item="hotel_cluster",
        dedupe=dedupe,
    )
    return lists.select("id", join_items("hotel_cluster").alias("hotel_cluster"))


def interactions_and_requests(
    spark: SparkSession, train_path: str, requests_path: str
) -> tuple[DataFrame, DataFrame]:
    """Both files, checked while they are read."""
    train = read_clean(spark, train_path, interaction_schema(True))
    return train, read_clean(spark, requests_path, interaction_schema(False))


def submit_hotels(spark: SparkSession, train_path: str, requests_path: str, out: str) -> None:
    """CSV files in, CSV files out, sorted by id."""
    train, requests = interactions_and_requests(spark, train_path, requests_path)
    write_csv(recommend_hotels(train, requests), out, order_by=["id"])
