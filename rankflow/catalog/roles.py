"""Which column of the supplied tables plays which role in the recommender.

A request is an order with its customer; an interaction is a line of an order, and its item is
the number of the part's brand. The first two years are the training rows and everything later
the requests, so that together they cover the whole tables and some requests are new to every
rule. Training rows of the second year are the recent ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.columns import booking_weight, in_year, scaled_key
from rankflow.operators.topk import Rule

SPLIT_DATE = "1997-01-01"
RECENT_YEAR = 1996
PRICE_BAND = 25
RULE_BOOKING = 12
POPULAR_BOOKING = 5
ITEM = "item"
ID = "id"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_with_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").alias(ID),
        F.col("o_custkey").alias("user"),
        F.col("o_orderdate").alias("order_date"),
        F.col("c_nationkey").alias("city"),
        scaled_key("c_acctbal", 100).alias("distance_key"),
        F.floor(F.col("o_totalprice") / PRICE_BAND).alias("dest"),
        F.col("o_orderpriority").alias("country"),
        F.col("c_mktsegment").alias("market"),
    )


def lines_with_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.col("l_orderkey").alias(ID),
        F.substring("p_brand", 7, 10).cast("int").alias(ITEM),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("is_booking"),
        "l_extendedprice",
    )


def item_weights(spark: SparkSession, sf_dir: str, weight: Column) -> DataFrame:
    """``item, weight`` of every line, summed per part before the parts are looked up.

    Sums of sums are the same sums, and a part that fills a third of all lines is one row when
    it reaches the join.
    """
    flag = F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("is_booking")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", flag)
    per_part = lines.groupBy("l_partkey").agg(F.sum(weight).alias("weight"))
    part = table(spark, sf_dir, "part")
    joined = per_part.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(F.substring("p_brand", 7, 10).cast("int").alias(ITEM), "weight")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every order."""
    return lines_with_items(spark, sf_dir).join(orders_with_roles(spark, sf_dir), ID)


def before_split() -> Column:
    return F.col("order_date") < F.lit(SPLIT_DATE).cast("timestamp_ntz")


def training_and_requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training lines and later orders. Lines meet the early orders first, so only those look up their part."""
    orders = orders_with_roles(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(ID),
        "l_partkey",
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("is_booking"),
        "l_extendedprice",
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.substring("p_brand", 7, 10).cast("int").alias(ITEM)
    )
    early = lines.join(orders.where(before_split()), ID).join(part, "l_partkey").drop("l_partkey")
    return early, orders.where(~before_split())


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_and_requests(spark, sf_dir)[0]


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_with_roles(spark, sf_dir).where(~before_split())


def rules() -> list[Rule]:
    weight = booking_weight("is_booking", RULE_BOOKING)
    return [
        Rule(("city", "distance_key")),
        Rule(("dest", "country", "market"), weight, in_year("order_date", RECENT_YEAR)),
        Rule(("dest",), weight),
    ]


def popular_weight() -> Column:
    return booking_weight("is_booking", POPULAR_BOOKING)
