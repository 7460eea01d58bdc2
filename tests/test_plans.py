"""Shape of the physical plans: what is shuffled, reused, pushed down and split."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from rankflow.catalog import ORACLES, QUERIES, roles
from rankflow.operators import (
    Rule,
    candidates,
    match_rule,
    match_rules,
    popular_items,
    rule_candidates,
)
from rankflow.plans import map_at_k, mean_average_precision, pair_features, recommend

SMALL = f"{TESTDATA}/sf0.001"
#: They grow 180 forests before there is a plan.
FORESTS = ("rf_predict", "forest_rule", "wide_forest", "passenger_files")
PRODUCTS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The plan after adaptive execution."""
    df.collect()
    return planned(df)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in FORESTS])
def test_no_products_and_no_python(spark, name):
    plan = planned(QUERIES[name](spark, SMALL))
    assert not [word for word in PRODUCTS + PYTHON if word in plan]


def test_groups_are_trimmed_before_the_shuffle(spark):
    for name in ("topk_exact_key", "topk_year_rule", "topk_single_key", "cascade_recommend"):
        plan = planned(QUERIES[name](spark, SMALL))
        assert plan.count("row_number(), 5, Partial") == plan.count("row_number(), 5, Final") > 0


def test_year_rule_reaches_the_scan(spark, conf):
    conf("spark.sql.maxMetadataStringLength", "2000")
    plan = planned(QUERIES["topk_year_rule"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in plan
    assert "LessThan(o_orderdate,1997-01-01T00:00)" in plan


def test_scans_read_only_what_is_used(spark):
    plan = planned(QUERIES["weighted_popularity"](spark, SMALL))
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string>" in plan


def test_global_top_is_not_a_full_sort(spark):
    lines = roles.lines_with_items(spark, SMALL)
    assert "TakeOrderedAndProject" in planned(popular_items(lines, "item"))


def test_training_rows_are_aggregated_once(spark, conf):
    """Without broadcasts, as at scale, the global list reads the shuffled candidates."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    lists = recommend(
        roles.training(spark, SMALL),
        roles.requests(spark, SMALL),
        roles.rules(),
        roles.popular_weight(),
        id_col="id",
        item="item",
    )
    assert "ReusedExchange [rule" in executed(lists)


@pytest.mark.parametrize("name", ["remainder_fill", "union_rerank", "ordered_lists"])
def test_stepwise_queries_scan_the_training_rows_once(spark, conf, name):
    """Without broadcasts, as at scale, the global list reads the shuffled candidates of the rules."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "ReusedExchange [rule" in executed(QUERIES[name](spark, SMALL))


# --- hot keys --------------------------------------------------------------------------------


@pytest.fixture
def skew(conf):
    """Thresholds at which a few hundred kilobytes count as a hot partition."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "30KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")


@pytest.fixture
def hot_tables(spark, tmp_path):
    """The middle tables with one part in two thirds of the lines and one customer in two thirds of the orders."""
    source = f"{TESTDATA}/sf0.01"
    for name, key in (("lineitem", "l_partkey"), ("orders", "o_custkey"), ("part", None), ("customer", None)):
        df = spark.read.parquet(f"{source}/{name}.parquet").repartition(8)
        if key:
            hot = F.pmod(F.xxhash64(*df.columns), F.lit(3)) > 0
            df = df.withColumn(key, F.when(hot, F.lit(1)).otherwise(F.col(key)))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_hot_part_and_customer_are_split(spark, skew, conf, hot_tables):
    lines = roles.lines_with_items(spark, hot_tables)
    assert "skew=true" in executed(lines) and lines.count() == 60000
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "5KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8KB")
    orders = roles.orders_with_roles(spark, hot_tables)
    assert "skew=true" in executed(orders) and orders.count() == 15000
    train = roles.training(spark, hot_tables)
    early = orders.where(roles.before_split()).select("id")
    assert train.count() == lines.join(early, "id").count()


def test_only_lines_of_early_orders_look_up_their_part(spark):
    plan = roles.training(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "l_partkey" in joins[0] and not any("l_partkey" in j for j in joins[1:])


def hot_requests(spark, n=60000):
    """Half of all requests ask for the same place, a sixth for none."""
    place = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 500)
    return spark.range(n, numPartitions=8).select(F.col("id").cast("int"), place.cast("int").alias("place"))


def visits(spark):
    rows = spark.range(5000, numPartitions=4)
    return rows.select(
        (F.col("id") % 400).cast("int").alias("place"), (F.col("id") % 13).cast("int").alias("item")
    )


def test_hot_key_of_a_cascade_is_split(spark, skew):
    rules = [Rule(("place",))]
    table = rule_candidates(visits(spark), rules, "item")
    hits = match_rules(hot_requests(spark), table, rules, "id", "item")
    assert "skew=true" in executed(hits)
    expected = hot_requests(spark).join(candidates(visits(spark), rules[0], "item"), "place", "left")
    assert hits.count() == expected.count()
    assert hits.where(F.col("rn").isNotNull()).count() == expected.where(F.col("rn").isNotNull()).count()


def test_hot_key_of_the_recommender_is_split(spark, skew):
    lists = recommend(
        visits(spark), hot_requests(spark), [Rule(("place",))], None, id_col="id", item="item"
    )
    assert "skew=true" in executed(lists)
    assert lists.count() == 60000


def test_hot_id_is_trimmed_before_the_shuffle(spark, skew):
    """All requests carry one id: each task passes on only its first rows of it."""
    same = hot_requests(spark).withColumn("id", F.when(F.col("id") < 0, 2).otherwise(1))
    lists = recommend(visits(spark), same, [Rule(("place",))], None, id_col="id", item="item")
    assert "WindowGroupLimit [id" in planned(lists)
    assert lists.count() == 1


def test_hot_key_of_a_rule_is_split(spark, skew):
    table = candidates(visits(spark), Rule(("place",)), "item")
    assert "skew=true" in executed(match_rule(hot_requests(spark), table, ["place"], "id", "item"))


def test_requests_without_keys_are_spread(spark, skew, conf):
    """All requests lack the key; they must not meet in one partition."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    nothing = spark.range(40000, numPartitions=8).select(F.col("id").cast("int"), F.lit(None).cast("int").alias("place"))
    rules = [Rule(("place",))]
    hits = match_rules(nothing, rule_candidates(visits(spark), rules, "item"), rules, "id", "item")
    sizes = [r["count"] for r in hits.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40000 and max(sizes) < 40000 / 3


def test_hot_user_in_evaluation(spark, skew):
    user = F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 500).cast("int").alias("user")
    many = spark.range(60000, numPartitions=8).select(user, (F.col("id") % 5).cast("int").alias("item"))
    lists = many.groupBy("user").agg(F.sort_array(F.collect_set("item")).alias("items"))
    # Truth rows are counted per user and item before they are shuffled.
    counted = map_at_k(lists, many, "user", "items", "item")
    assert "keys=[user#" in planned(counted) and "partial_count(1)" in planned(counted)
    repeated = many.select("user", F.array("item").alias("items"))
    truth = lists.withColumnRenamed("items", "actual")
    assert "skew=true" in executed(mean_average_precision(repeated, truth, "user", "items", "actual"))


def test_hot_item_in_pairs_is_split(spark, skew):
    ids = F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 900).cast("int")
    pairs = spark.range(60000, numPartitions=8).select(
        ids.alias("itemID_1"), (F.col("id") % 900).cast("int").alias("itemID_2")
    )
    info = spark.range(900).select(
        F.col("id").cast("int").alias("itemID"),
        F.lit("abc").alias("title"),
        F.lit("abcdef").alias("description"),
        F.lit("x").alias("images_array"),
        F.lit("x").alias("attrsJSON"),
        (F.col("id") % 9).cast("int").alias("locationID"),
    )
    location = spark.range(9).select(F.col("id").cast("int").alias("locationID"), F.col("id").alias("regionID"))
    features = pair_features(pairs, info, location)
    assert "skew=true" in executed(features)
    assert features.count() == 60000
    assert features.agg(F.sum("title_1"), F.sum("description_2")).first() == (180000, 360000)


def test_every_query_but_the_forest_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"rf_predict"}
