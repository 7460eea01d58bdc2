import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rankflow.functions import booking_weight
from rankflow.operators import (
    Rule,
    candidates,
    popular_items,
    popular_list,
    popularity,
    rule_candidates,
    top_k_per_group,
)

from rankflow.plans import recommend

SCHEMA = "city int, dest string, item int, booked int, recent boolean"


def rows(n=600, seed=3):
    rng = random.Random(seed)
    maybe = lambda v: None if rng.random() < 0.1 else v
    return [
        (
            maybe(rng.randrange(4)),
            maybe(rng.choice("abc")),
            rng.randrange(9),
            rng.randrange(2),
            rng.random() < 0.5,
        )
        for _ in range(n)
    ]


def test_ties_go_to_the_lower_item(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 1, 1), ("a", 2, 5), ("b", 9, 1)], "k string, item int, n int")
    top = top_k_per_group(df, ["k"], [F.desc("n"), F.asc("item")], 2)
    assert sorted(tuple(r) for r in top.collect()) == [("a", 1, 1, 2), ("a", 2, 5, 1), ("b", 9, 1, 1)]


def brute_force(data, key, weight, keep, k=5):
    scores = defaultdict(lambda: defaultdict(int))
    for row in data:
        if keep(row) and None not in key(row):
            scores[key(row)][row[2]] += weight(row)
    return {
        (*group, item, score, rank)
        for group, items in scores.items()
        for rank, (item, score) in enumerate(sorted(items.items(), key=lambda x: (-x[1], x[0]))[:k], 1)
    }


def test_candidates_against_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    counted = candidates(df, Rule(("city", "dest")), "item")
    assert {tuple(r) for r in counted.collect()} == brute_force(
        data, lambda r: (r[0], r[1]), lambda r: 1, lambda r: True
    )
    weighted = candidates(df, Rule(("dest",), booking_weight("booked", 12), F.col("recent")), "item", k=3)
    assert {tuple(r) for r in weighted.collect()} == brute_force(
        data, lambda r: (r[1],), lambda r: r[3] * 12 + 3, lambda r: r[4], k=3
    )


def test_null_keys_can_be_kept(spark):
    df = spark.createDataFrame([(None, "a", 1, 0, True)], SCHEMA)
    assert candidates(df, Rule(("city",)), "item").count() == 0
    assert candidates(df, Rule(("city",)), "item", keep_null_keys=True).count() == 1


def test_one_pass_equals_rule_by_rule(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    rules = [
        Rule(("city", "dest")),
        Rule(("dest",), booking_weight("booked", 12), F.col("recent")),
        Rule(("city",), booking_weight("booked", 5)),
    ]
    together = rule_candidates(df, rules, "item")
    for number, rule in enumerate(rules, start=1):
        alone = candidates(df, rule, "item").select(*rule.keys, "item", "score", "rn")
        part = together.where(F.col("rule") == number).select(*rule.keys, "item", "score", "rn")
        assert sorted(map(tuple, part.collect())) == sorted(map(tuple, alone.collect()))


def test_fractional_weights(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (1, 1, 0.75), (1, 2, 1.0)], "city int, item int, w double")
    rules = [Rule(("city",), F.col("w")), Rule(("city",))]
    rows = rule_candidates(df, rules, "item").orderBy("rule", "rn").collect()
    assert [(r.rule, r.item, r.score) for r in rows] == [(1, 1, 1.25), (1, 2, 1.0), (2, 1, 2.0), (2, 2, 1.0)]


def test_ranks_have_no_gaps(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    ranks = candidates(df, Rule(("city",)), "item").groupBy("city").agg(F.sort_array(F.collect_list("rn")))
    for _, numbers in ranks.collect():
        assert numbers == list(range(1, len(numbers) + 1)) and len(numbers) <= 5


def test_popularity(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (3, 0), (4, 0)], "item int, booked int")
    weight = booking_weight("booked", 5)
    assert [tuple(r) for r in popularity(df, "item", weight).collect()] == [(2, 8), (3, 6), (1, 3), (4, 3)]
    assert [r.item for r in popular_items(df, "item", weight, 2).collect()] == [2, 3]
    listed = spark.range(2).select(popular_list(df, "item", weight, 3).alias("top"))
    assert [r.top for r in listed.collect()] == [[2, 3, 1]] * 2
    empty = spark.range(1).select(popular_list(df.where("false"), "item").alias("top"))
    assert empty.first().top == []


def test_key_names_that_the_ranking_adds_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "rn int, item int")
    with pytest.raises(ValueError, match="rn"):
        rule_candidates(df, [Rule(("rn",))], "item")


def test_rows_without_an_item_rank_nothing(spark):
    rows = [(1, None)] * 9 + [(1, 3), (1, 4), (1, 3), (2, None)]
    df = spark.createDataFrame(rows, "key int, item int")
    assert [r.item for r in candidates(df, Rule(("key",)), "item").orderBy("rn").collect()] == [3, 4]
    assert {r.item for r in rule_candidates(df, [Rule(("key",)), Rule(())], "item").collect()} == {3, 4}
    assert [r.item for r in popularity(df, "item").collect()] == [3, 4]
    lists = recommend(df, df.select("key", F.col("key").alias("id")).distinct(), [Rule(("key",))], None, id_col="id", item="item")
    assert {r.id: r.item for r in lists.collect()} == {1: [3, 4, 3, 4], 2: [3, 4, 3, 4]}
