import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from rankflow.catalog import roles
from rankflow.functions import booking_weight, join_items
from rankflow.operators import (
    Rule,
    candidates,
    fill_remainder,
    match_rule,
    match_rules,
    ordered_lists,
    popular_list,
    rule_candidates,
    union_rerank,
    unmatched_ids,
)
from rankflow.plans import recommend

TRAIN = "city int, dest string, item int, booked int, recent boolean"
REQUESTS = "id int, city int, dest string"


def rules():
    weight = booking_weight("booked", 12)
    return [Rule(("city", "dest")), Rule(("city",), weight, F.col("recent")), Rule(("dest",), weight)]


def popular_weight():
    return booking_weight("booked", 5)


def tables(seed, n_train=150, n_requests=120, n_items=9):
    rng = random.Random(seed)
    maybe = lambda v: None if rng.random() < 0.15 else v
    train = [
        (
            maybe(rng.randrange(6)),
            maybe(rng.choice(["", *"abcdefg"])),
            rng.randrange(n_items),
            rng.randrange(2),
            rng.random() < 0.4,
        )
        for _ in range(n_train)
    ]
    requests = [
        (i, maybe(rng.randrange(12)), maybe(rng.choice(["", *"abcdefghijklmno"]))) for i in range(n_requests)
    ]
    return train, requests


def ranking(rows, key, weight, k):
    scores = defaultdict(lambda: defaultdict(int))
    for row in rows:
        scores[key(row)][row[2]] += weight(row)
    return {
        group: [i for i, _ in sorted(items.items(), key=lambda x: (-x[1], x[0]))[:k]]
        for group, items in scores.items()
    }


def brute_force(train, requests, k=5, dedupe=False):
    """The lists in plain Python, rule by rule. Repeated ids share one list."""
    heavy = lambda r: r[3] * 12 + 3
    tables = [
        ((1, 2), ranking([r for r in train if None not in r[:2]], lambda r: r[:2], lambda r: 1, k)),
        ((1,), ranking([r for r in train if r[4] and r[0] is not None], lambda r: r[:1], heavy, k)),
        ((2,), ranking([r for r in train if r[1] is not None], lambda r: r[1:2], heavy, k)),
    ]
    top = ranking(train, lambda r: (), lambda r: r[3] * 5 + 3, k).get((), [])
    matched = defaultdict(list)
    for request in requests:
        matched[request[0]]
        for step, (places, table) in enumerate(tables):
            key = tuple(request[p] for p in places)
            for rank, item in enumerate(table.get(key, []) if None not in key else [], 1):
                matched[request[0]].append((rank * 10**step, item))
    lists = {}
    for id_, hits in matched.items():
        hits = sorted(hits or [(999, item) for item in top])
        items = [item for _, item in hits]
        if dedupe:
            items = list(dict.fromkeys(items + top))
        else:
            items = items[:k] + top
        lists[id_] = items[:k]
    return lists


def as_dict(df):
    rows = df.collect()
    lists = {r[0]: r[1] for r in rows}
    assert len(lists) == len(rows)
    return lists


def run(spark, train, requests, **options):
    return recommend(
        spark.createDataFrame(train, TRAIN),
        spark.createDataFrame(requests, REQUESTS),
        rules(),
        popular_weight(),
        id_col="id",
        item="item",
        **options,
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("dedupe", [False, True])
def test_recommend_against_brute_force(spark, seed, dedupe):
    train, requests = tables(seed)
    expected = brute_force(train, requests, dedupe=dedupe)
    assert as_dict(run(spark, train, requests, dedupe=dedupe)) == expected
    if dedupe:
        assert all(len(set(items)) == len(items) for items in expected.values())


@pytest.mark.parametrize("k", [1, 3, 9])
def test_other_list_lengths(spark, k):
    train, requests = tables(4, n_items=20)
    assert as_dict(run(spark, train, requests, k=k)) == brute_force(train, requests, k)


def test_repeated_ids_share_a_list(spark):
    train, requests = tables(5)
    requests = requests + [(i % 10, c, d) for i, c, d in requests]
    assert as_dict(run(spark, train, requests)) == brute_force(train, requests)


def test_no_training_rows_and_no_requests(spark):
    _, requests = tables(6, n_requests=5)
    assert as_dict(run(spark, [], requests)) == {i: [] for i in range(5)}
    train, _ = tables(6)
    assert run(spark, train, []).count() == 0


def test_every_id_gets_a_full_list(spark):
    train, requests = tables(7)
    lists = as_dict(run(spark, train, requests))
    assert set(lists) == {r[0] for r in requests}
    assert all(len(items) == 5 for items in lists.values())


def stepwise(train_df, requests_df, k=5):
    hits = [
        match_rule(requests_df, candidates(train_df, rule, "item", k), rule.keys, "id", "item", 10**n)
        for n, rule in enumerate(rules())
    ]
    top = popular_list(train_df, "item", popular_weight(), k)
    rest = fill_remainder(unmatched_ids(requests_df, "id", *hits), "id", "item", top)
    return ordered_lists(union_rerank([*hits, rest], "id", "item", k), "id", "item", top, k)


def test_steps_give_the_same_lists(spark):
    train, requests = tables(8)
    train_df, requests_df = spark.createDataFrame(train, TRAIN), spark.createDataFrame(requests, REQUESTS)
    assert as_dict(stepwise(train_df, requests_df)) == brute_force(train, requests)


def test_matches_of_one_join_equal_those_of_single_rules(spark):
    train, requests = tables(9)
    train_df, requests_df = spark.createDataFrame(train, TRAIN), spark.createDataFrame(requests, REQUESTS)
    together = match_rules(requests_df, rule_candidates(train_df, rules(), "item"), rules(), "id", "item")
    found = sorted(map(tuple, together.where(F.col("rn").isNotNull()).collect()))
    single = []
    for n, rule in enumerate(rules()):
        table = candidates(train_df, rule, "item")
        single += map(tuple, match_rule(requests_df, table, rule.keys, "id", "item", 10**n).collect())
    assert found == sorted(single)
    assert {r.id for r in together.select("id").distinct().collect()} == {r[0] for r in requests}


def test_unmatched_ids_are_distinct(spark):
    requests = spark.createDataFrame([(1,), (1,), (2,), (3,)], "id int")
    hits = spark.createDataFrame([(2,), (2,), (9,)], "id int")
    assert [r.id for r in unmatched_ids(requests, "id", hits).orderBy("id").collect()] == [1, 3]


def test_key_types_must_agree(spark):
    train, requests = tables(10)
    wide = spark.createDataFrame(requests, "id int, city bigint, dest string")
    table = rule_candidates(spark.createDataFrame(train, TRAIN), rules(), "item")
    with pytest.raises(ValueError, match="city"):
        match_rules(wide, table, rules(), "id", "item")


# Lists computed beforehand with another engine, on training rows without low-priority orders
# and without every tenth customer, for the requests of the last year.
PUBLISHED = {
    "0.001": (122, (555, 141, 480, 20), {2: "25 14 20 4 6", 27: "11 16 14 17 3", 44: "11 5 9 14 17"}),
    "0.01": (1308, (5860, 4854, 5270, 105), {23: "3 10 17 18 21", 24: "15 22 4 24 1", 63: "3 7 4 12 17"}),
}


@pytest.mark.parametrize("sf", list(PUBLISHED))
def test_published_lists(spark, sf):
    n_ids, n_rows, first = PUBLISHED[sf]
    sf_dir = f"{TESTDATA}/sf{sf}"
    orders = roles.orders_with_roles(spark, sf_dir).drop("dest").withColumnRenamed("country", "dest")
    lines = roles.lines_with_items(spark, sf_dir).join(orders, "id")
    year = F.year("order_date")
    train = lines.where((year < 2001) & (F.col("dest") != "5-LOW") & (F.col("user") % 10 != 0))
    requests = orders.where(year == 2001)
    weight = booking_weight("is_booking", 12)
    recent = F.year("order_date") == 2000
    cascade = [
        Rule(("city", "distance_key")),
        Rule(("dest", "city", "market"), weight, recent),
        Rule(("dest",), weight),
    ]
    hits = match_rules(requests, rule_candidates(train, cascade, "item"), cascade, "id", "item")
    counts = dict(hits.where("rn is not null").groupBy(F.floor(F.log10("rn"))).count().collect())
    ids = hits.groupBy("id").agg(F.max("rn").alias("rn"))
    assert ids.count() == n_ids
    assert (counts[0], counts[1], counts[2], 5 * ids.where("rn is null").count()) == n_rows
    lists = recommend(
        train, requests, cascade, booking_weight("is_booking", 5), id_col="id", item="item"
    ).select("id", join_items("item"))
    assert dict(map(tuple, lists.orderBy("id").limit(3).collect())) == first


def test_distinct_lists_keep_lists_whole_until_they_are_merged(spark, conf):
    """Matches used to become a row per item before repeats were dropped, in a hash table of every id and item."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    lists = recommend(
        roles.training(spark, f"{TESTDATA}/sf0.001"), roles.requests(spark, f"{TESTDATA}/sf0.001"), roles.rules(),
        roles.popular_weight(), id_col="id", item="item", dedupe=True,
    )
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" in plan and "HashAggregate(keys=[id#" not in plan.replace("ObjectHashAggregate", "")


@pytest.mark.parametrize("seed", range(3))
def test_distinct_lists_of_repeated_ids(spark, seed):
    """Ids that ask many times, null ones too, with lists that share their first items."""
    train, asked = tables(seed, n_requests=150)
    asked = [(None if i % 15 == 0 else i % 15, c, d) for i, c, d in asked]
    train_df, asked_df = spark.createDataFrame(train, TRAIN), spark.createDataFrame(asked, REQUESTS)
    got = recommend(train_df, asked_df, rules(), popular_weight(), id_col="id", item="item", k=3, dedupe=True)
    ranked = rule_candidates(train_df, rules(), "item", 3)
    best = match_rules(asked_df, ranked, rules(), "id", "item", 3).groupBy("id", "item").agg(F.min("rn").alias("rn"))
    top = popular_list(train_df, "item", popular_weight(), 3)
    expected = ordered_lists(union_rerank([best], "id", "item", 3), "id", "item", top, 3, dedupe=True)
    assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str)


def test_only_the_first_rule_leaves_a_row_without_a_match(spark):
    """Each rule without a match used to leave a row to sort and shuffle."""
    train = spark.createDataFrame([(1, "a", 7, 0, True)], TRAIN)
    asked = spark.createDataFrame([(1, 1, "zz"), (2, 5, "zz"), (3, 1, "a")], REQUESTS)
    hits = match_rules(asked, rule_candidates(train, rules(), "item"), rules(), "id", "item")
    assert sorted(hits.collect(), key=str) == [(1, 7, 10), (1, None, None), (2, None, None), (3, 7, 1), (3, 7, 10), (3, 7, 100)]
