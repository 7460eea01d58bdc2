import pytest
from pyspark.sql import functions as F

from rankflow.functions import (
    family_size,
    in_year,
    passenger_title,
    scaled_key,
    suffix_columns,
    text_length,
    with_default,
)
from rankflow.operators import (
    clean_item_info,
    enrich_pairs,
    impute_joint_mean,
    joint_means,
    last_write_wins,
)
from rankflow.plans import pair_features


@pytest.mark.parametrize(
    "name, sex, title",
    [
        ("Braund, Mr. Owen Harris", "male", "Mr"),
        ("Cumings, Mrs. John (Florence)", "female", "Mrs"),
        ("Sagesser, Mlle. Emma", "female", "Miss"),
        ("Crosby, Capt. Edward", "male", "Col"),
        ("Uruchurtu, Don. Manuel", "male", "Mr"),
        ("Aubart, Mme. Leontine", "female", "Mrs"),
        ("Rothes, the Countess. of", "female", "Mrs"),
        ("Reuchlin, Jonkheer. John", "male", "Mr"),
        ("Someone, Xyz. Unknown", None, "Mrs"),
        ("Someone, . Unknown", "male", "Mr"),
        ("Someone, . Unknown", "female", "Mrs"),
        ("No comma Mrs. Here", "female", "Mr"),
        ("No point, Mrs Here", "female", "Mr"),
        ("First, Second, Dr. Third", "male", "Dr"),
        ("Line, Dr. One\n", "male", "Mr"),
        (None, "female", "Mr"),
    ],
)
def test_titles(spark, name, sex, title):
    df = spark.createDataFrame([(name, sex)], "Name string, Sex string")
    assert df.select(passenger_title("Name", "Sex")).first()[0] == title


def test_family_size(spark):
    df = spark.createDataFrame([(1, 2), (0, 0), (None, 1)], "a int, b int")
    assert [r[0] for r in df.select(family_size("a", "b")).collect()] == [4, 1, None]


def test_default_replaces_null_and_empty(spark):
    df = spark.createDataFrame([("",), (None,), ("C",)], "port string")
    assert [r[0] for r in df.select(with_default("port", "S")).collect()] == ["S", "S", "C"]


def test_text_length_of_missing_text_is_zero(spark):
    df = spark.createDataFrame([(None,), ("",), ("añb",)], "t string")
    assert [r[0] for r in df.select(text_length("t")).collect()] == [0, 0, 3]


def test_scaled_key_is_the_same_for_float_and_double(spark):
    df = spark.createDataFrame([(2226.2622, 2226.2622), (0.0, 0.0), (None, None)], "f float, d double")
    keys = df.select(scaled_key("f", 100).alias("f"), scaled_key("d", 100).alias("d")).collect()
    assert [(r.f, r.d) for r in keys] == [(222626, 222626), (0, 0), (None, None)]
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),)], "f float")
    assert [r[0] for r in odd.select(scaled_key("f", 100)).collect()] == [None, None]


def test_in_year_equals_year_of(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp'2013-12-31 23:59:59', timestamp'2014-01-01 00:00:00',"
        " timestamp'2014-12-31 23:59:59', timestamp'2015-01-01 00:00:00', null)) AS ts"
    )
    found = df.where(in_year("ts", 2014, "timestamp")).collect()
    assert found == df.where(F.year("ts") == 2014).collect() and len(found) == 2


def test_joint_means(spark):
    a = spark.createDataFrame([(1.0, None), (None, None)], "age float, fare float")
    b = spark.createDataFrame([(4.0, None)], "age float, fare float")
    assert tuple(joint_means([a, b], ["age", "fare"]).first()) == (2.5, 0.0)
    filled = impute_joint_mean([a, b], ["age", "fare"])
    assert [tuple(r) for r in filled[0].collect()] == [(1.0, 0.0), (2.5, 0.0)]
    assert [tuple(r) for r in filled[1].collect()] == [(4.0, 0.0)]
    assert filled[0].schema == a.schema


def test_joint_means_of_nothing(spark):
    empty = spark.createDataFrame([], "age double")
    assert joint_means([empty, empty], ["age"]).first().age == 0.0


def test_last_write_wins(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, None, 1)], "k int, v string, seq int")
    assert sorted(map(tuple, last_write_wins(df, "k", ["v"], "seq").collect())) == [(1, "b"), (2, None)]


def test_suffix_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert suffix_columns(df, "_2").columns == ["a_2", "b_2"]


INFO = (
    "itemID int, categoryID int, title string, description string, images_array string,"
    " attrsJSON string, price double, locationID int, metroID int, lat double, lon double"
)


def item_info(spark):
    return spark.createDataFrame(
        [
            (1, 10, "abc", None, "7, 8", '{"a":"b"}', 5.0, 100, None, 1.0, 2.0),
            (2, 10, None, "hello", None, None, None, 200, 3, 1.5, 2.5),
            (3, 11, "x", "y", None, None, 1.0, 999, 4, 0.0, 0.0),
        ],
        INFO,
    )


def test_clean_item_info(spark):
    cleaned = clean_item_info(item_info(spark), ["images_array", "attrsJSON"], ["title", "description"])
    assert cleaned.columns == [
        "itemID", "categoryID", "title", "description", "price", "locationID", "metroID", "lat", "lon"
    ]
    rows = {r.itemID: (r.title, r.description, r.price) for r in cleaned.collect()}
    assert rows == {1: (3, 0, 5.0), 2: (0, 5, None), 3: (1, 1, 1.0)}


def test_pair_features(spark):
    location = spark.createDataFrame([(100, 1), (200, 2)], "locationID int, regionID int")
    pairs = spark.createDataFrame(
        [(1, 2), (2, 1), (1, 1), (1, 3), (1, 77), (None, 1)], "itemID_1 int, itemID_2 int"
    )
    features = pair_features(pairs, item_info(spark), location)
    assert features.columns[:4] == ["locationID_2", "locationID_1", "itemID_2", "itemID_1"]
    rows = sorted((r.itemID_1, r.itemID_2, r.title_1, r.title_2, r.regionID_1, r.regionID_2) for r in features.collect())
    # 3 has an unknown location, 77 is unknown.
    assert rows == [(1, 1, 3, 3, 1, 1), (1, 2, 3, 0, 1, 2), (2, 1, 0, 3, 2, 1)]


def test_pairs_equal_four_separate_joins(spark):
    """Looking up the location once per item gives the rows of looking it up per member."""
    info = spark.createDataFrame([(i, i % 4) for i in range(30)] + [(5, 1)], "itemID int, locationID int")
    location = spark.createDataFrame([(0, 7), (1, 8), (1, 9), (2, 7)], "locationID int, regionID int")
    pairs = spark.createDataFrame([(i % 30, i * 7 % 31) for i in range(80)], "itemID_1 int, itemID_2 int")
    expected = pairs
    for df, key in ((info, "itemID"), (location, "locationID")):
        for suffix in ("_1", "_2"):
            expected = expected.join(suffix_columns(df, suffix), key + suffix)
    actual = enrich_pairs(pairs, info, location, "itemID", "locationID")
    assert actual.columns == ["locationID_2", "locationID_1", "itemID_2", "itemID_1", "regionID_1", "regionID_2"]
    assert sorted(map(tuple, actual.collect())) == sorted(map(tuple, expected.select(actual.columns).collect()))
