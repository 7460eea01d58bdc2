import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.catalog import queries
from rankflow.operators import rank_sum_auc
from rankflow.plans import (
    DEFAULT_GRID,
    PASSENGER_FEATURES,
    FeatureSpec,
    classify,
    fit_cross_validated,
    index_features,
    index_label,
    prepare_passengers,
    submit_passengers,
)
from rankflow.operators.ordering import label_order, with_label_order
from rankflow.plans.classifier import DEFAULT_FOLDS, check_categories, fits_at_once, fold_table
from rankflow.sources import PASSENGER_SCHEMA, without_fields
from tests.conftest import TESTDATA

SMALL_GRID = {"maxBins": [25], "maxDepth": [2, 4], "impurity": ["gini"]}
TEST_SCHEMA = without_fields(PASSENGER_SCHEMA, ["Survived"])


def passengers(n, seed, labelled=True):
    """Women survive far more often than men."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        sex = rng.choice(["male", "female"])
        title = rng.choice(["Mr", "Dr", "Capt"] if sex == "male" else ["Mrs", "Miss", "Mlle"])
        row = [i + 1]
        if labelled:
            row.append(int(rng.random() < (0.9 if sex == "female" else 0.1)))
        row += [rng.randrange(1, 4), f"Name{i}, {title}. First", sex]
        row += [None if rng.random() < 0.2 else float(rng.randrange(1, 80)), rng.randrange(3), rng.randrange(3)]
        row += ["T1", None if rng.random() < 0.1 else float(rng.randrange(5, 90)), None, rng.choice(["S", "C", "Q", None])]
        rows.append(tuple(row))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    train = spark.createDataFrame(passengers(300, 1), PASSENGER_SCHEMA)
    test = spark.createDataFrame(passengers(80, 2, labelled=False), TEST_SCHEMA)
    return prepare_passengers(train, test)


def test_prepared_tables(tables):
    train, test = tables
    assert test.where(F.col("SurvivedString") != "0").count() == 0
    assert {r[0] for r in train.select("SurvivedString").distinct().collect()} == {"0", "1"}
    for df in tables:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()) for c in ("Age", "Fare", "Embarked", "Title", "FamilySize")])
        assert set(nulls.first()) == {0}
    assert train.schema["Age"].dataType == T.FloatType()


def test_features_and_label(tables):
    train, test = tables
    features = index_features(train, test, PASSENGER_FEATURES, 31)
    assert PASSENGER_FEATURES.inputs == [
        "Age", "SibSp", "Parch", "Fare", "FamilySize",
        "PclassIndexed", "SexIndexed", "EmbarkedIndexed", "TitleIndexed",
    ]
    vector = features.transform(test).first()
    assert list(vector.Features.toArray()) == pytest.approx([float(vector[c]) for c in PASSENGER_FEATURES.inputs])
    mostly_positive = train.where("SurvivedString = '1'").unionByName(train.limit(5))
    assert index_label(mostly_positive, PASSENGER_FEATURES).labels == ["0", "1"]


def test_grid_is_complete():
    sizes = [len(v) for v in DEFAULT_GRID.values()]
    assert sizes == [3, 3, 2] and DEFAULT_FOLDS == 10


def test_cross_validated_model(spark, tables):
    train, test = tables
    features = index_features(train, test, PASSENGER_FEATURES, 31)
    vectors = index_label(train, PASSENGER_FEATURES).transform(features.transform(train)).cache()
    model = fit_cross_validated(vectors, "SurvivedStringIndexed", "PassengerId", SMALL_GRID, folds=3)
    assert len(model.avgMetrics) == 2 and max(model.avgMetrics) > 0.8
    again = fit_cross_validated(vectors.repartition(5, "Age"), "SurvivedStringIndexed", "PassengerId", SMALL_GRID, folds=3)
    assert again.avgMetrics == pytest.approx(model.avgMetrics, abs=0.05)
    scored = model.transform(vectors)
    expected = BinaryClassificationEvaluator(labelCol="SurvivedStringIndexed", numBins=0).evaluate(scored)
    score = vector_to_array("rawPrediction")[1].alias("score")
    auc = rank_sum_auc(scored.select(score, "SurvivedStringIndexed"), "score", "SurvivedStringIndexed")
    assert auc.first().auc == pytest.approx(expected, abs=1e-9)


def test_predictions_follow_the_signal(tables):
    train, test = tables
    scored = classify(train, test, PASSENGER_FEATURES, SMALL_GRID, folds=3)
    agreeing = scored.where((F.col("Sex") == "female") == (F.col("predictedLabel") == "1")).count()
    assert scored.count() == 80 and agreeing > 70


def test_wide_categories_are_refused(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="c"):
        check_categories(df, ["c"], 31)
    spec = FeatureSpec("id", "label", (), ("c",))
    with pytest.raises(ValueError):
        index_features(df, df, spec, 31)


def test_submission(spark, tmp_path):
    train = spark.createDataFrame(passengers(200, 3), PASSENGER_SCHEMA)
    test = spark.createDataFrame(passengers(40, 4, labelled=False), TEST_SCHEMA)
    for name, df in (("train", train), ("test", test)):
        df.write.csv(str(tmp_path / name), header=True)
    out = str(tmp_path / "out")
    submit_passengers(spark, str(tmp_path / "train"), str(tmp_path / "test"), out, SMALL_GRID, 2)
    back = spark.read.csv(out, header=True)
    assert back.columns == ["PassengerId", "Survived"] and back.count() == 40
    assert {r[0] for r in back.select("Survived").distinct().collect()} == {"0", "1"}


def test_categories_in_the_order_of_their_labels(spark):
    rows = [("a", 1), ("a", 0), ("b", 1), ("c", 0), (None, 0), (None, 0), ("d", 1), ("e", 0), ("e", 1)]
    orders = label_order(spark.createDataFrame(rows, "c string, y int"), "c", "y")
    assert {(r.c, r.n, r.mean, r.order) for r in orders.collect()} == {
        ("a", 2, 0.5, 1), ("b", 1, 1.0, 2), ("c", 1, 0.0, 0), (None, 2, 0.0, 0), ("d", 1, 1.0, 2), ("e", 2, 0.5, 1),
    }
    new = spark.createDataFrame([("b", 1), ("zz", 2), (None, 3)], "c string, id int")
    placed = with_label_order(new, "c", orders.where("c IS NOT NULL"), "order")
    assert {(r.id, r.order) for r in placed.collect()} == {(1, 2.0), (2, -1.0), (3, -1.0)}


def test_wide_categories_reach_the_forest(spark):
    """Two thousand values, of which the label depends; no indexer sees them."""
    rows = [(i, str((i % 2000) % 3 // 2), float(i % 7), f"v{i % 2000}" if i % 2000 else None) for i in range(6000)]
    train = spark.createDataFrame(rows, "id int, label string, x double, c string")
    spec = FeatureSpec(id="id", label="label", numeric=("x",), categorical=(), wide=("c",))
    test = train.where("id < 2000").drop("label").unionByName(spark.createDataFrame([(9999, 0.0, "unseen")], "id int, x double, c string"))
    scored = classify(train, test, spec, {"maxBins": [32], "maxDepth": [3], "impurity": ["gini"]}, folds=2)
    got = {r.id: r.predictedLabel for r in scored.select("id", "predictedLabel").collect()}
    assert got == {i: label for i, label, _, _ in rows[:2000]} | {9999: "0"}


def test_folds_and_partitions_follow_the_rows(spark):
    data = spark.range(1000).select(F.col("id"), F.lit(1.0).alias("label"), F.lit(0.0).alias("Features"))
    tables = [fold_table(d, "label", "id", 5, rows_per_task=300) for d in (data, data.repartition(7))]
    assert [t.rdd.getNumPartitions() for t in tables] == [4, 4]
    first, second = ([r.fold for r in t.collect()] for t in tables)
    assert first == second and set(first) == set(range(5))


@pytest.mark.parametrize(("values", "grid", "fits"), [(25, [25], True), (30, [25, 31], False), (60, [31], False), (26, [25], False)])
def test_the_smallest_number_of_bins_limits_categories(spark, values, grid, fits):
    spec = FeatureSpec(id="id", label="label", numeric=("x",), categorical=("c",))
    rows = [(i, str(i % 2), float(i), None if i % values == 0 else f"v{i % values}") for i in range(4 * values)]
    train = spark.createDataFrame(rows, "id int, label string, x double, c string")
    options = {"maxBins": grid, "maxDepth": [2], "impurity": ["gini"]}
    if fits:
        assert classify(train, train, spec, options, folds=2).count() == len(rows)
    else:
        with pytest.raises(ValueError, match="too many distinct"):
            classify(train, train, spec, options, folds=2)


def test_forest_on_real_labels_searches_the_whole_grid(spark, monkeypatch):
    called = []

    def search(train, test, spec, grid=DEFAULT_GRID, folds=DEFAULT_FOLDS):
        called.append((grid, folds))
        return test.withColumn("predictedLabel", F.lit("1"))

    monkeypatch.setattr(queries, "classify", search)
    queries.rf_predict(spark, f"{TESTDATA}/sf0.001")
    assert called == [(DEFAULT_GRID, DEFAULT_FOLDS)]


def test_fits_share_the_cores(spark):
    """One fit at a time leaves its cores idle between its passes; ten partitions on twelve cores used to be searched so."""
    assert [fits_at_once(12, partitions) for partitions in (1, 4, 10, 58, 400)] == [12, 12, 5, 2, 2]
    assert fits_at_once(1, 1) == fits_at_once(1, 50) == 1


@pytest.mark.parametrize("categorical", [("c", "d"), ()])
def test_depths_share_a_fit(spark, monkeypatch, categorical):
    """The metrics of Spark's cross-validator to the last bit, with one fit a fold for all depths; it used to be one for each."""
    rng = random.Random(5)
    rows = [(i, str(int(rng.random() < (0.2 + 0.1 * (i % 7)))), rng.random(), i % 40, f"c{i % 7}", f"d{rng.randrange(20)}") for i in range(3000)]
    train = spark.createDataFrame(rows, "id int, label string, x double, y int, c string, d string")
    spec = FeatureSpec(id="id", label="label", numeric=("x", "y"), categorical=categorical)
    vectors = index_label(train, spec).transform(index_features(train, train, spec, 25).transform(train))
    grid = {"maxBins": [25], "maxDepth": [2, 7, 4], "impurity": ["entropy", "gini"]}
    forest = RandomForestClassifier(labelCol="labelIndexed", featuresCol="Features", seed=42)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(forest.getParam(name), values)
    evaluator = BinaryClassificationEvaluator(labelCol="labelIndexed", numBins=0)
    table = fold_table(vectors, "labelIndexed", "id", 3)
    search = CrossValidator(estimator=forest, estimatorParamMaps=builder.build(), evaluator=evaluator, numFolds=3, foldCol="fold", parallelism=8)
    expected = search._to_java().fit(table._jdf)
    fit, grown = RandomForestClassifier.fit, []
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, *args: grown.append((self.getMaxDepth(), self.getCacheNodeIds())) or fit(self, *args))
    found = fit_cross_validated(vectors, "labelIndexed", "id", grid, folds=3)
    assert found.avgMetrics == list(expected.avgMetrics()) and len(set(found.avgMetrics)) > 3
    cached = bool(categorical)  # walking down splits of categories is slow
    assert grown == [(7, cached)] * 6 + [(found.best_point["maxDepth"], cached)]
    trees = [m.toDebugString().split("\n", 1)[1] for m in (found.best._java_obj, expected.bestModel())]
    assert trees[0] == trees[1]


def test_a_search_needs_two_folds(spark):
    data = spark.createDataFrame([(1, 1.0)], "id int, label double").select("*", F.lit(0.0).alias("Features"))
    with pytest.raises(ValueError, match="two folds"):
        fit_cross_validated(data, "label", "id", SMALL_GRID, folds=3)
