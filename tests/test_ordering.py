import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from rankflow.operators import category_index, rank_sum_auc, running_total


def test_running_total(spark):
    rng = random.Random(11)
    rows = [(i, rng.randrange(-5, 9)) for i in rng.sample(range(100000), 3000)]
    df = spark.createDataFrame(rows, "k int, v int")
    expected, total = {}, 0
    for k, v in sorted(rows, reverse=True):
        expected[k] = total
        total += v
    result = running_total(df, [F.desc("k")], "v")
    assert result.columns == ["k", "v", "before"]
    assert {r.k: r.before for r in result.collect()} == expected


def test_running_total_uses_many_partitions(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(5000).withColumn("one", F.lit(1))
    result = running_total(df, [F.asc("id")], "one")
    assert result.where(F.col("id") != F.col("before")).count() == 0
    assert result.select(F.spark_partition_id()).distinct().count() > 1


def test_category_index_equals_the_ml_indexer(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.choice("aabbbcdeffffg"),) for _ in range(200)] + [("zz",), ("za",)], "c string")
    model = StringIndexer(inputCol="c", outputCol="i", stringOrderType="frequencyDesc").fit(df)
    numbered = dict(map(tuple, category_index(df, "c").collect()))
    assert numbered == {label: i for i, label in enumerate(model.labels)}


@pytest.mark.parametrize("distinct", [3, 50, 100000])
def test_auc_equals_the_evaluator(spark, distinct):
    rng = random.Random(distinct)
    rows = [(float(rng.randrange(distinct)), rng.random() < 0.3) for _ in range(2000)]
    df = spark.createDataFrame(rows, "score double, y boolean").select("score", F.col("y").cast("int").alias("y"))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0)
    expected = evaluator.evaluate(df.withColumn("y", F.col("y").cast("double")))
    assert rank_sum_auc(df, "score", "y").first().auc == pytest.approx(expected, abs=1e-12)


def test_auc_of_one_class(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "score double, y int")
    assert rank_sum_auc(df, "score", "y").first().auc is None
