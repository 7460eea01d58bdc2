"""Binary classification of tabular rows with a cross-validated random forest."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.columns import with_default
from rankflow.functions.titles import family_size, passenger_title
from rankflow.operators.aggregates import impute_joint_mean
from rankflow.operators.ordering import label_order, with_label_order
from rankflow.sources.audit import read_clean
from rankflow.sources.schemas import PASSENGER_SCHEMA, without_fields
from rankflow.sources.sinks import write_csv
from rankflow.sources.workspace import new_folder, remove_folder

SEED = 42

# The search grid and the number of folds.
DEFAULT_GRID = {
    "maxBins": [25, 28, 31],
    "maxDepth": [4, 6, 8],
    "impurity": ["entropy", "gini"],
}
DEFAULT_FOLDS = 10

#: Rows of a partition while forests are grown; a fit of fewer rows is one task at a time.
ROWS_PER_TASK = 50_000

#: Tasks that wait for each core while forests are grown: between two passes a fit leaves its cores to others.
TASKS_PER_CORE = 4

#: Values of a label beyond which an indexer is not fitted.
MAX_CLASSES = 100


@dataclass(frozen=True)
class FeatureSpec:
    """Roles of columns. ``label`` is a string column, known for training rows only."""

    id: str
    label: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    #: Categories with more values than a tree can bin: ordered by the mean label of the training rows.
    wide: tuple[str, ...] = ()

    @property
    def label_index(self) -> str:
        return self.label + "Indexed"

    @property
    def inputs(self) -> list[str]:
        return [*self.numeric, *[c + "Indexed" for c in self.categorical], *[c + "Order" for c in self.wide]]


# The feature columns in the order of the vector, and the port that stands in
# for a missing one.
PASSENGER_FEATURES = FeatureSpec(
    id="PassengerId",
    label="SurvivedString",
    numeric=("Age", "SibSp", "Parch", "Fare", "FamilySize"),
    categorical=("Pclass", "Sex", "Embarked", "Title"),
)
DEFAULT_PORT = "S"


def prepare_passengers(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Derived features, label as text, and missing values filled from both tables together."""

    def extend(df: DataFrame, label) -> DataFrame:
        return df.withColumns(
            {
                "FamilySize": family_size("SibSp", "Parch"),
                "Title": passenger_title("Name", "Sex"),
                "Embarked": with_default("Embarked", DEFAULT_PORT),
                PASSENGER_FEATURES.label: label,
            }
        )

    train = extend(train, F.col("Survived").cast("string"))
    test = extend(test, F.lit("0"))
    train, test = impute_joint_mean([train, test], ["Age", "Fare"])
    return train, test


def check_categories(df: DataFrame, columns: Sequence[str], limit: int) -> None:
    """Refuse columns with more values than a tree can bin, before an indexer collects them."""
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()
    # The estimate is off by a few percent: a clear excess needs no exact count, and what is
    # left has few values.
    wide = [c for c, n in counts.items() if n > 2 * limit]
    if not wide:
        exact = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first().asDict()
        wide = [c for c, n in exact.items() if n > limit]
    if wide:
        raise ValueError(f"too many distinct values for a limit (maxBins or classes) of {limit}: {wide}")


def index_features(train: DataFrame, test: DataFrame, spec: FeatureSpec, max_bins: int) -> PipelineModel:
    """Fitted category indexers and vector assembly.

    Categories are counted over both tables, most frequent first, so the rows to score hold no
    unseen value. Missing ones must have been named before (``name_missing``): no bin is kept for them.
    ``max_bins`` is the smallest number of bins that any forest of a search may have.
    """
    columns = list(spec.categorical)
    vector = VectorAssembler(inputCols=spec.inputs, outputCol="Features")
    if not columns:
        return PipelineModel(stages=[vector])
    both = train.select(*columns).unionByName(test.select(*columns))
    check_categories(both, columns, max_bins)
    categories = StringIndexer(
        inputCols=columns,
        outputCols=[c + "Indexed" for c in columns],
        stringOrderType="frequencyDesc",
        handleInvalid="error",
    ).fit(both)
    return PipelineModel(
        stages=[categories, vector]
    )


def name_missing(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Categories as text, a missing one as the empty text."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*spec.categorical, *spec.wide)})


def index_label(train: DataFrame, spec: FeatureSpec) -> StringIndexerModel:
    """Indexed from the training rows alone and in alphabetical order, so class "1" stays the
    positive one however frequent it is. The indexer collects the classes, so their number is checked first."""
    check_categories(train, [spec.label], MAX_CLASSES)
    return StringIndexer(
        inputCol=spec.label, outputCol=spec.label_index, stringOrderType="alphabetAsc"
    ).fit(train)


@dataclass(frozen=True)
class GridSearch:
    """What a search found: the mean metric of each point of the grid, and the forest grown with the best one on all rows."""

    points: list[dict]
    avgMetrics: list[float]
    best: RandomForestClassificationModel

    @property
    def best_point(self) -> dict:
        return self.points[self.avgMetrics.index(max(self.avgMetrics))]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.best.transform(df)


def fold_table(data: DataFrame, label_col: str, fold_of: str, folds: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """label, Features, fold of all rows, in partitions of about ``rows_per_task``.

    The fold is a hash of ``fold_of``, and so are partition and place in it: a row keeps them when a lost task runs again.
    """
    mark = F.xxhash64(fold_of)
    parts = max(1, -(-data.count() // rows_per_task))
    rows = data.select(label_col, "Features", F.pmod(mark, F.lit(folds)).cast("int").alias("fold"), mark.alias("_mark"))
    return rows.repartition(parts, "_mark").sortWithinPartitions("_mark").drop("_mark")


def fits_at_once(cores: int, partitions: int) -> int:
    """Fits that together have ``TASKS_PER_CORE`` tasks for each core, at most one a core.

    There are at least two, so that one works while the other waits for the driver; a fit keeps its rows with the weights of all trees,
    so of large tables no more than two are held.
    """
    return max(min(2, cores), min(cores, -(-TASKS_PER_CORE * cores // partitions)))


def has_categories(data: DataFrame) -> bool:
    """Whether some of ``Features`` are categories, by what the indexers and the assembler noted with the column."""
    return "nominal" in data.schema["Features"].metadata.get("ml_attr", {}).get("attrs", {})


def forest_nodes(model: RandomForestClassificationModel, spark: SparkSession) -> list[dict[int, Row]]:
    """The nodes of each tree by number, as Spark saves them. A grid bounds their number."""
    path = new_folder(spark, "forest")
    try:
        model.write().save(path)
        trees = [{} for _ in range(model.getNumTrees)]
        for tree, node in spark.read.parquet(path + "/data").select("treeID", "nodeData").collect():
            trees[tree][node.id] = node
    finally:
        remove_folder(spark, path)
    return trees


def shares_at_depth(nodes: Mapping[int, Row], depth: int) -> list[float]:
    """For each leaf of a tree, from left to right: the share of class 1 in the leaf of the same tree grown to ``depth`` only.

    Trees grow level by level, so the shallower one is the top of the deeper one. Two leaves of one prediction are one there, as in Spark's trees.
    """

    def share(node: Row) -> float:
        total = sum(node.impurityStats)
        return node.impurityStats[1] / total if total else 0.0

    def cut(number: int, level: int) -> tuple[float | None, list[float]]:
        node = nodes[number]
        if node.leftChild < 0:
            return node.prediction, [share(node)]
        (left, lefts), (right, rights) = cut(node.leftChild, level + 1), cut(node.rightChild, level + 1)
        if level >= depth:
            return node.prediction, [share(node)] * len(lefts + rights)
        if left is not None and left == right:
            return left, [share(node)] * len(lefts + rights)
        return None, lefts + rights

    return cut(0, 0)[1]


def score_at_depth(trees: Sequence[Mapping[int, Row]], depth: int) -> Column:
    """Class 1 of the raw prediction of a forest grown to ``depth``, from the column ``leaf`` of the deeper one; summed tree by tree as Spark does."""
    shares = F.from_json(F.lit(json.dumps([shares_at_depth(nodes, depth) for nodes in trees])), "array<array<double>>")
    found = F.zip_with(vector_to_array("leaf"), shares, lambda leaf, tree: F.get(tree, leaf.cast("int")))
    return F.aggregate(found, F.lit(0.0), lambda total, x: total + x)


def metrics_by_depth(
    forest: RandomForestClassifier, train: DataFrame, valid: DataFrame, depths: Sequence[int]
) -> dict[int, float]:
    """Area under ROC on ``valid`` for forests of each depth. Only the deepest is grown; the others are its upper levels."""
    label = forest.getLabelCol()
    deepest = max(depths)
    model = forest.copy({forest.maxDepth: deepest}).fit(train)
    metrics = {deepest: BinaryClassificationEvaluator(labelCol=label, numBins=0).evaluate(model.transform(valid))}
    reached = max(tree.depth for tree in model.trees)
    metrics |= {depth: metrics[deepest] for depth in depths if depth >= reached}  # the same forest
    upper = set(depths) - metrics.keys()
    if upper:
        trees = forest_nodes(model, train.sparkSession)
        leaves = model.setLeafCol("leaf").transform(valid)
        evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="score", numBins=0)
        for depth in upper:
            metrics[depth] = evaluator.evaluate(leaves.select(label, score_at_depth(trees, depth).alias("score")))
    return metrics


def fit_cross_validated(
    data: DataFrame,
    label_col: str,
    fold_of: str,
    grid: Mapping[str, Sequence] = DEFAULT_GRID,
    folds: int = DEFAULT_FOLDS,
    parallelism: int | None = None,
) -> GridSearch:
    """Forest with the best mean area under ROC over the folds (the first of equal ones), refitted on all rows.

    One kept table serves all fits, of which ``fits_at_once`` run side by side. Points that differ in depth alone share one fit a fold
    (``metrics_by_depth``). With categories, trees remember where a row stands, as to walk down their splits takes longer. Folds without rows are left out.
    """
    forest = RandomForestClassifier(labelCol=label_col, featuresCol="Features", seed=SEED, cacheNodeIds=has_categories(data))
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(forest.getParam(name), list(values))
    points = [{p.name: v for p, v in point.items()} for point in builder.build()]
    depth_of = [point.get("maxDepth", forest.getMaxDepth()) for point in points]
    others = [tuple((n, v) for n, v in point.items() if n != "maxDepth") for point in points]
    depths: dict[tuple, list[int]] = {}
    for other, depth in zip(others, depth_of, strict=True):
        depths.setdefault(other, []).append(depth)
    rows = fold_table(data, label_col, fold_of, folds).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        used = [r.fold for r in rows.select("fold").distinct().orderBy("fold").collect()]  # at most ``folds``
        if len(used) < 2:
            raise ValueError("a search needs rows in at least two folds")

        def search(task: tuple[int, tuple]) -> dict[int, float]:
            fold, other = task
            apart = forest.copy({forest.getParam(n): v for n, v in other})
            return metrics_by_depth(apart, rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold), depths[other])

        tasks = [(fold, other) for fold in used for other in depths]
        spark = rows.sparkSession
        at_once = parallelism or fits_at_once(spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
        with ThreadPoolExecutor(at_once) as pool:
            found = dict(zip(tasks, pool.map(inheritable_thread_target(spark)(search), tasks), strict=True))
        means = [sum(found[fold, other][depth] for fold in used) / len(used) for other, depth in zip(others, depth_of, strict=True)]
        best = points[means.index(max(means))]
        model = forest.copy({forest.getParam(n): v for n, v in best.items()}).fit(rows)
    finally:
        rows.unpersist()
    return GridSearch(points, means, model)


def classify(
    train: DataFrame,
    test: DataFrame,
    spec: FeatureSpec,
    grid: Mapping[str, Sequence] = DEFAULT_GRID,
    folds: int = DEFAULT_FOLDS,
) -> DataFrame:
    """``test`` with its feature columns indexed and ``predictedLabel`` added.

    Wide categories need a label of two classes; they are numbered in a table and joined, so any number of values will do.
    """
    train, test = name_missing(train, spec), name_missing(test, spec)
    label = index_label(train, spec)
    train = label.transform(train)
    for column in spec.wide:
        orders = label_order(train, column, spec.label_index, column + "Order")
        train, test = (with_label_order(df, column, orders, column + "Order") for df in (train, test))
    features = index_features(train, test, spec, min(grid.get("maxBins", [32])))
    vectors = features.transform(train).select(spec.id, spec.label_index, "Features")
    model = fit_cross_validated(vectors, spec.label_index, spec.id, grid, folds)
    names = IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=label.labels)
    return names.transform(model.transform(features.transform(test)))


def classify_passengers(
    train: DataFrame,
    test: DataFrame,
    grid: Mapping[str, Sequence] = DEFAULT_GRID,
    folds: int = DEFAULT_FOLDS,
) -> DataFrame:
    """``PassengerId, Survived`` for the rows of ``test``."""
    train, test = prepare_passengers(train, test)
    scored = classify(train, test, PASSENGER_FEATURES, grid, folds)
    return scored.select("PassengerId", F.col("predictedLabel").alias("Survived"))


def submit_passengers(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    out: str,
    grid: Mapping[str, Sequence] = DEFAULT_GRID,
    folds: int = DEFAULT_FOLDS,
) -> None:
    """CSV files in, CSV files out; both are checked while they are read."""
    unlabelled = without_fields(PASSENGER_SCHEMA, ["Survived"])
    train = read_clean(spark, train_path, PASSENGER_SCHEMA)
    test = read_clean(spark, test_path, unlabelled)
    write_csv(classify_passengers(train, test, grid, folds), out)
