"""One query per operator group. Each takes the session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.catalog import roles
from rankflow.catalog.roles import ID, ITEM, table
from rankflow.functions.arrays import distinct_items, join_items, parse_int_list
from rankflow.functions.columns import suffix_columns, with_default
from rankflow.functions.metrics import average_precision
from rankflow.functions.titles import family_size as family_size_column
from rankflow.functions.titles import regex_lookup
from rankflow.operators.aggregates import impute_joint_mean, joint_means, last_write_wins
from rankflow.operators.cascade import (
    fill_remainder,
    ids_without_match,
    match_rule,
    match_rules,
    ordered_lists as lists_of,
    rank_step,
    rerank_matched,
    union_rerank as rerank_union,
    unmatched_ids as ids_outside,
)
from rankflow.operators.ordering import category_index as number_categories, label_order as order_by_label, rank_sum_auc
from rankflow.operators.pairs import clean_item_info
from rankflow.operators.topk import (
    Rule,
    candidates,
    global_list,
    popular_items,
    popularity,
    rule_candidates as candidates_of_rules,
)
from rankflow.plans.classifier import FeatureSpec, check_categories, classify, submit_passengers
from rankflow.plans.duplicates import pair_features, pair_features_from_files
from rankflow.plans.evaluation import map_at_k, score_list_files
from rankflow.plans.recommender import recommend, submit_hotels
from rankflow.sources.audit import audit_csv, split_faulty
from rankflow.sources.readers import (
    read_by_name,
    read_declared,
    inferred_types,
    read_inferred,
    read_lines,
    read_list_file,
    read_quoted,
)
from rankflow.sources.schemas import append_field, interaction_schema, prepend_field, without_fields
from rankflow.sources.sinks import head_sample as stored_head, write_csv, write_parquet
from rankflow.sources.workspace import new_folder, stored, tidy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Added to ids that go through list files, so that they need 64 bits.
BEYOND_INT = 3_000_000_000


def _register(query: Query) -> Query:
    QUERIES[query.__name__] = tidy(query)
    return query


# --- rankings --------------------------------------------------------------------------------


@_register
def weighted_popularity(spark, sf_dir):
    weights = roles.item_weights(spark, sf_dir, roles.popular_weight())
    return popularity(weights, ITEM, F.col("weight"))


@_register
def global_top5(spark, sf_dir):
    weights = roles.item_weights(spark, sf_dir, roles.popular_weight())
    return popular_items(weights, ITEM, F.col("weight"))


@_register
def topk_exact_key(spark, sf_dir):
    return candidates(roles.interactions(spark, sf_dir), roles.rules()[0], ITEM)


@_register
def topk_year_rule(spark, sf_dir):
    return candidates(roles.interactions(spark, sf_dir), roles.rules()[1], ITEM)


@_register
def topk_single_key(spark, sf_dir):
    return candidates(roles.interactions(spark, sf_dir), roles.rules()[2], ITEM)


@_register
def rule_candidates(spark, sf_dir):
    """All three rankings from one scan."""
    return candidates_of_rules(roles.training(spark, sf_dir), roles.rules(), ITEM)


# --- cascade ---------------------------------------------------------------------------------


def _rule_hits(spark, sf_dir, number):
    rule = roles.rules()[number - 1]
    train, requests = roles.training_and_requests(spark, sf_dir)
    factor = rank_step(5) ** (number - 1)
    return match_rule(requests, candidates(train, rule, ITEM), rule.keys, ID, ITEM, factor)


def _matched(spark, sf_dir):
    """Matches of all rules, and the global list, from one ranking of the training rows.

    The global list is rule 0. Requests without any match keep a row without a rank.
    """
    train, requests = roles.training_and_requests(spark, sf_dir)
    ranked = candidates_of_rules(train, [Rule((), roles.popular_weight()), *roles.rules()], ITEM, first_number=0)
    return match_rules(requests, ranked, roles.rules(), ID, ITEM), global_list(ranked, ITEM)


def _reranked(spark, sf_dir):
    matched, top_items = _matched(spark, sf_dir)
    return rerank_matched(matched, ID, ITEM, top_items), top_items


@_register
def join_rule1(spark, sf_dir):
    return _rule_hits(spark, sf_dir, 1)


@_register
def join_rule2(spark, sf_dir):
    return _rule_hits(spark, sf_dir, 2)


@_register
def join_rule3(spark, sf_dir):
    return _rule_hits(spark, sf_dir, 3)


@_register
def unmatched_ids(spark, sf_dir):
    return ids_without_match(_matched(spark, sf_dir)[0], ID)


@_register
def ids_in_no_part(spark, sf_dir):
    """A set difference over tables of their own: documents without a label and without a page of their number."""
    labels, pages = (table(spark, sf_dir, n) for n in ("labels", "pages"))
    return ids_outside(table(spark, sf_dir, "documents"), "doc_id", labels, pages.select(F.col("page_id").alias("doc_id")))


@_register
def rerank_parts(spark, sf_dir):
    """The matches of each rule by itself, united and numbered again."""
    parts = [_rule_hits(spark, sf_dir, number).withColumn("rn", F.col("rn").cast("bigint")) for number in (1, 2, 3)]
    return rerank_union(parts, ID, ITEM)


@_register
def remainder_fill(spark, sf_dir):
    matched, top_items = _matched(spark, sf_dir)
    return fill_remainder(ids_without_match(matched, ID), ID, ITEM, top_items)


@_register
def union_rerank(spark, sf_dir):
    return _reranked(spark, sf_dir)[0]


@_register
def ordered_lists(spark, sf_dir):
    """The lists built step by step, one operator after the other."""
    ranked, top_items = _reranked(spark, sf_dir)
    lists = lists_of(ranked, ID, ITEM, top_items)
    return lists.select(ID, join_items(ITEM).alias("items")).orderBy(ID)


def _recommended(spark, sf_dir, dedupe=False):
    train, requests = roles.training_and_requests(spark, sf_dir)
    weight = roles.popular_weight()
    return recommend(train, requests, roles.rules(), weight, id_col=ID, item=ITEM, dedupe=dedupe)


@_register
def cascade_recommend(spark, sf_dir):
    """Flagship: the same lists as ``ordered_lists`` from one pass and one join."""
    return _recommended(spark, sf_dir).select(ID, join_items(ITEM).alias("items"))


@_register
def cascade_distinct(spark, sf_dir):
    """The flagship with no item repeated within a list."""
    return _recommended(spark, sf_dir, dedupe=True).select(ID, join_items(ITEM).alias("items"))


def _without_low_items(train):
    """Training rows whose items up to 5 are unknown."""
    return train.withColumn(ITEM, F.when(F.col(ITEM) > 5, F.col(ITEM)))


@_register
def topk_null_items(spark, sf_dir):
    return candidates(_without_low_items(roles.interactions(spark, sf_dir)), roles.rules()[2], ITEM)


@_register
def cascade_null_items(spark, sf_dir):
    """Rows without an item recommend nothing, and every list still has five items."""
    train, requests = roles.training_and_requests(spark, sf_dir)
    rules, weight = roles.rules(), roles.popular_weight()
    lists = recommend(_without_low_items(train), requests, rules, weight, id_col=ID, item=ITEM)
    return lists.select(ID, join_items(ITEM).alias("items"))


@_register
def hotel_files(spark, sf_dir):
    """The hotel flow from CSV to CSV, on the supplied tables in its layout; 1996 is moved to the year of its second rule."""
    train, requests = roles.training_and_requests(spark, sf_dir)
    empty = {f.name: F.lit(None).cast(f.dataType) for f in interaction_schema(False).fields}

    def layout(df, **more):
        columns = empty | {
            "date_time": F.col("order_date") + F.expr("INTERVAL 18 YEARS"),
            "user_id": F.col("user"),
            "user_location_city": F.col("city"),
            "orig_destination_distance": F.col("distance_key") / 100000,
            "srch_destination_id": F.col("dest"),
            "hotel_country": F.substring("country", 1, 1),
            "hotel_market": F.ascii("market"),
        }
        return df.select(*[c.alias(n) for n, c in (columns | more).items() if c is not None])

    train_path, test_path, out = (new_folder(spark, n) for n in ("hotel-train", "hotel-test", "hotel-out"))
    write_csv(layout(train, id=None, is_booking=F.col("is_booking"), cnt=F.lit(1), hotel_cluster=F.col(ITEM)), train_path)
    write_csv(layout(requests, id=F.col(ID), is_booking=None, cnt=None), test_path)
    submit_hotels(spark, train_path, test_path, out)
    result = T.StructType([T.StructField(ID, T.LongType()), T.StructField("hotel_cluster", T.StringType())])
    return read_by_name(spark, out, result)


# --- pairs -----------------------------------------------------------------------------------


@_register
def suffix_rename(spark, sf_dir):
    return suffix_columns(table(spark, sf_dir, "supplier"), "_1")


@_register
def text_lengths(spark, sf_dir):
    return clean_item_info(table(spark, sf_dir, "documents"), ["lang", "source"], ["text"])


@_register
def page_lengths(spark, sf_dir):
    return clean_item_info(table(spark, sf_dir, "pages"), [], ["url", "html"])


@_register
def pair_enrich(spark, sf_dir):
    """Every customer with the next one, both with their nation's region."""
    customer = table(spark, sf_dir, "customer")
    pairs = customer.select(
        F.col("c_custkey").alias("itemID_1"), (F.col("c_custkey") + 1).alias("itemID_2")
    )
    info = customer.select(
        F.col("c_custkey").alias("itemID"),
        F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("description"),
        F.col("c_name").alias("images_array"),
        F.col("c_name").alias("attrsJSON"),
        F.col("c_acctbal").alias("price"),
        F.col("c_nationkey").alias("locationID"),
    )
    location = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("locationID"), F.col("n_regionkey").alias("regionID")
    )
    return pair_features(pairs, info, location)


@_register
def pair_files(spark, sf_dir):
    """The pair flow from CSV files: every customer with the next one."""
    customer = table(spark, sf_dir, "customer")
    pairs = customer.select(F.col("c_custkey").alias("itemID_1"), (F.col("c_custkey") + 1).alias("itemID_2"))
    info = customer.select(
        F.col("c_custkey").alias("itemID"),
        F.concat(F.lit('"'), "c_name", F.lit('", ""')).alias("title"),
        F.col("c_mktsegment").alias("description"),
        F.col("c_name").alias("images_array"),
        F.lit("{}").alias("attrsJSON"),
        F.col("c_acctbal").alias("price"),
        F.col("c_nationkey").alias("locationID"),
    )
    nation = table(spark, sf_dir, "nation")
    location = nation.select(F.col("n_nationkey").alias("locationID"), F.col("n_regionkey").alias("regionID"))
    paths = []
    for name, rows in (("pairs", pairs), ("info", info), ("location", location)):
        paths.append(new_folder(spark, name))
        write_csv(rows, paths[-1])
    found = pair_features_from_files(spark, *paths)
    return found.select(F.col("itemID_1").cast("bigint"), F.col("itemID_2").cast("bigint"), "title_1", "title_2", "price_1", "price_2", "regionID_1", "regionID_2")


# --- tabular features ------------------------------------------------------------------------


@_register
def joint_mean(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("nationkey")
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey")
    )
    means = joint_means([customer, supplier], ["acctbal", "nationkey"])
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


@_register
def impute_mean(spark, sf_dir):
    """Orders without lines have no average quantity; they get the mean of all orders."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    averages = lines.agg(F.avg("l_quantity").alias("quantity"), F.avg("l_tax").alias("tax"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("order_date"))
    side = F.when(roles.before_split(), "train").otherwise("test")
    measured = stored(orders.withColumn("side", side).join(averages, "o_orderkey", "left"), "measured")
    (filled,) = impute_joint_mean([measured], ["quantity", "tax"])
    return filled.select(
        "o_orderkey", "side", F.round("quantity", 6).alias("quantity"), F.round("tax", 6).alias("tax")
    )


@_register
def default_string(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    code = F.regexp_extract("o_orderpriority", "^[123]-(.*)$", 1)
    return orders.select("o_orderkey", with_default(code, "S").alias("code"))


@_register
def regex_title_map(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    title = regex_lookup(
        F.col("o_orderpriority"),
        r"^[1-4]-(.*)$",
        {"URGENT": "Fast", "HIGH": "Fast", "MEDIUM": "Normal"},
        unmapped=F.when(F.col("o_orderstatus") == "F", "Closed").otherwise("Open"),
        unmatched=F.lit("Slow"),
    )
    return orders.select("o_orderkey", title.alias("title"))


@_register
def family_size(spark, sf_dir):
    size = family_size_column("l_linenumber", F.col("l_quantity").cast("int"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", size.alias("family_size"))


@_register
def label_cast(spark, sf_dir):
    """Label as text: the known one, or a constant for documents to be scored."""
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels")
    known = labels.select("doc_id", F.col("quality").cast("string").alias("label"))
    unknown = documents.join(labels, "doc_id", "left_anti").select("doc_id", F.lit("0").alias("label"))
    return known.unionByName(unknown).select("*", F.col("label").alias("label_copy"))


# --- lists and metrics -----------------------------------------------------------------------


def _user_lists(spark, sf_dir):
    """Per customer: the items ranked by count, then again by weight; and the items bought later.

    Lists hold ``k`` items per ranking, or the distinct items of a customer.
    """
    early = roles.before_split()
    lines = roles.interactions(spark, sf_dir)
    per_item = lines.groupBy("user", ITEM).agg(
        F.count_if(early).alias("n"),
        F.sum(F.when(early, roles.popular_weight()).otherwise(0)).alias("weight"),
        F.count_if(~early).alias("later"),
    )
    # the items of a customer are at most all items, summed up before they meet
    place = {c: F.row_number().over(Window.partitionBy("user").orderBy(F.desc(c), F.asc(ITEM))) for c in ("n", "weight")}
    ranked = per_item.select("user", ITEM, "n", "later", place["n"].alias("first"), place["weight"].alias("second"))

    def best(column: str) -> Column:
        chosen = F.when((F.col("n") > 0) & (F.col(column) <= 5), F.struct(column, ITEM))
        return F.transform(F.array_sort(F.collect_list(chosen)), lambda p: p[ITEM])

    lists = ranked.groupBy("user").agg(
        best("first").alias("by_count"),
        best("second").alias("by_weight"),
        F.array_sort(F.collect_list(F.when(F.col("later") > 0, F.col(ITEM)))).alias("actual"),
    )

    def found(items: Column) -> Column:
        return F.when(F.size(items) > 0, items)

    return lists.select(
        "user",
        found(F.concat("by_count", "by_weight")).alias("predicted"),
        found(F.col("by_count")).alias("by_count"),
        found(F.col("actual")).alias("actual"),
    )


@_register
def ap_at_k(spark, sf_dir):
    ap = average_precision(F.col("predicted"), F.col("actual"), k=5, empty_value=1.0)
    return _user_lists(spark, sf_dir).select("user", F.round(ap, 9).alias("ap"))


@_register
def ap_repeats(spark, sf_dir):
    """A cut-off beyond the first ranking, so that repeated items count again."""
    ap = average_precision(F.col("predicted"), F.col("actual"), k=8, empty_value=1.0)
    return _user_lists(spark, sf_dir).select("user", F.round(ap, 9).alias("ap"))


@_register
def ap_full(spark, sf_dir):
    ap = average_precision(F.col("predicted"), F.col("actual"), dedupe=True)
    return _user_lists(spark, sf_dir).select("user", F.round(ap, 9).alias("ap"))


@_register
def map_at_5(spark, sf_dir):
    """The flagship's lists against the item of each request's dearest line."""
    lines = roles.lines_with_items(spark, sf_dir)
    dearest = lines.groupBy(ID).agg(
        F.max_by(ITEM, F.struct("l_extendedprice", ITEM)).alias("actual")
    )
    score = map_at_k(_recommended(spark, sf_dir), dearest, ID, ITEM, "actual")
    return score.select(F.round("map", 9).alias("map"))


@_register
def map_file(spark, sf_dir):
    """Predictions and truth by way of list files; customers' later items replace earlier ones."""
    lists = stored(_user_lists(spark, sf_dir), "user-lists")
    predicted = lists.where(F.col("predicted").isNotNull())
    versions = F.array(
        F.struct(F.lit(0).alias("version"), F.array_sort("by_count").alias("found")),
        F.struct(F.lit(1).alias("version"), F.col("actual").alias("found")),
    )
    truth = lists.select("user", F.inline(versions)).where(F.col("found").isNotNull())
    in_order = truth.repartitionByRange("user", "version").sortWithinPartitions("user", "version")
    predicted_path, truth_path = new_folder(spark, "predicted"), new_folder(spark, "truth")
    number = (F.col("user") + BEYOND_INT).alias("user")
    write_csv(predicted.select(number, join_items("predicted")), predicted_path, header=False)
    write_csv(in_order.select(number, join_items("found")), truth_path, header=False)
    score = score_list_files(spark, predicted_path, truth_path)
    return score.select(F.round("map", 9).alias("map"))


@_register
def list_parse(spark, sf_dir):
    """Items of each order as a list file with repeats, read back and reduced to distinct ones."""
    lines = roles.lines_with_items(spark, sf_dir)
    items = lines.groupBy(ID).agg(F.array_sort(F.collect_set(ITEM)).alias("items"))
    path = new_folder(spark, "lists")
    repeated = F.concat("items", F.reverse("items"))
    write_csv(items.select((F.col(ID) + BEYOND_INT).alias(ID), join_items(repeated)), path, header=False)
    parsed = read_list_file(spark, path).withColumn("parsed", parse_int_list("items"))
    return parsed.select(
        ID,
        F.size("parsed").alias("n_items"),
        join_items(distinct_items("parsed")).alias("distinct_items"),
    )


@_register
def last_order(spark, sf_dir):
    """Each customer's last order: the latest date, then the highest number."""
    orders = table(spark, sf_dir, "orders")
    seq = F.struct("o_orderdate", "o_orderkey")
    return last_write_wins(orders, "o_custkey", ["o_orderkey", "o_orderpriority"], seq)


# --- learning --------------------------------------------------------------------------------


@_register
def string_index(spark, sf_dir):
    """Category numbers as the fitted ML stage assigns them."""
    documents = table(spark, sf_dir, "documents").select("source")
    check_categories(documents, ["source"], 1000)
    model = StringIndexer(inputCol="source", outputCol="index", stringOrderType="frequencyDesc").fit(documents)
    return model.transform(documents).distinct().select("source", F.col("index").cast("bigint").alias("index"))


@_register
def category_index(spark, sf_dir):
    """The same numbering as a distributed table."""
    return number_categories(table(spark, sf_dir, "part"), "p_name")


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")


@_register
def auc_ranksum(spark, sf_dir):
    auc = rank_sum_auc(_labelled(spark, sf_dir).select("n_chars", "quality"), "n_chars", "quality")
    return auc.select(F.round("auc", 9).alias("auc"))


@_register
def rf_predict(spark, sf_dir):
    """A forest grown from the labelled documents labels the others. Whole grid and folds."""
    spec = FeatureSpec(id="doc_id", label="label", numeric=("n_chars",), categorical=("lang", "source"))
    columns = ["doc_id", "n_chars", "lang", "source"]
    train = _labelled(spark, sf_dir).select(*columns, F.col("quality").cast("string").alias("label"))
    labels = table(spark, sf_dir, "labels")
    test = table(spark, sf_dir, "documents").select(*columns).join(labels, "doc_id", "left_anti")
    scored = classify(train, test, spec)
    return scored.select("doc_id", F.col("predictedLabel").alias("quality"))


@_register
def forest_rule(spark, sf_dir):
    """Labels that follow from one category: the forest has to find them. Whole grid and folds, by way of a file."""
    spec = FeatureSpec(id="doc_id", label="label", numeric=("n_chars",), categorical=("lang",))
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    label = F.when(F.col("lang").isin("en", "de"), "1").otherwise("0").alias("label")
    labels = table(spark, sf_dir, "labels")
    train = documents.join(labels, "doc_id", "left_semi").select("*", label)
    scored = classify(train, documents.join(labels, "doc_id", "left_anti"), spec)
    path = new_folder(spark, "submission")
    write_csv(scored.select("doc_id", F.col("predictedLabel").alias("quality")), path, order_by=["doc_id"])
    schema = T.StructType([T.StructField("doc_id", T.LongType(), False), T.StructField("quality", T.StringType())])
    return read_by_name(spark, path, schema)


@_register
def label_order(spark, sf_dir):
    """Names of parts by the share of their lines that came back."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("back"))
    named = lines.join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey")
    return order_by_label(named, "p_name", "back")


@_register
def wide_forest(spark, sf_dir):
    """A label that only the customer's number tells, a category with thousands of values. Whole grid and folds."""
    spec = FeatureSpec(id="o_orderkey", label="label", numeric=("o_totalprice",), categorical=(), wide=("o_custkey",))
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").alias("order_date"))
    label = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "1").otherwise("0").alias("label")
    rows = orders.join(customer, "o_custkey").select(*orders.columns, label)
    scored = classify(rows.where(roles.before_split()), rows.where(~roles.before_split()).drop("label"), spec)
    return scored.select("o_orderkey", F.col("predictedLabel").alias("label"))


@_register
def passenger_files(spark, sf_dir):
    """The passenger flow from CSV to CSV: customers in its layout, those with a small balance are known."""
    customer = table(spark, sf_dir, "customer")
    survives = F.col("c_nationkey") % 2 == 0

    def layout(df, *left_out):
        columns = {
            "PassengerId": F.col("c_custkey"),
            "Survived": F.when(survives, 1).otherwise(0),
            "Pclass": F.when(survives, 1).otherwise(3),
            "Name": F.concat(F.lit("of the "), "c_mktsegment", F.when(survives, ", Miss. Ann").otherwise(", Mr. Bob")),
            "Sex": F.when(survives, "female").otherwise("male"),
            "Age": F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey") + 20.5),
            "SibSp": F.when(survives, 2).otherwise(0),
            "Parch": F.when(survives, 1).otherwise(0),
            "Ticket": F.col("c_name"),
            "Fare": F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") % 100),
            "Cabin": F.lit(None).cast("string"),
            "Embarked": F.when(survives, "C"),
        }
        return df.select(*[c.alias(n) for n, c in columns.items() if n not in left_out])

    known = F.col("c_acctbal") < 5000
    train_path, test_path, out = (new_folder(spark, n) for n in ("passengers-train", "passengers-test", "passengers-out"))
    write_csv(layout(customer.where(known)), train_path)
    write_csv(layout(customer.where(~known), "Survived"), test_path)
    submit_passengers(spark, train_path, test_path, out)
    result = T.StructType([T.StructField("PassengerId", T.IntegerType(), False), T.StructField("Survived", T.StringType())])
    return read_by_name(spark, out, result)


# --- sources and sinks -----------------------------------------------------------------------


@_register
def head_sample(spark, sf_dir):
    """The first 1000 orders as a stored table; the second call finds it and computes nothing."""
    orders = table(spark, sf_dir, "orders")
    path = new_folder(spark, "head")
    stored_head(orders, path, ["o_orderkey"], 1000)
    return stored_head(orders, path, [F.desc("o_orderkey")], 1000)


@_register
def text_lines(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = new_folder(spark, "lines")
    orders.select(F.concat_ws("|", "o_orderkey", "o_orderpriority")).write.text(path)
    fields = F.split("value", r"\|")
    return read_lines(spark, path).select(
        fields[0].cast("bigint").alias("o_orderkey"), fields[1].alias("o_orderpriority")
    )


@_register
def csv_roundtrip(spark, sf_dir):
    """Columns bound by name: the schema has another order than the file and leaves one out."""
    orders = table(spark, sf_dir, "orders")
    path = new_folder(spark, "csv")
    write_csv(orders, path, order_by=["o_orderkey"])
    key = orders.schema["o_orderkey"]
    rest = without_fields(orders.schema, ["o_orderkey", "o_custkey"])
    return read_by_name(spark, path, append_field(T.StructType(rest.fields[::-1]), key))


@_register
def csv_declared(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    path = new_folder(spark, "csv")
    write_csv(supplier, path)
    key = supplier.schema["s_suppkey"]
    schema = prepend_field(without_fields(supplier.schema, [key.name]), key)
    return read_declared(spark, path, schema)


@_register
def csv_infer(spark, sf_dir):
    path = new_folder(spark, "csv")
    write_csv(table(spark, sf_dir, "customer"), path)
    return read_inferred(spark, path)


def _event_files(spark, sf_dir):
    """Events whose last field holds quotes and commas."""
    events = table(spark, sf_dir, "events").withColumn("props", F.concat("props", F.lit(', "x", y')))
    path = new_folder(spark, "csv")
    write_csv(events, path)
    return path, events.schema


@_register
def csv_events(spark, sf_dir):
    return read_by_name(spark, *_event_files(spark, sf_dir))


@_register
def csv_events_declared(spark, sf_dir):
    return read_declared(spark, *_event_files(spark, sf_dir))


@_register
def csv_events_inferred(spark, sf_dir):
    """Types as found, not as known: whole numbers that fit are ``int``."""
    return read_inferred(spark, _event_files(spark, sf_dir)[0])


@_register
def csv_types(spark, sf_dir):
    """The types found in the events, part of which have another type in two columns."""
    events = table(spark, sf_dir, "events")
    early = F.col("event_type") < "m"
    path = new_folder(spark, "csv")
    write_csv(events.where(early).select("event_id", F.col("user_id").cast("double"), "ts", "event_type"), path, mode="append")
    write_csv(events.where(~early).select((F.col("event_id") + BEYOND_INT).alias("event_id"), "user_id", F.col("ts").cast("date"), "event_type"), path, mode="append")
    found = inferred_types(spark, path)
    return found.select("column", "type", F.array_join("by_source", ",").alias("by_file"))


@_register
def csv_quoted(spark, sf_dir):
    """Whole texts with quotes, commas and line breaks."""
    documents = table(spark, sf_dir, "documents")
    path = new_folder(spark, "csv")
    write_csv(documents, path)
    return read_quoted(spark, path, documents.schema, multiline=True)


@_register
def parquet_roundtrip(spark, sf_dir):
    path = new_folder(spark, "parquet")
    write_parquet(table(spark, sf_dir, "lineitem"), path)
    return spark.read.parquet(path)


@_register
def row_audit(spark, sf_dir):
    """Orders as unquoted text: some priorities hold a comma, some codes are missing."""
    orders = table(spark, sf_dir, "orders")
    path = new_folder(spark, "audit")
    line = F.concat_ws(
        ",",
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.regexp_extract("o_orderpriority", "^[123]-(.*)$", 1),
        "o_orderstatus",
        F.translate("o_orderpriority", " ", ","),
    )
    orders.select(line).write.text(path)
    schema = T.StructType(
        [
            T.StructField("day", T.DateType(), False),
            T.StructField("code", T.StringType(), False),
            T.StructField("status", T.IntegerType()),
            T.StructField("priority", T.StringType()),
        ]
    )
    return audit_csv(spark, path, schema, header=False)


def _split_orders(spark, sf_dir):
    """The two parts of orders as unquoted text, see ``row_audit``, with their keys."""
    path = new_folder(spark, "audit")
    line = F.concat_ws(
        ",",
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.regexp_extract("o_orderpriority", "^[123]-(.*)$", 1),
        "o_orderstatus",
        F.translate("o_orderpriority", " ", ","),
    )
    table(spark, sf_dir, "orders").select(line).write.text(path)
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType(), False),
            T.StructField("day", T.DateType(), False),
            T.StructField("code", T.StringType(), False),
            T.StructField("status", T.IntegerType()),
            T.StructField("priority", T.StringType()),
        ]
    )
    return split_faulty(spark, path, schema, header=False)


@_register
def rejected_rows(spark, sf_dir):
    """Each fault of each record; those of columns that may be null leave the record in use."""
    faults = _split_orders(spark, sf_dir)[1]
    return faults.select("column", "value", "reason", "kept", "row.o_orderkey")


@_register
def accepted_rows(spark, sf_dir):
    return _split_orders(spark, sf_dir)[0]
