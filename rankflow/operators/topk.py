"""Weighted popularity and the best ``k`` items per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True, eq=False)
class Rule:
    """How one rule ranks items: score per ``keys`` and item, over the rows passing ``where``.

    Without ``weight`` the score is the number of rows; otherwise it is the sum of ``weight``.
    """

    keys: tuple[str, ...]
    weight: Column | None = None
    where: Column | None = None


def top_k_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    k: int,
    rank_col: str = "rn",
) -> DataFrame:
    """First ``k`` rows of each group, with their position.

    The comparison sits directly on ``row_number`` so that Spark trims every group to ``k``
    rows per task before the shuffle; a group holding most of the table never travels whole.
    Several keys are led by their hash: sorting compares the first column before all others,
    and the hash alone tells almost every pair of groups apart.
    """
    groups = [F.xxhash64(*keys), *keys] if len(keys) > 1 else keys
    return _trim(df, groups, order_by, k, rank_col)


def _trim(df: DataFrame, groups, order_by: Sequence[Column], k: int, rank_col: str) -> DataFrame:
    position = F.row_number().over(Window.partitionBy(*groups).orderBy(*order_by))
    return df.withColumn(rank_col, position).where(F.col(rank_col) <= k)


def _score(weight: Column | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def _best_first(score_col: str, item: str) -> list[Column]:
    return [F.desc(score_col), F.asc(item)]


def candidates(
    df: DataFrame,
    rule: Rule,
    item: str,
    k: int = 5,
    score_col: str = "score",
    rank_col: str = "rn",
    keep_null_keys: bool = False,
) -> DataFrame:
    """Top ``k`` items per key of one rule: ``keys, item, score, rank``. Ties go to the lower item.

    Groups with a null key can never be joined to, so they are dropped before the shuffle
    unless asked for. Rows without an item rank nothing.
    """
    df = df.where(F.col(item).isNotNull())
    if rule.where is not None:
        df = df.where(rule.where)
    if not keep_null_keys:
        df = df.dropna("any", subset=list(rule.keys))
    scored = df.groupBy(*rule.keys, item).agg(_score(rule.weight).alias(score_col))
    return top_k_per_group(scored, rule.keys, _best_first(score_col, item), k, rank_col)


def popularity(
    df: DataFrame, item: str, weight: Column | None = None, score_col: str = "score"
) -> DataFrame:
    """Score of every item over the whole table, best first; rows without an item don't count."""
    scored = df.where(F.col(item).isNotNull()).groupBy(item).agg(_score(weight).alias(score_col))
    return scored.orderBy(*_best_first(score_col, item))


def popular_items(
    df: DataFrame, item: str, weight: Column | None = None, k: int = 5, score_col: str = "score"
) -> DataFrame:
    """The ``k`` best items of the whole table."""
    return popularity(df, item, weight, score_col).limit(k)


def popular_list(df: DataFrame, item: str, weight: Column | None = None, k: int = 5) -> Column:
    """``popular_items`` as one array, best first, usable as a constant in any projection.

    A scalar subquery of ``k`` elements: nothing is joined and the size does not grow with the
    data. An empty table gives an empty list.
    """
    best = popular_items(df, item, weight, k, "score")
    row = best.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("low"), F.col(item).alias("item"))))
        .alias("ranked")
    )
    return row.select(F.transform("ranked", lambda r: r["item"]).alias("items")).scalar()


# --- all rules in one pass -------------------------------------------------------------------


# Columns that the ranking of several rules adds.
RESERVED = {"rule", "score", "rn"}


def key_types(df: DataFrame, rules: Sequence[Rule]) -> dict[str, T.DataType]:
    """Type of every key column used by any rule, in order of first use."""
    names = dict.fromkeys(name for rule in rules for name in rule.keys)
    if taken := RESERVED.intersection(names):
        raise ValueError(f"rename the key columns {sorted(taken)}; the ranking adds columns so named")
    return {name: df.schema[name].dataType for name in names}


def joined_types(types: dict[str, T.DataType]) -> dict[str, T.DataType]:
    """Types as compared: numbers keep theirs, everything else is compared as text."""
    return {n: t if isinstance(t, T.NumericType) else T.StringType() for n, t in types.items()}


def rule_keys(rule: Rule, types: dict[str, T.DataType]) -> list[Column]:
    """The key columns of all rules, missing ones and those this rule does not use blanked.

    With the rule number in front, rows of different rules never meet, and plain equality on
    all columns compares exactly the keys of one rule. Rows with a missing key must be told
    apart with ``keys_present``.
    """
    columns = []
    for name, dtype in joined_types(types).items():
        blank = F.lit("") if isinstance(dtype, T.StringType) else F.lit(0)
        blank = blank.cast(dtype)
        value = F.coalesce(F.col(name).cast(dtype), blank) if name in rule.keys else blank
        columns.append(value.alias(name))
    return columns


def keys_present(rule: Rule) -> Column:
    present = F.lit(True)
    for name in rule.keys:
        present = present & F.col(name).isNotNull()
    return present


def rule_candidates(
    train: DataFrame, rules: Sequence[Rule], item: str, k: int = 5, first_number: int = 1
) -> DataFrame:
    """``candidates`` of every rule from a single scan: ``rule, keys..., item, score, rn``.

    Each row turns into one entry per rule it serves, and all entries share one partial
    aggregation, one shuffle and one ranking, where a rule-by-rule plan would repeat the scan
    and its joins. ``rule`` counts from ``first_number``. Keys a rule does not use hold a
    constant; a rule without keys ranks the items of the whole table.
    """
    return _ranked_by_rule(train, rules, item, k, first_number).drop("_key")


def global_list(ranked: DataFrame, item: str) -> Column:
    """Items of rule 0 (one without keys) of ``rule_candidates`` as an array constant, best first; empty without rows.

    Rule 0 is picked inside the aggregate and not by a filter: a filter would sink to the scan, and the subquery
    could no longer reuse the shuffled candidates of the plan that it stands in.
    """
    pair = F.when(F.col("rule") == 0, F.struct("rn", F.col(item).alias("item")))
    return ranked.agg(F.sort_array(F.collect_list(pair))["item"].alias("best")).scalar()


def rule_lists(
    train: DataFrame, rules: Sequence[Rule], item: str, k: int = 5, first_number: int = 1
) -> DataFrame:
    """``rule_candidates`` as one row per key, its items best first: ``rule, keys..., _items``.

    The rows of a key are together after the ranking, so this takes no shuffle.
    """
    ranked = _ranked_by_rule(train, rules, item, k, first_number)
    pairs = F.sort_array(F.collect_list(F.struct("rn", F.col(item).alias("item"))))
    lists = ranked.groupBy("_key", "rule", *key_types(train, rules)).agg(pairs["item"].alias("_items"))
    return lists.drop("_key")


def _ranked_by_rule(train, rules, item, k, first_number) -> DataFrame:
    types = key_types(train, rules)
    entries = []
    for number, rule in enumerate(rules, start=first_number):
        weight = F.lit(1) if rule.weight is None else rule.weight
        serves = keys_present(rule) if rule.where is None else keys_present(rule) & rule.where
        entries.append(
            F.struct(
                F.when(serves, F.lit(number)).alias("rule"),
                *rule_keys(rule, types),
                weight.alias("_weight"),
            )
        )
    served = train.where(F.col(item).isNotNull()).select(item, F.inline(F.array(*entries))).where(F.col("rule").isNotNull())
    group = ["rule", *types]
    scored = served.groupBy(*group, item).agg(F.sum("_weight").alias("score"))
    hashed = scored.withColumn("_key", F.xxhash64(*group))
    return _trim(hashed, ["_key", *group], _best_first("score", item), k, "rn")
