"""Rules applied in priority order, with filling and padding from the global list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.functions.arrays import first_items, pad_items
from rankflow.operators.joins import join_ranked
from rankflow.operators.topk import Rule, key_types, keys_present, rule_keys, top_k_per_group

# Fixed value: rank of the items given to a request that no rule matched.
REMAINDER_RANK = 999

# Rows that cannot match are spread over this many keys, so that a table with many missing
# keys does not send them all to one task.
_SPREAD = 8192


def rank_step(k: int) -> int:
    """Factor between the ranks of consecutive rules: 10 while lists are shorter than 10."""
    return 10 ** len(str(k))


def match_rule(
    requests: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    id_col: str,
    item: str,
    factor: int = 1,
    rank_col: str = "rn",
) -> DataFrame:
    """Candidates of one rule for every request with the same keys: ``id, item, rank * factor``.

    No size hint is given: Spark broadcasts the table when its measured size allows.
    """
    joined = join_ranked(requests.select(id_col, *keys), table, keys, "inner")
    return joined.select(id_col, item, (F.col(rank_col) * factor).alias(rank_col))


def unmatched_ids(requests: DataFrame, id_col: str, *hits: DataFrame) -> DataFrame:
    """Distinct request ids that appear in none of ``hits``.

    A set difference as one aggregation: repeats collapse before the single shuffle.
    """
    seen = requests.select(id_col, F.lit(False).alias("hit"))
    for part in hits:
        seen = seen.unionAll(part.select(id_col, F.lit(True).alias("hit")))
    matched = seen.groupBy(id_col).agg(F.bool_or("hit").alias("hit"))
    return matched.where(~F.col("hit")).select(id_col)


def fill_remainder(
    ids: DataFrame, id_col: str, item: str, fallback: Column, rank_col: str = "rn"
) -> DataFrame:
    """Every id with every item of the ``fallback`` list (see ``popular_list``) at the last rank."""
    filled = ids.select(id_col, F.explode(fallback).alias(item))
    return filled.select(id_col, item, F.lit(REMAINDER_RANK).alias(rank_col))


def ids_without_match(matched: DataFrame, id_col: str, rank_col: str = "rn") -> DataFrame:
    """Ids of ``match_rules`` that no rule matched: their rows hold no rank. One aggregation, no second scan."""
    counts = matched.groupBy(id_col).agg(F.count(rank_col).alias("_n"))
    return counts.where(F.col("_n") == 0).select(id_col)


def rerank_matched(
    matched: DataFrame,
    id_col: str,
    item: str,
    fallback: Column,
    k: int = 5,
    rank_col: str = "rn",
    new_rank_col: str = "rn_all",
) -> DataFrame:
    """Remainder, bag union and ranking of ``match_rules`` in one pass: ``id, item, rank, new rank``.

    Rows without a rank sort last, so one of them leads its id only where nothing matched; it turns into
    the items of ``fallback``, which all hold the last rank and go by item.
    """
    order = [F.asc_nulls_last(rank_col), F.asc(item)]
    ranked = top_k_per_group(matched, [id_col], order, k, new_rank_col)
    ranked = ranked.where(F.col(rank_col).isNotNull() | (F.col(new_rank_col) == 1)).select("*", fallback.alias("_more"))

    def entry(what: Column, rank: Column, place: Column) -> Column:
        return F.struct(what.alias(item), rank.cast("bigint").alias(rank_col), place.cast("int").alias(new_rank_col))

    filled = F.transform(F.sort_array("_more"), lambda x, i: entry(x, F.lit(REMAINDER_RANK), i + 1))
    own = F.array(entry(F.col(item), F.col(rank_col), F.col(new_rank_col)))
    return ranked.select(id_col, F.inline(F.when(F.col(rank_col).isNull(), filled).otherwise(own)))


def union_rerank(
    parts: Sequence[DataFrame],
    id_col: str,
    item: str,
    k: int = 5,
    rank_col: str = "rn",
    new_rank_col: str = "rn_all",
) -> DataFrame:
    """Bag union of matches, numbered again per id by rank and then item, first ``k`` kept."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    order = [F.asc_nulls_last(rank_col), F.asc(item)]
    return top_k_per_group(merged, [id_col], order, k, new_rank_col)


def ordered_lists(
    ranked: DataFrame,
    id_col: str,
    item: str,
    fallback: Column,
    k: int = 5,
    rank_col: str = "rn_all",
    dedupe: bool = False,
) -> DataFrame:
    """One row per id: its items in rank order, padded to ``k`` from ``fallback``.

    ``ranked`` holds at most ``k`` rows per id already partitioned by id, so collecting them is
    bounded and needs no further shuffle. The order comes from the rank itself, never from an
    earlier sort. An id whose rows hold no item (see ``match_rules``) gets the fallback list by
    item.
    """
    pair = F.when(F.col(item).isNotNull(), F.struct(F.col(rank_col), F.col(item)))
    lists = ranked.groupBy(id_col).agg(F.sort_array(F.collect_list(pair)).alias("_pairs"))
    found = lists.select(id_col, F.col("_pairs")[item].alias("_found"), fallback.alias("_more"))
    own = _own_or_fallback("_found", "_more")
    every = F.array_distinct(F.concat(own, "_more"))
    return found.select(id_col, (first_items(every, k) if dedupe else pad_items(own, "_more", k)).alias(item))


def _own_or_fallback(found: str, more: str) -> Column:
    """A list, or the fallback by item where it is empty.

    Takes columns: the fallback is a subquery, which should stand in a plan only once.
    """
    return F.when(F.size(found) == 0, F.sort_array(more)).otherwise(F.col(found))


def ask_rules(requests: DataFrame, rules: Sequence[Rule], id_col: str) -> DataFrame:
    """One row per request and rule: ``id, _place, rule, keys...``.

    ``_place`` is the number of the rule. So is ``rule``, unless the request lacks one of its
    keys: then it is an impossible number that depends on the id, so that such requests match
    nothing and do not pile up in one partition.
    """
    types = key_types(requests, rules)
    entries = []
    for number, rule in enumerate(rules, start=1):
        impossible = -1 - F.pmod(F.hash(id_col), F.lit(_SPREAD))
        entries.append(
            F.struct(
                F.lit(number).alias("_place"),
                F.when(keys_present(rule), F.lit(number)).otherwise(impossible).alias("rule"),
                *rule_keys(rule, types),
            )
        )
    return requests.select(id_col, F.inline(F.array(*entries)))


def match_rules(
    requests: DataFrame, table: DataFrame, rules: Sequence[Rule], id_col: str, item: str, k: int = 5
) -> DataFrame:
    """All rules of ``rule_candidates`` matched in one join: ``id, item, rn``.

    ``rn`` is the rank times ``rank_step(k)`` per earlier rule. Every request keeps at least one row:
    where the first rule found nothing, item and rank are null. Other rules without a match leave no row.
    """
    asked = ask_rules(requests, rules, id_col)
    joined = join_ranked(asked, table, ["rule", *key_types(requests, rules)], "left")
    kept = joined.where(F.col("rn").isNotNull() | (F.col("_place") == 1))
    rank = F.col("rn") * F.pow(F.lit(rank_step(k)), F.col("_place") - 1).cast("bigint")
    return kept.select(id_col, item, F.when(F.col("rn").isNotNull(), rank).alias("rn"))


def match_lists(
    requests: DataFrame, lists: DataFrame, rules: Sequence[Rule], id_col: str
) -> DataFrame:
    """All rules of ``rule_lists`` matched in one join: ``id, _place, _items``.

    One row per request and rule that found something, and one of the first rule in any case;
    without a match its items are null.
    """
    asked = ask_rules(requests, rules, id_col)
    joined = join_ranked(asked, lists, ["rule", *key_types(requests, rules)], "left")
    kept = joined.where(F.col("_items").isNotNull() | (F.col("_place") == 1))
    return kept.select(id_col, "_place", "_items")


def merge_lists(
    matched: DataFrame, id_col: str, item: str, fallback: Column, k: int = 5, dedupe: bool = False
) -> DataFrame:
    """``union_rerank`` and ``ordered_lists`` in one, over ``match_lists``: ``id, items``.

    Items go by place of their rule, then rank, then item. An id may have any number of rows,
    and its first ``k`` by place and first item are enough: each brings at least one item, and
    of rows of the same place that do not all fit, the first items come before all second ones.
    So what is collected per id is bounded. With ``dedupe`` rows may bring the same items, so all count:
    ``_distinct_found`` collects what differs.
    """
    found = _distinct_found(matched, id_col, k) if dedupe else _first_found(matched, id_col, k)
    lists = found.select(id_col, "_found", fallback.alias("_more"))
    own = _own_or_fallback("_found", "_more")
    every = F.array_distinct(F.concat(own, "_more"))
    return lists.select(id_col, (first_items(every, k) if dedupe else pad_items(own, "_more", k)).alias(item))


def _first_found(matched: DataFrame, id_col: str, k: int) -> DataFrame:
    first = F.try_element_at("_items", F.lit(1))
    order = [F.col("_items").isNull().asc(), F.asc("_place"), first.asc()]
    kept = top_k_per_group(matched, [id_col], order, k, "_nth")
    ranked = F.transform(
        "_items", lambda x, i: F.struct(F.col("_place"), i.alias("rank"), x.alias("item"))
    )
    lists = kept.select(id_col, ranked.alias("ranked")).groupBy(id_col)
    return lists.agg(F.sort_array(F.flatten(F.collect_list("ranked")))["item"].alias("_found"))


def _distinct_found(matched: DataFrame, id_col: str, k: int) -> DataFrame:
    """``id, _found``: the first ``k`` distinct items by place, rank and item.

    One set per rank holds places and items, so repeats collapse before the shuffle, and an id with many rows
    holds no more than each item once per rule and rank. A list stays one row until then.
    """

    def entry(rank: int) -> Column:
        value = F.get("_items", F.lit(rank))
        return F.when(value.isNotNull(), F.struct(F.col("_place"), F.lit(rank).alias("rank"), value.alias("item")))

    sets = matched.groupBy(id_col).agg(*[F.collect_set(entry(rank)).alias(f"_set{rank}") for rank in range(k)])
    ordered = F.sort_array(F.concat(*[f"_set{rank}" for rank in range(k)]))
    return sets.select(id_col, first_items(F.array_distinct(ordered["item"]), k).alias("_found"))
