"""DataFrame-to-DataFrame operators."""

from rankflow.operators.aggregates import impute_joint_mean, joint_means, last_write_wins
from rankflow.operators.cascade import (
    ask_rules,
    fill_remainder,
    match_lists,
    match_rule,
    match_rules,
    merge_lists,
    ordered_lists,
    union_rerank,
    unmatched_ids,
)
from rankflow.operators.joins import join_ranked
from rankflow.operators.ordering import category_index, rank_sum_auc, running_total
from rankflow.operators.pairs import clean_item_info, enrich_pairs
from rankflow.operators.topk import (
    Rule,
    candidates,
    popular_items,
    popular_list,
    popularity,
    rule_candidates,
    rule_lists,
    top_k_per_group,
)

__all__ = [
    "Rule",
    "ask_rules",
    "candidates",
    "category_index",
    "clean_item_info",
    "enrich_pairs",
    "fill_remainder",
    "impute_joint_mean",
    "join_ranked",
    "joint_means",
    "last_write_wins",
    "match_lists",
    "match_rule",
    "match_rules",
    "merge_lists",
    "ordered_lists",
    "popular_items",
    "popular_list",
    "popularity",
    "rank_sum_auc",
    "rule_candidates",
    "rule_lists",
    "running_total",
    "top_k_per_group",
    "union_rerank",
    "unmatched_ids",
]
