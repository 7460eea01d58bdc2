"""Item-pair features for duplicate detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rankflow.functions.columns import suffix_columns, text_length


def clean_item_info(
    info: DataFrame, drop: Sequence[str], measure: Sequence[str]
) -> DataFrame:
    """Drop bulky columns, blank missing strings, and replace texts by their lengths."""
    kept = info.drop(*drop).na.fill("")
    return kept.withColumns({c: text_length(c) for c in measure})


def enrich_pairs(
    pairs: DataFrame,
    info: DataFrame,
    lookup: DataFrame,
    id_col: str,
    lookup_id: str,
    suffixes: tuple[str, str] = ("_1", "_2"),
) -> DataFrame:
    """Both members of each pair with their info and their lookup row, under suffixes.

    A pair is kept only when both items and both lookup rows exist. The lookup is joined to the
    info once, before the pairs: the same rows as looking it up for each member, with one join
    fewer over the larger pair table.
    """
    located = info.join(lookup, lookup_id, "inner")
    result = pairs
    for suffix in suffixes:
        result = result.join(suffix_columns(located, suffix), id_col + suffix, "inner")
    keys = [name + s for name in (lookup_id, id_col) for s in reversed(suffixes)]
    return result.select(*keys, *[c for c in result.columns if c not in keys])
