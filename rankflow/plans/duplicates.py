"""Feature table of item pairs that may be duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankflow.operators.pairs import clean_item_info, enrich_pairs
from rankflow.sources.readers import read_quoted
from rankflow.sources.schemas import ITEM_INFO_BULKY, ITEM_INFO_TEXTS


def pair_features(pairs: DataFrame, info: DataFrame, location: DataFrame) -> DataFrame:
    """Pairs with both items' cleaned info and region. Texts shrink to lengths before any join."""
    cleaned = clean_item_info(info, ITEM_INFO_BULKY, ITEM_INFO_TEXTS)
    return enrich_pairs(pairs, cleaned, location, "itemID", "locationID")


def pair_features_from_files(
    spark: SparkSession,
    pairs_path: str,
    info_path: str,
    location_path: str,
    multiline: bool = False,
) -> DataFrame:
    """``multiline`` is for item texts that hold line breaks; see ``read_quoted``."""
    return pair_features(
        read_quoted(spark, pairs_path),
        read_quoted(spark, info_path, multiline=multiline),
        read_quoted(spark, location_path),
    )
