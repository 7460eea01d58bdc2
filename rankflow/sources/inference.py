"""Types of text columns, found in one aggregation.

Each value is of one kind; the kinds of a column are bits of a number, and numbers of parts of the table merge by OR, in
any order. The type is the narrowest that holds all kinds seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INT, LONG, DOUBLE, BOOLEAN, DATE, TIMESTAMP, ZONED, TEXT = (1 << i for i in range(8))
#: Types, each with the kinds that it holds; the first one that holds all kinds of a column is its type.
_HOLDS = (
    ("int", INT),
    ("bigint", INT | LONG),
    ("double", INT | LONG | DOUBLE),
    ("boolean", BOOLEAN),
    ("date", DATE),
    ("timestamp_ntz", DATE | TIMESTAMP),
    ("timestamp", DATE | TIMESTAMP | ZONED),
)
_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def value_kind(text: Column) -> Column:
    """The kind of a value; 0 for null and for the empty text."""
    whole = text.rlike(r"^[+-]?\d+$")
    return (
        F.when(text.isNull() | (text == ""), 0)
        .when(whole & text.try_cast("int").isNotNull(), INT)
        .when(whole & text.try_cast("bigint").isNotNull(), LONG)
        .when(text.rlike(_NUMBER), DOUBLE)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull(), DATE)
        .when(text.rlike(_TIME + "$") & text.try_cast("timestamp_ntz").isNotNull(), TIMESTAMP)
        .when(text.rlike(_TIME + r"(Z|[+-]\d{2}:?\d{2})$") & text.try_cast("timestamp").isNotNull(), ZONED)
        .otherwise(TEXT)
    )


def kinds_type(kinds: str) -> Column:
    """The narrowest type that holds all kinds of the column ``kinds``; text where there are none."""
    found = F.when(F.col(kinds) == 0, "string")
    for name, held in _HOLDS:
        found = found.when(F.col(kinds).bitwiseAND((2 * TEXT - 1) & ~held) == 0, name)
    return found.otherwise("string")


def infer_types(rows: DataFrame, columns: Sequence[str], source: str) -> DataFrame:
    """One row for each of ``columns`` (text): column, type, and by_source (the types of the parts, where they differ).

    ``source`` names the column that tells the parts apart, such as the file. Kinds are merged map-side for each part,
    then over the parts.
    """
    # one expression for all columns
    texts = F.array(*[F.col(f"`{c}`") for c in columns])
    each = rows.select(F.col(source).alias("source"), F.transform(texts, value_kind).alias("kinds"))
    parts = each.groupBy("source").agg(F.array(*[F.bit_or(F.get("kinds", F.lit(i))) for i in range(len(columns))]).alias("kinds"))
    each = parts.select("source", F.posexplode("kinds").alias("place", "kinds"))
    each = each.withColumn("column", F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("place") + 1))
    own = F.when(F.col("kinds") != 0, kinds_type("kinds"))
    merged = each.groupBy("column", "place").agg(F.bit_or("kinds").alias("kinds"), F.array_sort(F.collect_set(own)).alias("types"))
    differing = F.when(F.size("types") > 1, F.col("types")).otherwise(F.array().cast("array<string>"))
    return merged.select("column", "place", kinds_type("kinds").alias("type"), differing.alias("by_source"))
