"""Helpers over array columns that hold ordered lists of item ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int_list(text: Column | str, sep: str = " ", strict: bool = True) -> Column:
    """``"15 25 9"`` -> ``[15, 25, 9]`` as bigint, order and repeats kept; a blank text is an empty list.

    A token that is not an integer fails the query. Without ``strict`` it is null in its place, so
    that later items keep theirs.
    """
    tokens = F.filter(F.split(_col(text), sep), lambda t: t != "")

    def number(token: Column) -> Column:
        value = token.try_cast("bigint")
        bad = F.raise_error(F.concat(F.lit("not an integer in a list: "), token))
        return F.coalesce(value, bad) if strict else value

    return F.transform(tokens, number)


def distinct_items(items: Column | str) -> Column:
    """Drop repeats, keeping the first position of each item."""
    return F.array_distinct(_col(items))


def first_items(items: Column | str, k: int) -> Column:
    return F.slice(_col(items), 1, k)


def pad_items(items: Column | str, fallback: Column | str, k: int) -> Column:
    """The list followed by ``fallback``, cut to ``k``. Repeats are kept on purpose."""
    return first_items(F.concat(_col(items), _col(fallback)), k)


def join_items(items: Column | str, sep: str = " ") -> Column:
    return F.array_join(_col(items), sep)
