"""Exact copies by most-significant-digit radix partitioning: bytes decide, never a digest.

The first digit of a text is its length together with its first bytes; later digits are the
following bytes, in strides that grow by a factor, so that a text of n bytes takes about
log(n) rounds. Each round splits every open group by its next digit. A group leaves when it
is a single text or when its texts have ended: same length and same bytes up to the end are
equal texts. Only open groups carry their remaining bytes to the next round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.operators.joins import join_ranked
from rankflow.llm.names import free_names
from rankflow.sources.workspace import stored


def _split(rows: DataFrame, keys: list[str], end: int) -> DataFrame:
    """One round. ``rows``: doc_id, sha, mark, size, row, rest and the keys, of which ``digit`` was cut off ``rest``.

    Counts are combined before the shuffle, so a group of copies is one row for each task;
    the join back to the rows can be split by Spark where a group is hot.
    """
    groups = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep"), F.max("row").alias("next_group")
    )
    ended = (F.col("n") == 1) | (F.col("size") <= end)
    return join_ranked(rows, groups, keys, "inner").select(
        "doc_id", "sha", "mark", "size", "row", "n", "keep",
        F.col("next_group").alias("part"),
        F.when(~ended, F.col("rest")).alias("rest"),
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first: int = 64,
    growth: int = 8,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, row_mark.

    Texts are equal when their UTF-8 bytes are; a null text counts as empty. The row with the
    largest id of each group stays. Null ids are below all others; a group with null ids alone has
    keep_id null and keeps them all. Rows repeated with the same id count in group_size and are all
    marked kept (:func:`drop_copies` leaves one). An empty table gives no rows. Other
    columns are ignored. ``text_sha256`` and ``row_mark`` (a hash of the text that tells rows with
    the same id apart) are only reported, groups don't depend on them.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    whole = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("bytes"), F.monotonically_increasing_id().alias("row")
    )
    rows = whole.select(
        "doc_id",
        F.unhex(F.sha2("bytes", 256)).alias("sha"),
        F.xxhash64("bytes").alias("mark"),
        F.octet_length("bytes").cast("bigint").alias("size"),
        "row",
        F.substring("bytes", 1, first).alias("digit"),
        F.expr(f"substring(bytes, {first + 1})").alias("rest"),
    )
    done, end, width = [], first, first
    level = stored(_split(rows, ["size", "digit"], end), "radix")
    while True:
        done.append(level.where(F.col("rest").isNull()))
        open_rows = level.where(F.col("rest").isNotNull())
        longest = open_rows.agg(F.max("size")).first()[0]
        if longest is None:
            break
        width *= growth
        end += width
        rows = open_rows.select(
            "doc_id", "sha", "mark", "size", "row", "part",
            F.substring("rest", 1, width).alias("digit"),
            F.expr(f"substring(rest, {width + 1})").alias("rest"),
        )
        level = stored(_split(rows, ["part", "digit"], end), "radix")
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.select(
        "doc_id",
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        F.col("mark").alias("row_mark"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the copies that :func:`exact_groups` drops; columns stay as they are.

    Where rows repeat with the same id and text, one of them stays. Only ids that occur more than
    once among the kept rows are compared again.
    """
    groups = exact_groups(docs, id_col, text_col, **options).where("kept")
    kept_id, kept_mark, times = free_names(docs, "kept_id", "kept_mark", "times")
    kept = groups.groupBy(F.col("doc_id").alias(kept_id), F.col("row_mark").alias(kept_mark)).agg(F.count(F.lit(1)).alias(times))
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    same = F.col(id_col).eqNullSafe(F.col(kept_id)) & (mark == F.col(kept_mark))
    rows = docs.join(kept, same).drop(kept_id, kept_mark)
    single = rows.where(F.col(times) == 1).drop(times)
    repeated = rows.where(F.col(times) > 1).drop(times).dropDuplicates([id_col, text_col])
    return single.unionByName(repeated)
