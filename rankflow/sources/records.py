"""Quoted CSV whose fields hold line breaks, read by as many tasks as the files have splits.

A line break ends a record only outside quotes, that is after an even number of quotes of its file. Quotes are counted for
each split; the sum over the splits before it (one row a split) says whether a split begins inside quotes; within a split
the lines carry that on. Lines inside quotes are put back to the record that they belong to, also across splits, and
Spark's own CSV parser reads the records.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.sources.workspace import Workspace, stored

_PARSER = {"quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n"}


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (where the split begins), line (ascending within a split), value, quotes.

    Stored, so that all that is derived from it sees the same splits. Lines end at a line feed; a carriage return
    before it stays with the line, as it may be part of a quoted field.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"')))).alias("quotes"),
    )
    return stored(lines, "csv-lines")


def _split_states(lines: DataFrame) -> DataFrame:
    """file, block, odd: whether a split begins inside quotes. One row a split, and a window over the splits of a file."""
    sums = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2
    return sums.select("file", "block", odd.alias("odd"))


def _pieces(lines: DataFrame) -> DataFrame:
    """file, block, start, first, value: the lines of a split by the record that they belong to.

    ``start`` is the record's first line, null for lines that go on from an earlier split; ``first`` marks the first record
    of a file. One shuffle by split: the windows, the join and the grouping all keep to it.
    """
    split = Window.partitionBy("file", "block")
    in_order = split.orderBy("line")
    before = F.coalesce(F.sum("quotes").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.withColumn("before", before).join(_split_states(lines), ["file", "block"])
    begins = (F.col("before") + F.col("odd")) % 2 == 0
    filled = ~F.col("value").isin("", "\r")
    placed = placed.withColumns(
        {
            "start": F.max(F.when(begins, F.col("line"))).over(in_order),
            "leading": F.min(F.when(begins & filled, F.col("line"))).over(split),
        }
    )
    first = (F.col("block") == 0) & F.coalesce(F.col("start") == F.col("leading"), F.lit(False))
    parts = F.sort_array(F.collect_list(F.struct("line", "value")))
    grouped = placed.groupBy("file", "block", "start", first.alias("first")).agg(parts.alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    return grouped.select("file", "block", "start", "first", text.alias("value"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, block, line, first, value: one row for each record of the files in ``path``, and the place where it begins.

    Fields are quoted with ``"`` and a quote within is doubled. Line breaks within quotes are kept as they are; the one after
    a record is not part of it. Empty lines outside quotes are no records. A file that ends inside quotes keeps
    what follows the last opening quote as one record, which a strict parser refuses.
    """
    with Workspace(spark) as own:
        pieces = stored(_pieces(_numbered_lines(spark, path)), "csv-pieces")
        # what a split holds before its first record goes on with the last record of the splits before it
        ends = pieces.groupBy("file", "block").agg(
            F.max("start").alias("start"), F.max(F.when(F.col("start").isNull(), F.col("value"))).alias("head")
        )
        along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        known = F.last(F.when(F.col("start").isNotNull(), F.struct("block", "start")), True).over(along)
        heads = ends.withColumn("of", known).where(F.col("head").isNotNull())
        rests = heads.groupBy("file", F.col("of.block").alias("block"), F.col("of.start").alias("start")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("block").alias("at"), "head"))).alias("heads")
        )
        rest = F.array_join(F.transform("heads", lambda h: h["head"]), "\n")
        rests = rests.select("file", "block", "start", rest.alias("rest"))
        whole = pieces.where(F.col("start").isNotNull()).join(rests, ["file", "block", "start"], "left")
        value = F.regexp_replace(F.concat_ws("\n", "value", "rest"), r"\r\z", "")
        records = whole.select("file", "block", F.col("start").alias("line"), "first", value.alias("value"))
        return own.keep(records.where(F.col("value") != ""))


def record_header(records: DataFrame) -> list[str]:
    """The names in the first record of each file, which must agree."""
    found = [r.value for r in records.where("first").select("value").distinct().limit(2).collect()]
    if len(found) > 1:
        raise ValueError(f"files whose headers differ: {found}")
    return next(csv.reader([found[0]])) if found else []


def parse_records(records: DataFrame, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """The columns of ``schema``, in the order of the fields, of all records but headers. A malformed one fails the query."""
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("value", names, _PARSER | {"mode": mode})
    return records.where(~F.col("first")).select(parsed.alias("record")).select("record.*")
