"""Readers for delimited text. Every reader splits large files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.sources.inference import infer_types
from rankflow.sources.records import parse_records, read_records, record_header

#: Shared by every reader, the audit and the writer: a quote inside quotes is doubled.
CSV_QUOTES = {"quote": '"', "escape": '"'}


def _required(value: Column, text: Column, name: str) -> Column:
    """``value``, or a failed query where it is missing or did not parse."""
    seen = F.concat(F.lit(f"{name} is required and cannot be read from "), F.coalesce(text.cast("string"), F.lit("nothing")))
    return F.coalesce(value, F.raise_error(seen))


def read_declared(
    spark: SparkSession, path: str, schema: T.StructType, mode: str = "PERMISSIVE"
) -> DataFrame:
    """CSV with a header, columns bound to ``schema`` in file order.

    A value that does not parse is null, or fails the query where the field must not be null.
    """
    rows = spark.read.schema(schema).csv(path, header=True, mode=mode, **CSV_QUOTES)
    checked = [F.col(f"`{f.name}`") for f in schema.fields]
    checked = [
        c if f.nullable else _required(c, F.lit("its place"), f.name).alias(f.name)
        for c, f in zip(checked, schema.fields)
    ]
    return rows.select(*checked)


def read_by_name(
    spark: SparkSession, path: str, schema: T.StructType, strict: bool = False
) -> DataFrame:
    """CSV with a header, columns bound to ``schema`` by header name.

    The file may order its columns differently, hold further ones, or lack nullable ones (they
    come out null). A value that does not parse is null, or fails the query with ``strict``; a
    required one that is missing or does not parse fails it always.
    Files of one folder whose headers differ are refused rather than misread.
    """
    header = spark.read.csv(path, header=True, **CSV_QUOTES).schema
    raw = spark.read.schema(header).csv(path, header=True, enforceSchema=False, **CSV_QUOTES)
    missing = [f.name for f in schema.fields if f.name not in raw.columns and not f.nullable]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    columns = []
    for field in schema.fields:
        text = F.col(f"`{field.name}`") if field.name in raw.columns else F.lit(None)
        value = text.cast(field.dataType) if strict else text.try_cast(field.dataType)
        columns.append((value if field.nullable else _required(value, text, field.name)).alias(field.name))
    return raw.select(*columns)


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _texts(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header as text, all files with the same one."""
    header = spark.read.csv(path, header=True, **CSV_QUOTES).schema
    return spark.read.schema(header).csv(path, header=True, enforceSchema=False, **CSV_QUOTES)


def _types_of(texts: DataFrame) -> DataFrame:
    rows = texts.select("*", F.col("_metadata.file_path").alias("_rankflow_file"))
    return infer_types(rows, texts.columns, "_rankflow_file")


def _as_found(texts: DataFrame, types: DataFrame) -> DataFrame:
    """Columns cast to the types found, one row a column."""
    found = {r.column: r.type for r in types.collect()}
    return texts.select(*[F.col(f"`{n}`").cast(found.get(n, "string")).alias(n) for n in texts.columns])


def inferred_types(spark: SparkSession, path: str) -> DataFrame:
    """column, type and by_source of a CSV with a header, see :func:`rankflow.sources.inference.infer_types`; parts are files."""
    return _types_of(_texts(spark, path)).orderBy("place").select("column", "type", "by_source")


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, types found by one pass over the files.

    A column has the narrowest type that holds its values in all files; :func:`inferred_types` tells where files differ.
    Files whose headers differ are refused.
    """
    texts = _texts(spark, path)
    return _as_found(texts, _types_of(texts))


def read_quoted(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header and doubled quotes; any malformed record fails the query.

    Needs ``multiline`` when a quoted field holds line breaks: records are then put together from lines, see
    :mod:`rankflow.sources.records`, and large files are still read by many tasks.
    """
    if multiline:
        records = read_records(spark, path)
        if schema is not None:
            return parse_records(records, schema)
        texts = parse_records(records, _text_schema(record_header(records)))
        return _as_found(texts, infer_types(texts.withColumn("_rankflow_file", F.lit("")), texts.columns, "_rankflow_file"))
    # Without this, records are checked against the columns a query happens to select.
    reader = spark.read.option("columnPruning", False)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path, header=True, inferSchema=schema is None, mode="FAILFAST", **CSV_QUOTES)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text, one row per line in ``value``, with ``seq`` giving the order in the files."""
    return spark.read.text(path).select("value", line_order())


def read_list_file(spark: SparkSession, path: str) -> DataFrame:
    """Header-less ``id,v1 v2 v3`` lines as ``id bigint, items string, seq``.

    ``seq`` orders the lines as they stand in the files. An id that does not parse fails the query.
    """
    lines = spark.read.schema("id string, items string").csv(path, **CSV_QUOTES)
    number = _required(F.col("id").try_cast("bigint"), F.col("id"), "id")
    return lines.select(number.alias("id"), "items", line_order())


def line_order() -> Column:
    """Where a row of a text or CSV file stands: a struct that orders the rows as they are in the files."""
    # Within one input split the generated id grows from line to line; splits of a file are
    # ordered by where they start. The id alone would not do: Spark packs splits by size.
    # Part files go by their number: as text, number 100000 would come before 99999.
    number = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("bigint")
    return F.struct(
        F.coalesce(number, F.lit(-1)).alias("number"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ).alias("seq")
