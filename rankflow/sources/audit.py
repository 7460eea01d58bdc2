"""Missing and unparseable values: counted in one aggregation, or set apart as rows while a file is read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.sources.readers import CSV_QUOTES, line_order
from rankflow.sources.workspace import new_folder

MALFORMED = "_malformed"


def _raw_records(spark: SparkSession, path: str, schema: T.StructType, header: bool) -> tuple[DataFrame, list[str]]:
    """The records of a file as text, with those of another width whole in ``_malformed``; and the names of their fields."""
    names = spark.read.csv(path, header=True, **CSV_QUOTES).columns if header else schema.fieldNames()
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])
    # Whole records must be split to be counted, also where no column of theirs is audited.
    reader = spark.read.schema(text).option("columnPruning", False)
    return reader.csv(path, header=header, enforceSchema=not header, columnNameOfCorruptRecord=MALFORMED, **CSV_QUOTES), names


def audit_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """``audit_rows`` of a file against its declared schema, before any value is converted.

    Fields that must not be null are required, and all but strings must parse. The row
    ``_malformed`` counts the records with too few or too many fields as unparseable. Columns
    are found by name in the header, or stand in the order of the schema without one.
    """
    raw, names = _raw_records(spark, path, schema, header)
    known = [f for f in schema.fields if f.name in names]
    return audit_rows(
        raw,
        [f.name for f in known if not f.nullable],
        {f.name: f.dataType.simpleString() for f in known if not isinstance(f.dataType, T.StringType)},
        malformed=MALFORMED,
    )


def split_faulty(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows of a file that can be used, in the columns of ``schema``, and the faults of all its rows.

    A fault has file and seq (its place, see ``read_lines``), column, value, reason, and kept: whether the row is used
    nevertheless, as it is where the field may be null. A row is refused where a required value is missing or does
    not parse, and where the number of fields is another one (column ``_malformed``, the value is the record). A column that the
    file lacks is null, or an error if it is required. The file is parsed once; both parts are written side by side.
    """
    raw, names = _raw_records(spark, path, schema, header)
    missing = [f.name for f in schema.fields if f.name not in names and not f.nullable]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    values, faults = [], []

    def fault(when: Column, column: str, value: Column, reason: str, fatal: bool) -> Column:
        found = F.struct(F.lit(column).alias("column"), value.alias("value"), F.lit(reason).alias("reason"), F.lit(fatal).alias("fatal"))
        return F.when(when, found)

    for field in schema.fields:
        if field.name not in names:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        text = F.nullif(F.col(f"`{field.name}`"), F.lit(""))
        value = text.try_cast(field.dataType)
        values.append(value.alias(field.name))
        if not field.nullable:
            faults.append(fault(text.isNull(), field.name, text, "missing", True))
        if not isinstance(field.dataType, T.StringType):
            faults.append(fault(text.isNotNull() & value.isNull(), field.name, text, "unparseable", not field.nullable))
    whole = F.col(MALFORMED)
    faults.append(fault(whole.isNotNull(), MALFORMED, whole, "wrong number of fields", True))
    found = F.filter(F.array(*faults), lambda f: f.isNotNull())
    checked = raw.select(F.struct(*values).alias("row"), found.alias("faults"), line_order().alias("seq"))
    refused = F.exists("faults", lambda f: f["fatal"])
    target = new_folder(spark, "checked")
    checked.withColumn("refused", refused).write.partitionBy("refused").parquet(target)
    columns = T.StructType([T.StructField("row", checked.schema["row"].dataType), checked.schema["faults"], checked.schema["seq"], T.StructField("refused", T.BooleanType())])
    rows = spark.read.schema(columns).parquet(target)
    clean = rows.where(~F.col("refused")).select("row.*")
    faulty = rows.select("seq", "refused", "row", F.inline("faults"))
    return clean, faulty.select(F.col("seq.file").alias("file"), "seq", "column", "value", "reason", (~F.col("refused")).alias("kept"), "row")


def read_clean(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a file with a header, parsed once; one with records of another width, or required values missing or
    unparseable, is refused, with the number of faults in refused rows and the first value of each kind."""
    clean, faults = split_faulty(spark, path, schema)
    counts = faults.where(~F.col("kept")).groupBy("column", "reason").agg(F.count(F.lit(1)).alias("n"), F.min_by("value", "seq").alias("value")).collect()
    if counts:
        raise ValueError(f"{path} holds (column, reason, how often, first value): {sorted(tuple(r) for r in counts)}")
    return clean


def audit_rows(
    df: DataFrame,
    required: Sequence[str] = (),
    parse: Mapping[str, str] | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """One row per audited column: ``column, missing, unparseable``.

    ``required`` columns count null and empty values as missing. ``parse`` maps a text column
    to the type it should hold and counts values that do not convert. ``malformed`` names the
    column that holds the text of a record only where the record did not fit.
    """
    parse = parse or {}
    names = list(dict.fromkeys([*required, *parse]))
    counts, rows = [], []
    for i, name in enumerate(names):
        text = F.nullif(F.col(name).cast("string"), F.lit(""))
        bad = F.lit(False)
        if name in parse:
            bad = text.isNotNull() & text.try_cast(parse[name]).isNull()
        counts.append(F.count_if(text.isNull() if name in required else F.lit(False)).alias(f"m{i}"))
        counts.append(F.count_if(bad).alias(f"b{i}"))
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"m{i}").alias("missing"),
                F.col(f"b{i}").alias("unparseable"),
            )
        )
    if malformed is not None:
        counts.append(F.count(malformed).alias("malformed"))
        rows.append(
            F.struct(
                F.lit(malformed).alias("column"),
                F.lit(0).cast("bigint").alias("missing"),
                F.col("malformed").alias("unparseable"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))
