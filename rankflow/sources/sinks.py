"""Writers. Output is always many files: no result passes through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.sources.readers import CSV_QUOTES


def write_csv(
    df: DataFrame, path: str, order_by: Sequence[str] = (), mode: str = "overwrite", header: bool = True
) -> None:
    """CSV that the readers of this package give back: doubled quotes, spaces and microseconds kept.

    A null is written as nothing, an empty string as a pair of quotes; both read back as null, as in files from elsewhere.

    With ``order_by`` the part files are sorted, and sorted among themselves by part number. Rows equal
    in these columns are told apart by a hash, so that many of them still fill several files.
    """
    if order_by:
        ranges = df.repartitionByRange(*order_by, F.xxhash64(*df.columns))
        df = ranges.sortWithinPartitions(*order_by)
    writer = df.write.mode(mode).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    writer.csv(
        path,
        header=header,
        timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        **CSV_QUOTES,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def head_sample(df: DataFrame, path: str, order_by: Sequence[Column | str], n: int = 1000) -> DataFrame:
    """The first ``n`` rows in the given order as a small stored table, made once and reused.

    Each task keeps only its own first ``n`` rows. Where ``path`` holds a whole table nothing is computed; one
    whose writing broke off is written again.
    """
    spark = df.sparkSession
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        write_parquet(df.orderBy(*order_by).limit(n), path)
    return spark.read.parquet(path)
