"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the ``k`` smallest distinct hashes of the shingles of a text. The sketch of
several parts is the ``k`` smallest of their sketches together. Two sketches estimate resemblance,
containment and the number of distinct shingles; below ``k`` shingles all three are exact.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from rankflow.llm.words import WIDTH, shingle_sets

K = 128
_RANGE = float(1 << 63)
_LOWEST = -(1 << 63)


# --- in tasks: sorted numpy arrays --------------------------------------------------------------


def sketches(texts: pa.Array, k: int = K, width: int = WIDTH) -> list[np.ndarray]:
    return [hashes[:k].copy() for hashes in shingle_sets(texts, width)]


def likeness(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated resemblance; 1 for two texts without words, 0 when only one has none."""
    both = np.concatenate([a, b])
    both.sort()
    again = np.zeros(len(both), dtype=bool)
    again[1:] = both[1:] == both[:-1]
    distinct = min(k, len(both) - int(again.sum()))
    if distinct == 0:
        return 1.0
    # the place of the k-th distinct value, with its repeat
    limit = both[np.flatnonzero(~again)[distinct - 1]]
    return int(again[both <= limit].sum()) / distinct


def as_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


# --- as columns: arrays of bigint ------------------------------------------------------------------


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, width: int = WIDTH
) -> DataFrame:
    """The id and ``sketch`` (sorted array of bigint) of each row; a null text counts as empty, with an empty sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [s.astype(np.int64) for s in sketches(batch.column(1), k, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int64()))], [id_col, "sketch"])

    rows = docs.select(id_col, F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, sketch array<bigint>")


def merge_sketches(parts: DataFrame, keys: Sequence[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each key. Each task keeps at most ``k`` values of a key before the shuffle."""
    values = parts.select(*keys, F.explode_outer(sketch).alias("_value")).distinct()
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("_value"))
    least = values.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    return least.groupBy(*keys).agg(F.array_sort(F.collect_list("_value")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.size(union))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    full = (k - 1) * F.lit(_RANGE) / F.element_at(sketch, -1).cast("double")
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(full)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has, from 0 to 1; 1 where ``a`` has none."""
    j, n = resemblance(a, b, k), distinct_shingles(a, k)
    shared = j / (1 + j) * (n + distinct_shingles(b, k))
    return F.when(n == 0, F.lit(1.0)).otherwise(F.least(shared / n, F.lit(1.0)))


# --- each document against the next one ---------------------------------------------------------------


def _in_order(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """Rows ordered by id within ranges of ids; each range ends with a copy of the first row of the following one.

    Ranges come from quantiles of the ids; what the driver sees is one id for each range. The last range is
    followed by the first. Null ids come first, equal ids in the order of their texts.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LOWEST)).alias("key"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    steps = [i / parts for i in range(1, parts)] or [0.5]
    quantiles = rows.agg(F.percentile_approx("key", steps, 10 * max(1000, parts))).first()[0]
    bounds = F.array(*[F.lit(b).cast("bigint") for b in sorted(set(quantiles or [0]))])
    rows = rows.withColumn("range", F.size(F.filter(bounds, lambda b: b <= F.col("key"))))
    firsts = sorted(map(tuple, rows.groupBy("range").agg(F.min("key")).collect()))
    follow = [(firsts[i][1], firsts[i - 1][0]) for i in range(len(firsts))]
    ahead = spark.createDataFrame(follow, "key bigint, into int")
    heads = rows.select("key", "doc_id", "text").join(F.broadcast(ahead), "key")
    heads = heads.groupBy("into").agg(F.min(F.struct("text", "key", "doc_id")).alias("head"))
    heads = heads.select("head.key", "head.doc_id", "head.text", F.col("into").alias("range"), F.lit(True).alias("ahead"))
    return (
        rows.withColumn("ahead", F.lit(False))
        .unionByName(heads)
        .repartitionByRange(parts, "range")
        .sortWithinPartitions("range", "ahead", "key", "text")
    )


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


NEIGHBOUR_SCHEMA = pa.schema(
    {
        "doc_id": pa.int64(),
        "n_chars": pa.int64(),
        "edited_sha256": pa.string(),
        "fingerprint": pa.string(),
        "edited_fingerprint": pa.string(),
        "near_edited": pa.float64(),
        "near_next": pa.float64(),
    }
)


def compare_with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, width: int = WIDTH
) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness to each other and to the next text.

    One shuffle of the texts by ranges of ids; each task then runs through its rows in order. A null text
    counts as empty; repeated ids follow each other; a single row is its own next; an empty table gives no rows.
    """
    def finish(rows: list[tuple], following: list[tuple]) -> dict[str, list]:
        changed = [edited(row[1], after[1]) for row, after in zip(rows, following)]
        new = sketches(pa.array(changed, pa.large_string()), k, width)
        columns = [
            [row[0] for row in rows],
            [len(row[1]) for row in rows],
            [hashlib.sha256(text.encode()).hexdigest() for text in changed],
            [as_text(row[2]) for row in rows],
            [as_text(sketch) for sketch in new],
            [likeness(row[2], sketch, k) for row, sketch in zip(rows, new)],
            [likeness(row[2], after[2], k) for row, after in zip(rows, following)],
        ]
        return dict(zip(NEIGHBOUR_SCHEMA.names, columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for batch in batches:
            for piece in pieces(batch):
                ids, texts, ahead = (piece.column(i).to_pylist() for i in range(3))
                waiting += zip(ids, texts, sketches(piece.column(1), k, width), ahead)
                pairs = [(a, b) for a, b in zip(waiting, waiting[1:]) if not a[3]]
                waiting = waiting[-1:]
                if pairs:
                    yield pa.RecordBatch.from_pydict(finish([a for a, _ in pairs], [b for _, b in pairs]), NEIGHBOUR_SCHEMA)

    def pieces(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = _in_order(docs, id_col, text_col, parts).select("doc_id", "text", "ahead")
    return ordered.mapInArrow(run, from_arrow_schema(NEIGHBOUR_SCHEMA))
