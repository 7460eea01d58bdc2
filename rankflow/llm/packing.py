"""Packing by powers of two: no sequence crosses documents, and none needs padding.

A document of n tokens is cut into full sequences and then into the binary digits of the rest,
largest first. Every piece is a sequence of its own; pieces of equal length share a bucket, and
:func:`batches` arranges each bucket in rectangles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.names import free_names
from rankflow.llm.token_ids import token_ids
from rankflow.operators.ordering import running_total

MAX_LENGTH = 2048
#: Tokens of a batch.
BATCH_TOKENS = 1 << 16


def piece_bounds(n: Column, max_length: int = MAX_LENGTH) -> Column:
    """Array of (start, length) that cuts ``n`` tokens without gaps."""
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    full = F.floor(n / max_length)
    piece = lambda start, length: F.struct(start.cast("bigint").alias("start"), F.lit(length).cast("bigint").alias("length"))
    whole = F.when(full > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), full - 1), lambda i: piece(i * max_length, max_length)))
    whole = F.coalesce(whole, F.array().cast("array<struct<start:bigint,length:bigint>>"))
    digits = [1 << k for k in range(max_length.bit_length() - 2, -1, -1)]
    rest = [F.when(n.bitwiseAND(F.lit(d)) > 0, piece(n - n % (2 * d), d)) for d in digits]
    return F.concat(whole, F.filter(F.array(*rest), lambda p: p.isNotNull())) if rest else whole


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    max_length: int = MAX_LENGTH,
) -> DataFrame:
    """One row for each sequence: id, start, length, ids (binary), doc_tokens, bucket, sequence_id, offset.

    ``bucket`` is the binary logarithm of the length; ``offset`` is 0, since a sequence holds one piece. A null or
    empty text is packed as its end token. Rows repeated with the same id are packed each. An empty table gives no
    rows. Nothing is shuffled: sequence ids are unique, ascending within a task's rows, not gapless.
    """
    rows = token_ids(docs, tokenizer, id_col, text_col, end_id)
    cut = F.transform(
        piece_bounds(F.col("n_tokens"), max_length),
        lambda p: F.struct(
            p["start"].alias("start"),
            p["length"].alias("length"),
            F.substring("ids", (p["start"] * 4 + 1).cast("int"), (p["length"] * 4).cast("int")).alias("ids"),
        ),
    )
    pieces = rows.select(id_col, F.col("n_tokens").alias("doc_tokens"), F.explode(cut).alias("piece"))
    return pieces.select(
        id_col,
        "piece.start",
        "piece.length",
        "piece.ids",
        "doc_tokens",
        F.log2("piece.length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )


def batches(pieces: DataFrame, id_col: str = "doc_id", tokens: int = BATCH_TOKENS, seed: int = 0) -> DataFrame:
    """``pieces`` of :func:`pack` with ``batch`` and ``place``: each batch is a rectangle of ``tokens`` ids from one bucket.

    A batch holds as many pieces of one length as fit (at least one); only the last of a bucket may hold fewer. Batches are
    numbered from 0 without gaps, shorter pieces first, and places within them as well. Within a bucket the order is a hash
    of id, start and ``seed``, so it depends on the rows alone; rows repeated whole are interchangeable. Pieces are
    shuffled once, by bucket and hash, and stored; offsets have one row for each partition and each bucket.
    """
    one, before, first, n, per, earlier = free_names(pieces, "one", "before", "first", "n", "per", "earlier")
    order = ["bucket", F.xxhash64(id_col, "start", F.lit(seed)), id_col, "start", F.crc32("ids"), "sequence_id"]
    ordered = running_total(pieces.withColumn(one, F.lit(1)), [F.col(c) if isinstance(c, str) else c for c in order], one, before)
    buckets = ordered.groupBy("bucket").agg(F.min(before).alias(first), F.count(F.lit(1)).alias(n))
    buckets = buckets.withColumn(per, F.greatest(F.floor(F.lit(tokens) / F.pow(F.lit(2), F.col("bucket"))), F.lit(1)))
    # as many rows as a length has bits
    lower = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn(earlier, F.coalesce(F.sum(F.ceil(F.col(n) / F.col(per))).over(lower), F.lit(0)))
    position = F.col(before) - F.col(first)
    placed = ordered.join(F.broadcast(buckets), "bucket")
    batch = (F.col(earlier) + F.floor(position / F.col(per))).cast("bigint").alias("batch")
    return placed.select(*pieces.columns, batch, (position % F.col(per)).cast("bigint").alias("place"))


def packed_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum of their ids in place of the ids."""
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
