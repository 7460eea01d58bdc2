"""Token files: ids in fixed-size blocks, transposed to planes and compressed plane by plane.

A dataset of token files is a folder of Parquet files whose rows are segments of one shard in order. A segment
holds whole documents: their ids and sizes, and the ids of all of them in blocks of ``BLOCK`` ids. Each block is turned
into planes (the k-th byte, or the k-th bit, of every id), each plane is compressed by zstandard, and ``index``
holds where each plane ends, so that a block can be read alone. Shards follow each other in the order of
document ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from rankflow.llm.token_ids import encoder, slices

BLOCK = 1 << 16
SEGMENT = 1 << 18
LEVEL = 3

SEGMENTS = pa.schema(
    {
        "shard": pa.int32(),
        "segment": pa.int32(),
        "first": pa.int64(),
        "n_ids": pa.int64(),
        "planes": pa.string(),
        "block": pa.int32(),
        "doc_ids": pa.list_(pa.int64()),
        "doc_tokens": pa.list_(pa.int64()),
        "index": pa.list_(pa.int64()),
        "data": pa.binary(),
    }
)


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """Byte planes (4) or bit planes (32) of unsigned 32-bit ids, least significant first."""
    table = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [np.ascontiguousarray(table[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(table, axis=1, bitorder="little")
    return [row.tobytes() for row in np.packbits(bits.T, axis=1, bitorder="little")]


def from_planes(parts: list[bytes], n: int, planes: str) -> np.ndarray:
    if planes == "byte":
        table = np.empty((n, 4), dtype=np.uint8)
        for k, part in enumerate(parts):
            table[:, k] = np.frombuffer(part, dtype=np.uint8)
    else:
        packed = np.frombuffer(b"".join(parts), dtype=np.uint8).reshape(32, -1)
        bits = np.unpackbits(packed, axis=1, count=n, bitorder="little")
        table = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return table.reshape(-1).view("<u4")


def encode_segment(ids: np.ndarray, planes: str = "byte", block: int = BLOCK, level: int = LEVEL) -> tuple[list[int], bytes]:
    press = zstandard.ZstdCompressor(level=level)
    parts = [press.compress(p) for first in range(0, len(ids), block) for p in to_planes(ids[first : first + block], planes)]
    return np.cumsum([len(p) for p in parts], dtype=np.int64).tolist(), b"".join(parts)


def decode_block(number: int, index: list[int], data: bytes, n_ids: int, planes: str = "byte", block: int = BLOCK) -> np.ndarray:
    """The ids of one block, reading only its planes."""
    each, n = (4 if planes == "byte" else 32), min(block, n_ids - number * block)
    ends = [0, *index][number * each : (number + 1) * each + 1]
    open_up = zstandard.ZstdDecompressor()
    return from_planes([open_up.decompress(data[a:b]) for a, b in zip(ends, ends[1:])], n, planes)


def decode_segment(index: list[int], data: bytes, n_ids: int, planes: str = "byte", block: int = BLOCK) -> np.ndarray:
    parts = [decode_block(k, index, data, n_ids, planes, block) for k in range(-(-n_ids // block))]
    return np.concatenate(parts) if parts else np.zeros(0, dtype="<u4")


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    planes: str = "byte",
    block: int = BLOCK,
    segment: int = SEGMENT,
    shards: int | None = None,
) -> None:
    """Write the token files of ``docs`` to the new folder ``path``, documents in ascending order of their ids.

    One shuffle of the texts by ranges of ids; each task encodes its range and writes one shard, of which it holds one
    segment at a time. A segment is closed when it has ``segment`` ids, at the end of a document. Null ids come
    first, equal ids in the order of their texts; a null or empty text is written as its end token.
    """
    if planes not in ("byte", "bit"):
        raise ValueError("planes must be 'byte' or 'bit'")
    tail = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(tokenizer).encode, TaskContext.get().partitionId()
        ids: list[int | None] = []
        made: list[bytes] = []
        number = first = held = 0

        def close() -> pa.RecordBatch:
            nonlocal number, first, held
            index, data = encode_segment(np.frombuffer(b"".join(made), dtype="<u4"), planes, block)
            row = [shard, number, first, held, planes, block, list(ids), [len(m) // 4 for m in made], index, data]
            number, first, held = number + 1, first + held, 0
            ids.clear()
            made.clear()
            return pa.RecordBatch.from_pydict({n: [v] for n, v in zip(SEGMENTS.names, row)}, SEGMENTS)

        for batch in batches:
            for part in slices(batch, 1):
                for doc_id, tokens in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    ids.append(doc_id)
                    made.append(tokens + tail)
                    held += len(tokens) // 4 + 1
                    if held >= segment:
                        yield close()
        if ids:
            yield close()

    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    made = ordered.mapInArrow(run, from_arrow_schema(SEGMENTS))
    made.write.option("compression", "uncompressed").parquet(path)


_PIECES = pa.schema({"doc_id": pa.int64(), "shard": pa.int32(), "before": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary()})


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of the files in ``path``: doc_id, start, n_tokens, ids (binary).

    ``start`` counts the ids of all documents before it. Totals of the shards (one row each) give their places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_segment(row["index"], row["data"], row["n_ids"], row["planes"], row["block"]).tobytes()
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - np.array(row["doc_tokens"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([row["shard"]] * len(ends), pa.int32()),
                        pa.array(starts + row["first"], pa.int64()),
                        pa.array(row["doc_tokens"], pa.int64()),
                        pa.array([ids[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary()),
                    ],
                    schema=_PIECES,
                )

    segments = spark.read.schema(from_arrow_schema(SEGMENTS)).parquet(path)
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select("shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("place"))
    # each segment takes its place before it is decoded, so that no ids are shuffled
    placed = segments.join(places, "shard").withColumn("first", F.col("first") + F.col("place"))
    pieces = placed.select(*SEGMENTS.names).mapInArrow(run, from_arrow_schema(_PIECES))
    return pieces.select("doc_id", F.col("before").alias("start"), "n_tokens", "ids")
