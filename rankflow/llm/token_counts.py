"""Token counts of whole texts; long texts are encoded in overlapping chunks and spliced.

A place between two characters is stable when no piece of the vocabulary contains these two
characters in a row: no merge can ever span it, so both sides are encoded alike in every text that
contains the place. Chunks of a long text overlap; an overlap is widened until it contains a stable
place (at the latest, at the end of the text). Each chunk is encoded on its own, on any executor, and
reports the boundaries of its tokens inside its overlaps, with their byte offsets in the text. Two
neighbours are spliced at a stable boundary that both report; a pair without one is an error, never a guess.

This holds for byte-pair models whose normalization leaves texts as they are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

CHUNK = 1 << 14
OVERLAP = 1 << 8
LIMIT = 4096


class PieceModel:
    """A sentencepiece model and the pairs of characters inside its pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        probe = "  ﬁ①  é\t Ａ\n "
        if self.model.decode(self.model.encode(probe)).strip(" ") != probe.strip(" "):
            raise ValueError("this model changes texts before it encodes them")
        self.inside: set[tuple[str, str]] = set()
        for number in range(self.model.get_piece_size()):
            if self.model.is_byte(number) or self.model.is_control(number) or self.model.is_unknown(number):
                continue
            piece = self.model.id_to_piece(number).replace("▁", " ")
            self.inside.update(zip(piece, piece[1:]))

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def stable(self, data: bytes, start: int, end: int) -> list[int]:
        """Stable places in ``data`` from ``start`` (exclusive) to ``end``, both on character bounds."""
        text = data[start:end].decode()
        place, found = start, []
        for a, b in zip(text, text[1:]):
            place += len(a.encode())
            if (a.replace("▁", " "), b.replace("▁", " ")) not in self.inside:
                found.append(place)
        return found

    def ends(self, text: str) -> list[int]:
        """Byte offsets at which the tokens of ``text`` end, in order."""
        return [piece.end for piece in self.model.encode(text, return_type="proto").pieces]


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One for each worker process and file, kept between tasks."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _character(data: bytes, place: int) -> int:
    """The first character bound at or after ``place``."""
    while place < len(data) and data[place] & 0xC0 == 0x80:
        place += 1
    return min(place, len(data))


def chunk_bounds(model: PieceModel, data: bytes, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, end of the overlap with the chunk before, end) of each chunk.

    Where an overlap holds no stable place it is doubled; where none follows, the chunk runs to the end.
    """
    bounds, start, left = [], 0, 0
    while True:
        cut, width = _character(data, start + chunk), overlap
        while True:
            end = _character(data, cut + width)
            if end >= len(data) or model.stable(data, cut, end):
                break
            width *= 2
        bounds.append((start, left, end))
        if end >= len(data):
            return bounds
        start, left = cut, end


_CHUNKS = pa.schema({"n_bytes": pa.int64(), "part": pa.int32(), "start": pa.int64(), "left": pa.int64(), "right": pa.int64(), "text": pa.large_binary()})
_ENCODED = pa.schema(
    {
        "row": pa.int64(), "doc_id": pa.int64(), "n_bytes": pa.int64(), "part": pa.int32(), "n_tokens": pa.int64(),
        "left_places": pa.list_(pa.int64()), "left_before": pa.list_(pa.int64()),
        "right_places": pa.list_(pa.int64()), "right_before": pa.list_(pa.int64()),
    }
)


def _cut(rows: DataFrame, model_path: str, chunk: int, overlap: int) -> DataFrame:
    """One row for each chunk of each row (row, doc_id, text)."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), *_CHUNKS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = text.encode()
                bounds = chunk_bounds(model, data, chunk, overlap)
                for first in range(0, len(bounds), 256):
                    part = bounds[first : first + 256]
                    rights = [bounds[i + 1][0] if i + 1 < len(bounds) else len(data) for i in range(first, first + len(part))]
                    columns = [
                        [row] * len(part), [doc_id] * len(part), [len(data)] * len(part), range(first, first + len(part)),
                        [b[0] for b in part], [b[1] for b in part], rights, [data[b[0] : b[2]] for b in part],
                    ]
                    yield pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, columns))), schema)

    return rows.mapInArrow(run, from_arrow_schema(schema))


def _encode(chunks: DataFrame, model_path: str) -> DataFrame:
    """Tokens of each chunk, and before each stable boundary in its overlaps (places in the whole text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in _ENCODED.names}
            for c in batch.to_pylist():
                data, start = c["text"], c["start"]
                ends = model.ends(data.decode())
                for name in ("row", "doc_id", "n_bytes", "part"):
                    out[name].append(c[name])
                out["n_tokens"].append(len(ends))
                for side, (a, b) in {"left": (0, c["left"] - start), "right": (c["right"] - start, len(data))}.items():
                    places, before = [], []
                    for place in model.stable(data, a, b) if b > a else []:
                        at = bisect_left(ends, place)
                        if at < len(ends) and ends[at] == place:
                            # the last of several tokens that end here (bytes of one character)
                            while at + 1 < len(ends) and ends[at + 1] == place:
                                at += 1
                            places.append(start + place)
                            before.append(at + 1)
                    out[f"{side}_places"].append(places)
                    out[f"{side}_before"].append(before)
            yield pa.RecordBatch.from_pydict(out, _ENCODED)

    return chunks.mapInArrow(run, from_arrow_schema(_ENCODED))


def _spliced(encoded: DataFrame) -> DataFrame:
    """Tokens of each row: of each chunk, those between its splices with its neighbours."""
    order = Window.partitionBy("row").orderBy("part")
    rows = encoded.withColumn("next", F.lead(F.struct("left_places", "left_before")).over(order))
    common = F.array_min(F.array_intersect("right_places", "next.left_places"))
    rows = rows.withColumn("splice", common)
    at = lambda places, before: F.element_at(before, F.array_position(places, F.col("splice")).cast("int"))
    rows = rows.withColumn(
        "kept",
        F.when(F.col("next").isNull(), F.col("n_tokens"))
        .when(F.col("splice").isNull(), F.raise_error(F.concat(F.lit("chunks do not meet in row "), F.col("row").cast("string"))).cast("bigint"))
        .otherwise(at(F.col("right_places"), F.col("right_before"))),
    )
    rows = rows.withColumn("skipped", F.when(F.col("splice").isNotNull(), at(F.col("next.left_places"), F.col("next.left_before"))).otherwise(F.lit(0)))
    return rows.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.sum(F.col("kept") - F.col("skipped")).alias("n_tokens")
    )


def count_tokens(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    ``model_path`` is a sentencepiece model that every executor can open. Texts above ``chunk`` bytes are cut and their
    chunks spread over the executors; the others are encoded whole, where they are read. A null or empty text has
    no tokens; null and repeated ids stay as they are; an empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                counts = pa.array(model.counts(part.column(2).to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), counts], ["doc_id", "n_bytes", "n_tokens"])

    short = rows.where(F.col("n_bytes") <= chunk).select("doc_id", "n_bytes", "text")
    short = short.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    long = rows.where(F.col("n_bytes") > chunk)
    long = long.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    chunks = _cut(long, model_path, chunk, overlap).repartition("row", "part")
    long = _spliced(_encode(chunks, model_path)).select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)
