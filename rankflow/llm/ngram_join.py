"""Similarity join of documents on word n-grams: MinHash bands propose pairs, full sets decide.

Texts with equal n-gram sets form a class and are joined once. The bands of the classes are
shuffled by their hashes; classes that meet in a band, directly or through others, form a cluster. All
pairs within a cluster whose sizes admit a link are verified on the full sets, block against block inside tasks: what leaves a
task is a number of links for each class and a spanning forest, never the pairs. So a large group of
near copies costs its pairs in arithmetic, not in rows, and no link is left out or capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.components import connected_components
from rankflow.llm.names import free_names
from rankflow.llm.words import WIDTH, blocks, hashed_shingles, mix, shingle_sets
from rankflow.llm.workers import lean
from rankflow.operators.joins import join_ranked
from rankflow.sources.workspace import stored

THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 1152
#: Classes, and shingles, of a block; a task compares two blocks at a time.
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 20
_BLOCK_BITS = 40
_SEED = 20240917


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows, so the fewest chance pairs, with ``recall`` of pairs at ``threshold``."""
    fitting = []
    for rows in range(1, max_hashes + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))) if threshold < 1 else 1
        if bands * rows > max_hashes:
            break
        fitting.append((bands, rows))
    if not fitting:
        raise ValueError("max_hashes is too small for this recall")
    return fitting[-1]


def band_hashes(hashes: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One row of ``bands`` keys for each set; ``hashes[starts[i]:starts[i + 1]]`` is set i, none empty."""
    rng = np.random.default_rng(_SEED)
    factors = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    values = (hashes >> np.uint64(20)).astype(np.uint32)
    keys = np.zeros((len(starts) - 1, bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(starts) - 1, band + 1, dtype=np.uint64)
        for i in range(band * rows, (band + 1) * rows):
            least = np.minimum.reduceat(values * factors[i] + shifts[i], starts[:-1])
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
        keys[:, band] = key >> np.uint64(1)
    return keys


_SIGNATURE = pa.schema(
    {"doc_id": pa.int64(), "mark": pa.int64(), "n": pa.int64(), "set_a": pa.int64(), "set_b": pa.int64(), "bands": pa.list_(pa.int64())}
)


def _signatures(rows: DataFrame, bands: int, keep: int, width: int) -> DataFrame:
    """doc_id, mark, n (distinct shingles), a 126-bit digest of the set, its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for block in blocks(batch.column(2)):
                part = batch.slice(first, len(block))
                first += len(block)
                hashes, starts = hashed_shingles(block, width)
                sets = [np.unique(hashes[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                n = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(n)
                digests = np.zeros((2, len(sets)), dtype=np.uint64)
                keys: list = [[]] * len(sets)
                if len(full):
                    flat = np.concatenate(sets)
                    ends = np.concatenate([[0], np.cumsum(n[full])])
                    for k in range(2):
                        digests[k, full] = np.add.reduceat(mix(flat + np.uint64(k + 1)), ends[:-1])
                    for i, row in zip(full.tolist(), band_hashes(flat, ends, bands, keep).astype(np.int64)):
                        keys[i] = row
                set_a, set_b = ((d >> np.uint64(1)).astype(np.int64) for d in digests)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), pa.array(set_a), pa.array(set_b), pa.array(keys, pa.list_(pa.int64()))],
                    schema=_SIGNATURE,
                )

    schema = "doc_id bigint, mark bigint, n bigint, set_a bigint, set_b bigint, bands array<bigint>"
    return rows.mapInArrow(lean(run), schema)


def _sets(rows: DataFrame, width: int) -> DataFrame:
    """node, class_size, and the full set of shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for block in blocks(batch.column(2)):
                part = batch.slice(first, len(block))
                first += len(block)
                sets = [s.astype(np.int64) for s in shingle_sets(block, width)]
                columns = [part.column(0), part.column(1), pa.array(sets, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "class_size", "shingles"])

    return rows.select("node", "class_size", "text").mapInArrow(lean(run), "node bigint, class_size bigint, shingles array<bigint>")


def _addressed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _clusters(signed: DataFrame, leaders: DataFrame) -> DataFrame:
    """node, root of each class that meets another in a band. Each bucket becomes a star, not its pairs."""
    banded = signed.join(leaders, "node", "left_semi").select("node", F.explode("bands").alias("key"))
    centres = banded.groupBy("key").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = join_ranked(banded, centres, ["key"], "inner").where("node <> centre")
    return connected_components(stars.select("node", "centre"), "node", "centre")


def _blocks(sets: Column, shingles: Column) -> Column:
    """Number of blocks that hold so many sets with so many shingles in all."""
    return F.greatest(F.ceil(sets / BLOCK_SETS), F.ceil(shingles / BLOCK_SHINGLES)).cast("bigint")


def _block_pairs(clusters: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Each class once for each pair of blocks it is verified in: root, i, j, block, node, size, shingles.

    A cluster is dealt over blocks of about ``BLOCK_SETS`` classes or ``BLOCK_SHINGLES`` shingles; one of one block gives one
    pair. In larger ones a level spans a little more than the ratio of sizes that the threshold admits, so that links stay within
    a level or join two neighbouring ones: blocks further apart never meet. Within its level a class is dealt by a hash. A block's
    number holds the level above ``_BLOCK_BITS`` bits.
    """
    step = 1.001 * max(-math.log(threshold), 0.001)

    def level(size: Column) -> Column:
        return F.floor(F.log(size) / step).cast("bigint")

    sized = clusters.join(sets.select("node", F.size("shingles").alias("n")), "node")
    weights = sized.groupBy("root", level(F.col("n")).alias("level")).agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    # levels of a cluster are few: they grow with the logarithm of its longest text
    weights = weights.groupBy("root").agg(
        (_blocks(F.sum("sets"), F.sum("shingles")) == 1).alias("single"),
        F.map_from_entries(F.collect_list(F.struct("level", _blocks(F.col("sets"), F.col("shingles"))))).alias("levels"),
    )
    nought = F.lit(0).cast("bigint")
    one_block = F.create_map(nought, F.lit(1).cast("bigint"))
    weights = weights.withColumn("levels", F.when(F.col("single"), one_block).otherwise(F.col("levels")))

    rows = join_ranked(clusters.join(sets, "node"), weights, ["root"], "inner")
    own = F.when(F.col("single"), nought).otherwise(level(F.size("shingles")))
    rows = rows.withColumn("level", own)

    def numbers(at: Column) -> Column:
        first = F.shiftleft(at, _BLOCK_BITS)
        return F.sequence(first, first + F.col("levels")[at] - 1)

    near = F.filter(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1), lambda at: F.map_contains_key("levels", at))
    dealt = F.pmod(F.xxhash64("node"), F.col("levels")[F.col("level")])
    rows = rows.withColumn("block", F.shiftleft("level", _BLOCK_BITS) + dealt)
    rows = rows.withColumn("other", F.explode(F.flatten(F.transform(near, numbers))))
    pair = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    return rows.select("root", *pair, "block", "node", "class_size", "shingles")


_LINKED = pa.schema({"node": pa.int64(), "links": pa.int64(), "nearest": pa.int64()})


def count_links(
    pair: tuple[int, int], nodes: np.ndarray, sizes: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], threshold: float
) -> pa.RecordBatch:
    """Links between all sets of one block, or of one block to another (which may be empty), weighted by class sizes.

    One row for each set with a link: node, links, and the smallest node that its links lead to.
    """
    order = np.argsort(nodes)
    nodes, sizes, blocks, sets = nodes[order], sizes[order], blocks[order], [sets[i] for i in order]
    lengths = np.array([len(s) for s in sets])
    ends = np.cumsum(lengths)
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    left, right = (np.flatnonzero(blocks == block) for block in pair)
    if not len(left) or not len(right):
        return pa.RecordBatch.from_pylist([], _LINKED)
    coded = [codes[end - n : end] for end, n in zip(ends, lengths)]
    flat = np.concatenate([coded[b] for b in right])
    starts = np.cumsum(lengths[right]) - lengths[right]
    present = np.zeros(len(values), dtype=np.int32)
    links, group = np.zeros(len(nodes), dtype=np.int64), np.arange(len(nodes))
    for place, a in enumerate(left):
        present[coded[a]] = 1
        shared = np.add.reduceat(present[flat], starts)
        present[coded[a]] = 0
        near = shared / (lengths[a] + lengths[right] - shared) >= threshold
        if pair[0] == pair[1]:
            near[: place + 1] = False
        hits = right[near]
        if len(hits):
            links[a] += sizes[hits].sum()
            links[hits] += sizes[a]
            joined = np.unique(np.append(group[hits], group[a]))
            group[np.isin(group, joined)] = joined[0]
    linked = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(x[linked]) for x in (nodes, links, nodes[group])], schema=_LINKED)


def _linked(block_pairs: DataFrame, threshold: float) -> DataFrame:
    """The rows of :func:`count_links` for every pair of blocks; a task holds one pair of blocks at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def result() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            columns = [rows.column(c).to_numpy() for c in ("node", "class_size", "block")]
            lists = rows.column("shingles").combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            values, offsets = lists.flatten().to_numpy(), np.asarray(lists.value_lengths()).cumsum()
            # rows that repeat a node carry the same set
            _, first = np.unique(columns[0], return_index=True)
            sets = [values[(offsets[i - 1] if i else 0) : offsets[i]] for i in first.tolist()]
            return count_links(key[1:], *[c[first] for c in columns], sets, threshold)

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("root", "i", "j")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if held and tuple(keys[a]) != key:
                    yield result()
                    held = []
                if b > a:
                    key = tuple(keys[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield result()

    dealt = block_pairs.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    return dealt.mapInArrow(lean(run), "node bigint, links bigint, nearest bigint")


def similar_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    max_hashes: int = MAX_HASHES,
    width: int = WIDTH,
) -> tuple[DataFrame, DataFrame]:
    """Members and linked classes, both stored.

    Members: one row for each row of ``docs`` with doc_id, mark (hash of the text), node, n, class_node,
    class_size. Linked: node (of a class), links (rows of other classes at or above the threshold), nearest (a node
    of the same group). A class has one such row for each pair of blocks with a link. Texts without words are
    classes of their own without links.
    """
    bands, rows = choose_bands(threshold, recall, max_hashes)
    addressed = _addressed(docs, id_col, text_col)
    signed = _signatures(addressed, bands, rows, width).withColumn("node", F.monotonically_increasing_id())
    signed = stored(signed, "signatures")

    same = ["set_a", "set_b", "n"]
    narrow = signed.select("doc_id", "mark", "node", *same)
    classes = narrow.where("n > 0").groupBy(*same).agg(
        F.min("node").alias("class_node"), F.count(F.lit(1)).alias("class_size")
    )
    members = join_ranked(narrow, classes, same, "left").select(
        "doc_id", "mark", "node", "n",
        F.coalesce("class_node", "node").alias("class_node"),
        F.coalesce("class_size", F.lit(1).cast("bigint")).alias("class_size"),
    )
    members = stored(members, "members")
    leaders = members.where("node = class_node and n > 0")

    clusters = stored(_clusters(signed, leaders.select("node")), "clusters")
    wanted = clusters.join(leaders, "node").select("node", "class_size", F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
    here = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    sets = stored(_sets(addressed.join(wanted, here), width), "sets")
    return members, stored(_linked(_block_pairs(clusters, sets, threshold), threshold), "linked")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row for each row of ``docs``: its class, its group and its number of links.

    - ``class_id``: smallest id with the same n-gram set; ``class_size``: rows of the class.
    - ``group_id``: smallest id that links lead to, the row's own class included.
    - ``links``: other rows with a similarity of at least the threshold, copies counted each.
    - ``kept``: true for one row of each group, the one with the smallest id (null ids are smallest).
    - ``row_mark``: a hash of the text, telling rows with the same id apart.

    A null or empty text, or one of white space alone, is linked to nothing. Rows repeated whole are in one
    class; one of them is kept. An empty table gives no rows. Other columns are ignored.
    """
    members, linked = similar_classes(docs, id_col, text_col, **options)
    roots = connected_components(linked, "node", "nearest").select(F.col("node").alias("class_node"), "root")
    linked = linked.groupBy(F.col("node").alias("class_node")).agg(F.sum("links").alias("outside"))

    rows = members.join(linked, "class_node", "left").join(roots, "class_node", "left")
    rows = rows.withColumn("root", F.coalesce("root", "class_node"))
    rows = stored(rows, "rooted")
    row = F.struct("doc_id", "node")
    by_class = rows.groupBy("class_node").agg(F.min("doc_id").alias("class_id"))
    by_root = rows.groupBy("root").agg(F.min(row).alias("first"))
    rows = join_ranked(rows, by_class, ["class_node"], "inner")
    rows = join_ranked(rows, by_root, ["root"], "inner")
    return rows.select(
        "doc_id",
        "class_id",
        "class_size",
        F.col("first.doc_id").alias("group_id"),
        (F.col("class_size") - 1 + F.coalesce("outside", F.lit(0))).alias("links"),
        (F.col("node") == F.col("first.node")).alias("kept"),
        F.col("n").alias("n_shingles"),
        F.col("mark").alias("row_mark"),
    )


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of :func:`ngram_join`; columns stay as they are."""
    rows = ngram_join(docs, id_col, text_col, **options)
    kept_id, kept_mark, times = free_names(docs, "kept_id", "kept_mark", "times")
    kept = rows.groupBy(F.col("doc_id").alias(kept_id), F.col("row_mark").alias(kept_mark))
    kept = kept.agg(F.count(F.lit(1)).alias(times), F.max("kept").alias("stays")).where("stays").drop("stays")
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    here = F.col(id_col).cast("bigint").eqNullSafe(F.col(kept_id)) & (mark == F.col(kept_mark))
    left = docs.join(kept, here).drop(kept_id, kept_mark)
    single = left.where(F.col(times) == 1).drop(times)
    repeated = left.where(F.col(times) > 1).drop(times).dropDuplicates([id_col, text_col])
    return single.unionByName(repeated)
