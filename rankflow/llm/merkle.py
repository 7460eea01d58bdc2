"""Merkle manifest of a table: a digest for each row, a tree for each group, and a tree over the groups' roots.

Rows are ranked within their group. The digits of the rank are grouped away one after the other, lowest first: the
children of a run become one struct that holds their digests, level by level, and the structs below. That goes on
within blocks of ``2 ** BLOCK_BITS`` rows, which bounds a struct; the digests of the blocks are the rows of the next tier, down
to one node for each group. Then the way back: each tier's blocks meet what stands above them (a union and a grouping by
block), and transform and explode write the proof of each child. No join takes part in that.

A proof is an array of steps from the leaf to the root, each with the digest that goes left and the one that goes right of what
has been folded so far; both are empty where a run has one member.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.sources.workspace import stored

#: Levels of the tree that one digit of a rank stands for, and digits grouped away within a block.
DIGIT_BITS = 5
DIGITS = 2
BLOCK_BITS = DIGIT_BITS * DIGITS

#: How far ``monotonically_increasing_id`` shifts the number of a partition.
_PART_BITS = 33


def row_digest(columns: Sequence[Column]) -> Column:
    """Digest of values: ``-`` for a null, else the number of UTF-8 bytes, ``:`` and the value as text."""

    def spelled(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[spelled(c) for c in columns]), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its proof lead to."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def _levels(nodes: Column, bits: Column) -> Column:
    """The digests of a run, then those of their parents, and so on for ``bits`` levels."""

    def parents(level: Column) -> Column:
        pairs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int"))
        return F.transform(pairs, lambda i: F.sha2(F.concat(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit(""))), 256))

    steps = F.slice(F.sequence(F.lit(1), F.lit(DIGIT_BITS)), F.lit(1), bits)
    return F.aggregate(steps, F.array(nodes), lambda levels, _: F.concat(levels, F.array(parents(F.element_at(levels, -1)))))


def _steps(levels: str, digit: str) -> Column:
    """The proof of a child of a run, up to the run's own digest."""

    def step(level: Column, i: Column) -> Column:
        place = F.floor(F.col(digit) / F.pow(F.lit(2.0), i)).cast("int")
        right = place % 2 == 1
        sibling = F.coalesce(F.get(level, F.when(right, place - 1).otherwise(place + 1)), F.lit(""))
        return F.struct(F.when(right, sibling).otherwise("").alias("left"), F.when(right, F.lit("")).otherwise(sibling).alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), step)


def _numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``rank`` (from 0) and ``height`` of the tree in their ``group``. No group meets in a task.

    Rows are sorted over the whole table. Where a partition begins within a group is a sum of counts, one for each group
    and partition.
    """
    by = [F.asc_nulls_first(c) for c in ("group", *order)]
    ranged = nodes.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stored(ranged.withColumn("place", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("part", F.shiftright("place", _PART_BITS))
    counts = placed.groupBy("group", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("begin"))
    same = Window.partitionBy("group")
    earlier = F.sum("n").over(same.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("n").over(same)
    height = F.when(total > 1, F.length(F.bin(total - 1))).otherwise(0)
    shifts = counts.select(
        F.col("group").alias("_group"), F.col("part").alias("_part"), (F.coalesce(earlier, F.lit(0)) - F.col("begin")).alias("shift"), height.alias("height")
    )
    there = placed["group"].eqNullSafe(shifts["_group"]) & (placed["part"] == shifts["_part"])
    return placed.join(shifts, there).withColumn("rank", F.col("place") + F.col("shift")).drop("_group", "_part", "part", "place", "shift")


def _rolled(nodes: DataFrame, tier: int) -> DataFrame:
    """group, height, block, node, run: the rows of ``nodes`` (group, height, rank, node, member), a block in one struct."""
    digits = [F.shiftright("rank", DIGIT_BITS * i).bitwiseAND(2**DIGIT_BITS - 1).cast("int").alias(f"d{i}") for i in range(DIGITS)]
    block = F.shiftright("rank", BLOCK_BITS).alias("block")
    # a block's rows come together once; the groupings below find them so
    rows = nodes.select("group", "height", block, *digits, "node", F.struct("member").alias("below")).repartition("group", "block")
    for i in range(DIGITS):
        keys = ["group", "height", "block", *[f"d{j}" for j in range(i + 1, DIGITS)]]
        children = F.sort_array(F.collect_list(F.struct(F.col(f"d{i}").alias("digit"), "node", "below")))
        bits = F.least(F.greatest(F.col("height") - DIGIT_BITS * (DIGITS * tier + i), F.lit(0)), F.lit(DIGIT_BITS))
        runs = rows.groupBy(*keys).agg(children.alias("children"))
        runs = runs.withColumn("levels", _levels(F.col("children.node"), bits))
        rest = F.transform("children", lambda c: F.struct(c["digit"].alias("digit"), c["below"].alias("below")))
        rows = runs.select(*keys, F.get(F.element_at("levels", -1), F.lit(0)).alias("node"), F.struct("levels", rest.alias("children")).alias("below"))
    return rows.withColumnRenamed("below", "run")


def _climbed(nodes: DataFrame) -> list[DataFrame]:
    """The tiers over ``nodes``, lowest first; the last one has one block for each group."""
    tallest = nodes.agg(F.max("height")).first()[0] or 0
    tiers: list[DataFrame] = []
    for tier in range(max(1, -(-tallest // BLOCK_BITS))):
        if tiers:
            nodes = tiers[-1].select("group", "height", F.col("block").alias("rank"), "node", F.lit(None).cast("int").alias("member"))
        tiers.append(stored(_rolled(nodes, tier), "merkle-tier"))
    return tiers


def _descended(tiers: Sequence[DataFrame], above: DataFrame) -> DataFrame:
    """group, rank, member, above of each row below ``tiers``. ``above`` has group, block and above (root, subroot, path)."""
    for tier in reversed(tiers):
        blocks = tier.select("group", "block", "run", F.lit(None).cast(above.schema["above"].dataType).alias("above"))
        tops = above.select("group", "block", F.lit(None).cast(tier.schema["run"].dataType).alias("run"), "above")
        met = blocks.unionByName(tops).groupBy("group", "block")
        rows = met.agg(F.first("run", True).alias("below"), F.first("above", True).alias("above"))
        rows = rows.select("group", F.col("block").alias("rank"), "below", "above")
        for _ in range(DIGITS):
            rows = rows.select("group", "rank", "above", F.col("below.levels").alias("levels"), F.explode("below.children").alias("child"))
            rows = rows.select("group", "rank", "above", "levels", F.col("child.digit").alias("digit"), F.col("child.below").alias("below"))
            path = F.concat(_steps("levels", "digit"), "above.path").alias("path")
            rows = rows.select(
                "group", (F.col("rank") * 2**DIGIT_BITS + F.col("digit")).alias("rank"), "below",
                F.struct("above.root", "above.subroot", path).alias("above"),
            )
        rows = rows.select("group", "rank", F.col("below.member").alias("member"), "above")
        above = rows.select("group", F.col("rank").alias("block"), "above")
    return rows


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: the id, leaf, subroot, root, path, and a struct ``carried`` with what ``carry`` names.

    A leaf is :func:`row_digest` of ``columns``. The leaves of a group stand in the order of the id (null first; rows with
    the same id by leaf, so that the order never depends on the files), the groups in that of their bytes, null first. Each two
    consecutive nodes become one, a single last one as well, until one is left; a group of one row has the leaf as its
    subroot. Equal rows have leaves of their own, and equal proofs only where their places have. An empty table gives no
    rows; columns that are not named are ignored.
    """
    carried = F.struct(*[c.alias(n) for n, c in (carry or {}).items()]) if carry else F.struct(F.lit(None).cast("int").alias("none"))
    leaf = row_digest([F.col(c) for c in columns])
    rows = docs.select(F.col(group_col).alias("group"), F.col(id_col).alias("id"), leaf.alias("node"), carried.alias("carried"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    # the last column tells equal rows apart, which are alike in all else: it spreads them, and changes no result
    ranked = _numbered(rows, ["id", "node", "row"])
    tiers = _climbed(ranked.select("group", "height", "rank", "node", F.struct("id", "node", "carried").alias("member")))

    subroots = tiers[-1].select("group", "node")
    tops = _numbered(subroots.select(F.lit(0).alias("group"), F.col("group").alias("name"), "node"), ["name"])
    over = _climbed(tops.select("group", "height", "rank", "node", F.struct("name", "node").alias("member")))
    nothing = F.array().cast("array<struct<left:string,right:string>>").alias("path")
    root = over[-1].select("group", "block", F.struct(F.col("node").alias("root"), F.col("node").alias("subroot"), nothing).alias("above"))
    found = _descended(over, root)
    above = found.select(
        F.col("member.name").alias("group"), F.lit(0).cast("bigint").alias("block"),
        F.struct("above.root", F.col("member.node").alias("subroot"), "above.path").alias("above"),
    )

    proved = _descended(tiers, above)
    return proved.select(
        F.col("member.id").alias(id_col), F.col("member.node").alias("leaf"), "above.subroot", "above.root", "above.path",
        F.col("member.carried").alias("carried"),
    )


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """Proofs of ``documents``, and what they say of a table in which some ``n_chars`` are one too high.

    Where 7 divides the CRC-32 of the id's digits, the folded root starts from the changed row's leaf; a null id or a null
    ``n_chars`` changes nothing.
    """
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    after = row_digest([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars").cast("bigint") + 1, F.col("text")])
    proved = merkle_manifest(docs, carry={"after": F.when(changed, after)})
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    seen = proved.withColumn("folded_root", folded(F.coalesce("carried.after", "leaf"), F.col("path")))
    return seen.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
