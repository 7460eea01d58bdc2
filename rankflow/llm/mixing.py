"""Mixing sources to target weights by a temperature.

The weight of a source is its share of all tokens raised to an exponent between 0 (all alike) and 1 (as they
are). The exponent is found by repeated section: flat enough for a target entropy, but not so flat that a
source repeats more often than the limit. The weights are then realised: each source passes through its
documents again and again, every pass a permutation of its own, until its budget is spent, and the stream of a
source is dealt evenly over blocks, so that every block holds the sources in their weights.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.names import free_names
from rankflow.sources.workspace import stored

#: Share of the greatest possible entropy, and passes over a source beyond which no weight may lead.
TARGET_ENTROPY, REPEAT_LIMIT = 0.95, 2.0
BLOCK_TOKENS = 1 << 20
#: Documents of a source that are put in order together.
BUCKET_ROWS = 4096
#: Uses of documents in a block, on average; blocks are cut by tokens and by this.
BLOCK_ROWS = 1 << 18
_SECTIONS, _ROUNDS = 16, 6
_PARTS = float(1 << 40)


def word_count(text: Column) -> Column:
    """Tokens for the shares: runs of characters other than white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


def _exact_sum(value: Column) -> Column:
    """A sum in whole parts of 2 ** -40, so that the order in which rows arrive changes nothing."""
    return F.coalesce(F.sum(F.round(value * _PARTS).cast("decimal(38,0)")), F.lit(0)).cast("double") / _PARTS


def _measures(sources: DataFrame, exponents: Sequence[float]) -> list[tuple[float, float]]:
    """Entropy and repetition at each exponent: one row of sums over the sources.

    Repetition compares the most and the least repeated source, since the budget gives the latter one pass.
    """
    shares = sources.where("tokens > 0").select(F.log(F.col("tokens") / F.col("all_tokens")).alias("l"))
    sums = [F.min("l"), F.max("l")]
    for a in exponents:
        sums += [_exact_sum(F.exp(a * F.col("l"))), _exact_sum(F.exp(a * F.col("l")) * F.col("l"))]
    low, high, *rest = shares.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    if low is None:
        return [(0.0, 1.0) for _ in exponents]
    found = []
    for a, z, zl in zip(exponents, rest[::2], rest[1::2]):
        found.append((math.log(z) - a * zl / z, math.exp((1 - a) * (high - low))))
    return found


def find_exponent(sources: DataFrame, target_entropy: float = TARGET_ENTROPY, repeat_limit: float = REPEAT_LIMIT) -> float:
    """The largest exponent up to 1 that reaches the target entropy, or the smallest that keeps the limit if that is larger.

    ``sources``: source, tokens, all_tokens. Both measures fall as the exponent grows, so a bracket shrinks by the
    number of sections in each round; the driver sees one row a round.
    """
    if repeat_limit < 1:
        raise ValueError("repeat_limit must be at least 1")
    count = sources.where("tokens > 0").count()
    wanted = target_entropy * math.log(count) if count else 0.0

    def narrowed(reached) -> float:
        """The border of ``reached``, which holds below it."""
        low, high = 0.0, 1.0
        if reached(_measures(sources, [1.0])[0]):
            return 1.0
        for _ in range(_ROUNDS):
            inner = [low + (high - low) * i / _SECTIONS for i in range(1, _SECTIONS)]
            held = sum(reached(m) for m in _measures(sources, inner))
            low, high = ([low, *inner][held], [*inner, high][held])
        return low

    flat = narrowed(lambda m: m[0] >= wanted - 1e-12)
    if _measures(sources, [flat])[0][1] <= repeat_limit:
        return flat
    # the last exponent over the limit lies below this one
    return narrowed(lambda m: m[1] > repeat_limit) + _SECTIONS**-float(_ROUNDS)


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    target_entropy: float = TARGET_ENTROPY,
    repeat_limit: float = REPEAT_LIMIT,
    budget_tokens: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    block_rows: int = BLOCK_ROWS,
    seed: int = 7,
) -> DataFrame:
    """One row for each time a row of ``docs`` is used.

    Columns: the id, source, n_tokens, weight (of the source), pass (from 0), block, position (in the block, from 0),
    row_mark (hash of the text). Without ``budget_tokens`` the budget is the smallest one that gives every
    source a whole pass, so that each row is used at least once. With it, a source whose part ends within a
    pass uses the rows that begin before the end.

    A null source counts as the empty name, a null text as empty. Rows without tokens cost nothing and are
    used once in each pass that comes to them; a source without tokens has weight 0 and one pass. Repeated rows are
    used each; equal ids are told apart by their text. The result depends on the rows alone, not on files or partitions. An empty
    table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        word_count(text).alias("n_tokens"),
        F.xxhash64(text).alias("row_mark"),
    )
    # rows that repeat are numbered by counting, so that nothing depends on where they lie
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).drop("copies")
    rows = stored(rows, "mix-rows")
    sources = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    total = rows.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    sources = stored(sources.withColumn("all_tokens", F.lit(total).cast("bigint")), "mix-sources")
    exponent = find_exponent(sources, target_entropy, repeat_limit)

    share = F.col("tokens") / F.greatest("all_tokens", F.lit(1))
    power = F.when(F.col("tokens") > 0, F.pow(share, F.lit(exponent))).otherwise(F.lit(0.0))
    norm, need = sources.agg(_exact_sum(power), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / power))).first()
    budget = float(budget_tokens) if budget_tokens is not None else (need or 0.0) * (norm or 0.0)
    weight = power / (norm or 1.0)
    # a source that needs exactly one pass must not fall short of it by rounding
    spend = F.greatest(weight * budget, F.col("tokens").cast("double")) if budget_tokens is None else weight * budget
    passes = F.when(F.col("tokens") > 0, F.floor(spend / F.col("tokens"))).otherwise(F.lit(1))
    plan = sources.select(
        "source", "tokens", "docs", weight.alias("weight"), spend.alias("spend"), passes.cast("bigint").alias("passes"),
        F.greatest(F.ceil(F.col("docs") / BUCKET_ROWS), F.lit(1)).alias("buckets"),
    )

    used = rows.join(plan, "source").withColumn("pass", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("passes"))))
    # a uniform number for each row and pass; the row tells repeated rows apart
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_id", "row_mark", "row", "pass"), 12) / F.lit(float(1 << 52))
    used = used.withColumn("draw", draw).withColumn("bucket", F.floor(F.col("draw") * F.col("buckets")))
    keys = ["source", "pass", "bucket"]
    inside = Window.partitionBy(*keys).orderBy("draw", "_id", "row_mark", "row").rowsBetween(Window.unboundedPreceding, -1)
    used = used.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    totals = used.groupBy(*keys).agg(F.sum("n_tokens").alias("bucket_tokens"))
    earlier = Window.partitionBy("source", "pass").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, F.coalesce(F.sum("bucket_tokens").over(earlier), F.lit(0)).alias("earlier"))
    used = used.join(totals, keys).withColumn("place", F.col("pass") * F.col("tokens") + F.col("earlier") + F.col("inside"))
    used = used.where((F.col("pass") < F.col("passes")) | ((F.col("tokens") > 0) & (F.col("place") < F.col("spend"))))

    rows_used = plan.agg(F.sum(F.col("docs") * F.greatest(F.ceil(F.col("spend") / F.greatest("tokens", F.lit(1))), F.lit(1)))).first()[0] or 0
    blocks = max(1, math.ceil(budget / block_tokens), math.ceil(rows_used / block_rows))
    part = F.when(F.col("tokens") > 0, F.col("place") / F.col("spend")).otherwise(F.col("draw"))
    used = used.withColumn("block", F.least(F.floor(part * blocks), F.lit(blocks - 1)).cast("bigint"))
    shuffled = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 1), "draw"), "source", "_id", "row_mark", "row", "pass")
    return used.select(
        F.col("_id").alias(id_col), "source", "n_tokens", "weight", "pass", "block",
        (F.row_number().over(shuffled) - 1).alias("position"), "row_mark",
    )


def repeat_mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each row as often as :func:`mix_sources` uses it; columns stay as they are.

    Rows repeated with the same id and text are used as often as all of them together.
    """
    used_id, used_mark, times, held, again = free_names(docs, "used_id", "used_mark", "times", "held", "again")
    used = mix_sources(docs, id_col, text_col, **options).groupBy(F.col(id_col).alias(used_id), F.col("row_mark").alias(used_mark))
    used = used.agg(F.count(F.lit(1)).alias(times), F.count_if(F.col("pass") == 0).alias(held))
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    here = F.col(id_col).eqNullSafe(F.col(used_id)) & (mark == F.col(used_mark))
    rows = docs.join(used, here).drop(used_id, used_mark)
    single = rows.where(F.col(held) <= 1)
    repeated = rows.where(F.col(held) > 1).dropDuplicates([id_col, text_col])
    both = single.unionByName(repeated).withColumn(again, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times))))
    return both.drop(times, held, again)
