import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rankflow.llm import mixing
from rankflow.llm.mixing import mix_sources, repeat_mixed
from tests.conftest import TESTDATA

SCHEMA = "doc_id bigint, text string, source string, weight int, tokens int, row int"


def brute_exponent(tokens, target, limit):
    total = sum(tokens)
    shares = [t / total for t in tokens if t]

    def entropy(a):
        z = sum(p**a for p in shares)
        return -sum(p**a / z * math.log(p**a / z) for p in shares)

    def bisect(holds):
        """Largest exponent at which ``holds``, which holds from 0 on."""
        low, high = 0.0, 1.0
        if holds(1.0):
            return 1.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if holds(middle) else (low, middle)
        return low

    flat = bisect(lambda a: entropy(a) >= target * math.log(len(shares)))
    least = bisect(lambda a: (max(shares) / min(shares)) ** (1 - a) > limit) if max(shares) / min(shares) > limit else 0.0
    return max(flat, least)


def sizes(rows):
    tokens, docs = Counter(), Counter()
    for _, text, source in rows:
        tokens[source or ""] += len((text or "").split())
        docs[source or ""] += 1
    return tokens, docs


def check(got, rows, target, limit, budget=None):
    tokens, _ = sizes(rows)
    total = sum(tokens.values())
    exponent = brute_exponent(list(tokens.values()), target, limit)
    z = sum((t / total) ** exponent for t in tokens.values() if t)
    weights = {s: (t / total) ** exponent / z if t else 0.0 for s, t in tokens.items()}
    spent, used, streams = Counter(), defaultdict(Counter), defaultdict(list)
    for r in got:
        assert r.weight == pytest.approx(weights[r.source], rel=1e-4)
        spent[r.source] += r.n_tokens
        used[r.source][(r.doc_id, r["pass"])] += 1
    whole = budget or max(t / weights[s] for s, t in tokens.items() if t)
    longest = max(len((t or "").split()) for _, t, _ in rows)
    for source in tokens:
        if tokens[source]:
            assert weights[source] * whole * (1 - 1e-4) - 1 <= spent[source] <= weights[source] * whole * (1 + 1e-4) + longest
    blocks = defaultdict(list)
    for r in got:
        blocks[r.block].append(r.position)
    assert all(sorted(p) == list(range(len(p))) for p in blocks.values())
    return weights, spent, streams


def rows_of(sizes_by_source):
    rows, doc_id = [], 0
    for source, n in sizes_by_source.items():
        for i in range(n):
            rows.append((doc_id, "word " * (1 + (doc_id * 7) % 23), source))
            doc_id += 1
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2, 3) for i, t, s in rows], SCHEMA)


@pytest.mark.parametrize(("target", "limit"), [(0.95, 2.0), (0.9, 50.0), (1.0, 1000.0), (0.0, 2.0), (1.0, 1.0)])
def test_weights_and_budgets(spark, monkeypatch, target, limit):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    rows = rows_of({"big": 300, "mid": 60, "small": 12, None: 5})
    got = mix_sources(frame(spark, rows), target_entropy=target, repeat_limit=limit, block_tokens=500).collect()
    check(got, rows, target, limit)
    times = Counter(r.doc_id for r in got)
    assert set(times) == {i for i, _, _ in rows} and max(times.values()) <= math.ceil(limit * 1.001)
    again = mix_sources(frame(spark, rows), target_entropy=target, repeat_limit=limit, block_tokens=500).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_blocks_hold_the_sources_in_their_weights(spark):
    rows = rows_of({"big": 900, "small": 150})
    got = mix_sources(frame(spark, rows), repeat_limit=4.0, block_tokens=2000).collect()
    by = defaultdict(Counter)
    for r in got:
        by[r.block][r.source] += r.n_tokens
    weight = {r.source: r.weight for r in got}
    assert len(by) >= 5
    for counts in by.values():
        assert counts["small"] / sum(counts.values()) == pytest.approx(weight["small"], abs=0.05)
    passes = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.block, r.position)):
        if r.source == "small":
            passes[r["pass"]].append(r.doc_id)
    assert passes[0] != passes[1][: len(passes[0])]


def test_budget_below_one_pass_takes_a_part(spark):
    rows = rows_of({"a": 200, "b": 100})
    tokens, _ = sizes(rows)
    got = mix_sources(frame(spark, rows), budget_tokens=600, repeat_limit=100.0, target_entropy=1.0).collect()
    check(got, rows, 1.0, 100.0, 600)
    assert len({r.doc_id for r in got}) == len(got) < len(rows)


def test_blank_texts_nulls_and_repeats(spark):
    rows = [(1, None, "a"), (2, "", "blank"), (3, " \n", "blank"), (4, "x y z", "a"), (4, "x y z", "a"), (None, "w", None), (5, "one two", None)]
    got = mix_sources(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.source) for r in got if r["pass"] == 0) == Counter((i, s or "") for i, _, s in rows)
    kept = repeat_mixed(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    want = Counter(r.doc_id for r in got)
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert mix_sources(frame(spark, rows[:3])).count() == 3
    assert mix_sources(frame(spark, [])).count() == 0 and repeat_mixed(frame(spark, [])).count() == 0


def test_limits_below_one_are_refused(spark):
    with pytest.raises(ValueError, match="at least 1"):
        mix_sources(frame(spark, rows_of({"a": 2})), repeat_limit=0.5)


def test_supplied_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = mix_sources(docs).collect()
    check(got, rows, mixing.TARGET_ENTROPY, mixing.REPEAT_LIMIT)
    assert {r.doc_id for r in got} == {i for i, _, _ in rows}


@pytest.mark.parametrize("budget", [None, 60_000])
def test_the_layout_changes_nothing(spark, budget):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id < 40")).unionByName(docs.where("doc_id < 9").withColumn("source", F.lit("other")))
    results = [sorted(map(tuple, mix_sources(d, budget_tokens=budget, block_tokens=20_000).collect())) for d in (docs, docs.repartition(5), docs.coalesce(1))]
    assert results[0] == results[1] == results[2] and len(results[0]) > 100


def test_rows_without_tokens_fill_several_blocks(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"), F.lit("s").alias("source"))
    sizes = [r["count"] for r in mix_sources(docs, block_rows=500).groupBy("block").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000
