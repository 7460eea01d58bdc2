from collections import Counter

import corpus_pipeline
from rankflow.llm.quality import judge_quality
from rankflow.sources.workspace import stored
from tests.conftest import TESTDATA
from tests.llm.test_fingerprints import jaccard, shingles
from tests.llm.test_tokens import library_ids

FOLDER = f"{TESTDATA}/sf0.01"


def near_groups(rows):
    """Connected groups at 0.8, by an inverted index; each as its smallest id."""
    sets, by = {i: shingles(t or "") for i, t in rows.items()}, {}
    for i, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(i)
    near = {i: {j for g in s for j in by[g] if j != i and jaccard(s, sets[j]) >= 0.8} for i, s in sets.items()}
    kept, seen = set(), set()
    for i in sorted(sets):
        if i not in seen:
            kept.add(i)
            queue = [i]
            while queue:
                for j in near[queue.pop()] - seen:
                    seen.add(j)
                    queue.append(j)
            seen.add(i)
    return kept


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    columns, tables = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, FOLDER), f"test-{name}")
        assert docs.columns == columns
        tables.append(({r.doc_id: r for r in before.collect()}, docs.collect()))
    (rows, good), (_, single), (_, apart), (_, mixed) = tables

    predicted = {r.doc_id: r.predicted for r in judge_quality(spark.read.parquet(f"{FOLDER}/documents.parquet"), labels).collect()}
    assert {r.doc_id for r in good} == {i for i, p in predicted.items() if p == 1} and len(good) == len({r.doc_id for r in good})
    truth = {r.doc_id: r.quality for r in labels.collect()}
    kept = {r.doc_id for r in good}
    assert sum(i in kept for i, q in truth.items() if q == 1) >= 0.99 * sum(truth.values())

    largest = {}
    for r in good:
        largest[r.text] = max(r.doc_id, largest.get(r.text, -1))
    assert sorted(r.doc_id for r in single) == sorted(largest.values())

    want = near_groups({r.doc_id: r.text for r in single})
    got = {r.doc_id for r in apart}
    assert len(got) == len(apart) and want <= got and len(got - want) <= 0.001 * len(want)

    times = Counter(r.doc_id for r in mixed)
    assert set(times) == got and max(times.values()) <= 3
    assert all(r == rows[r.doc_id] for r in mixed)

    pieces = corpus_pipeline.packing(spark, docs, FOLDER).collect()
    ids = {}
    for r in pieces:
        ids.setdefault(r.doc_id, Counter())[(r.start, r.length, r.doc_tokens)] += 1
    for r in rows.values():
        if r.doc_id in times:
            n = len(library_ids(r.text))
            assert sum(length * k for (_, length, _), k in ids[r.doc_id].items()) == n * times[r.doc_id]
    assert set(ids) == set(times)


def test_run_equals_its_stages(spark):
    result = corpus_pipeline.run(spark, f"{TESTDATA}/sf0.001")
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, f"{TESTDATA}/sf0.001")
    key = lambda r: (r.doc_id, r.start, r.length, bytes(r.ids))
    assert sorted(map(key, result.collect())) == sorted(map(key, docs.collect()))


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
    assert corpus_pipeline.packing(spark, docs, FOLDER).count() == 0


def test_stages_take_odd_rows_and_any_further_column(spark):
    texts = [None, "", "word", "same text of some words here", "same text of some words here", "中文" * 300, "long " * 30_000]
    names = ["_score", "_times", "_rows", "_used_id", "_used_mark", "_kept_id", "_kept_mark", "_again", "_held", "row_mark", "_text", "pass", "kept", "root"]
    rows = [(i % 6 if i % 5 else None, t, None if i % 2 else "en", "s", i, *range(len(names))) for i, t in enumerate(texts * 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{n} int" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, f"{TESTDATA}/sf0.001")
        assert out.columns == docs.columns
        allowed = {tuple(r) for r in docs.collect()}
        kept = {tuple(r) for r in out.collect()}
        assert kept <= allowed and (kept or name == "quality")
