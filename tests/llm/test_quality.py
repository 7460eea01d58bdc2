import zlib

import numpy as np
import pyarrow as pa
import pytest

from rankflow.llm.quality import (
    FORMS, SIZE, _index_vectors, _words, context_sums, fit_quality, held_out, judge_quality, keep_quality, pooled, score_quality, train,
)
from tests.conftest import TESTDATA


def auc(score, label):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    positive = label == 1
    n = positive.sum()
    return (ranks[positive].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_held_out_rows_are_judged_well(spark):
    folder = f"{TESTDATA}/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = judge_quality(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    test = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    score, label = np.array(test).T
    print("auc", auc(score, label), "accuracy", ((score >= 0.5) == label).mean())
    assert auc(score, label) > 0.95
    assert ((score >= 0.5) == label).mean() > 0.95
    bins = np.clip((score * 5).astype(int), 0, 4)
    assert sum(abs(label[bins == b].mean() - score[bins == b].mean()) * (bins == b).mean() for b in set(bins)) < 0.05


def test_context_sums_match_brute_force(spark):
    texts = ["a B a a, b", "", None, "a b", "1 22 333 !!", "é É x x x x"]
    docs = spark.createDataFrame([(t, 1) for t in texts], "text string, row int").repartition(3)
    got = {r[0]: list(r[1:]) for r in context_sums(docs).collect()}
    plus, minus = _index_vectors()
    want = {}
    for text in texts:
        forms, shapes, _ = _words(pa.array([text or ""]))
        for i in range(len(forms)):
            for j in range(len(forms)):
                if i != j and abs(i - j) <= 2:
                    for row in (forms[i], shapes[i]):
                        for other in (forms[j], shapes[j]):
                            vector = want.setdefault(int(row), [0] * SIZE)
                            vector[plus[other]] += 1
                            vector[minus[other]] -= 1
    assert got == {k: v for k, v in want.items() if any(v)}


def test_shapes_tell_repeats_and_case(spark):
    forms, shapes, bounds = _words(pa.array(["Word word WORD word word", "word"]))
    assert bounds.tolist() == [0, 5, 6]
    assert forms[1] == forms[3] == forms[4] == forms[5]
    assert shapes[1] == shapes[3] == shapes[5] and len({*shapes[[0, 1, 2, 4]]}) == 4 and (shapes >= FORMS).all()


def test_pooling_is_the_mean_of_the_vectors():
    vectors = np.random.default_rng(0).normal(size=(FORMS + 2048, SIZE)).astype(np.float32)
    texts = pa.array(["a b c", "", "d"])
    forms, shapes, bounds = _words(texts)
    got = pooled(texts, vectors)
    assert np.allclose(got[0, :SIZE], vectors[forms[:3]].mean(axis=0), atol=1e-5)
    assert np.allclose(got[2, SIZE : 2 * SIZE], vectors[shapes[3]], atol=1e-5) and not got[1].any()
    assert pooled(pa.array([], pa.string()), vectors).shape == (0, 2 * SIZE + 1)


def test_labels_of_one_kind_give_a_constant_score(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)] + [(None, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(6)] + [(None, 0), (3, None)], "doc_id bigint, quality int")
    rows = judge_quality(docs, labels).collect()
    assert len({r.score for r in rows}) == 1 and rows[0].score > 0.5 and len(rows) == 7
    none = judge_quality(docs, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/sf0.001/labels.parquet").select("doc_id", "quality")
    hidden = held_out(labels["doc_id"])
    changed = labels.withColumn("quality", (1 - labels["quality"]).cast("int")).where(hidden).unionByName(labels.where(~hidden))
    a, b = (sorted(map(tuple, judge_quality(docs, x).collect())) for x in (labels, changed))
    assert a == b


def test_filter_keeps_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, score double, held_out int")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert keep_quality(docs, labels).columns == docs.columns and keep_quality(docs, labels).count() == 0
    model = fit_quality(docs, labels)
    with pytest.raises(ValueError, match="already"):
        score_quality(docs, model)


def test_network_learns_a_curved_border():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 6))
    y = ((x**2)[:, :2].sum(axis=1) > 1.5).astype(float)
    net = train(x, y)
    assert ((net.probability(x) > 0.5) == y).mean() > 0.93
