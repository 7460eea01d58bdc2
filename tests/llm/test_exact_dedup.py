import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rankflow.llm.exact_dedup import drop_copies, exact_groups

SCHEMA = "doc_id bigint, text string, keep string, digit int, row int"


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = [i for i in groups[text or ""] if i is not None]
        keep = max(ids) if ids else None
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc_id, keep, len(groups[text or ""]), doc_id == keep, sha))
    return sorted(out, key=str)


CASES = [
    (1, "a" * 3000 + "x"), (2, "a" * 3000 + "y"), (3, "a" * 3000 + "x"), (4, "a" * 3000), (5, None), (6, ""),
    (7, "é" * 40), (8, "é" * 40), (9, "é" * 39 + "e"), (10, "same"), (11, "same "), (12, "b" * 64), (13, "b" * 64),
    (14, "b" * 65), (15, "long " * 20000), (16, "long " * 20000), (17, "long " * 19999 + "lung "), (None, "a"), (18, "a"),
    (None, "only null"), (19, "x" * 576), (20, "x" * 576), (20, "x" * 576),
]


@pytest.mark.parametrize("first", [2, 64])
def test_groups_match_brute_force(spark, first):
    docs = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in CASES], SCHEMA)
    rows = exact_groups(docs, first=first)
    assert rows.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "row_mark"]
    assert sorted(map(tuple, rows.drop("row_mark").collect()), key=str) == expected(CASES)


def test_drop_copies_keeps_columns_and_one_row_each(spark):
    docs = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in CASES], SCHEMA)
    left = drop_copies(docs)
    assert left.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in left.collect()]
    assert len(rows) == len(set(rows)) == len({t or "" for _, t in CASES})


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_groups(empty).count() == 0 and drop_copies(empty).count() == 0


def test_one_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.repeat(F.lit("copy "), 200)).otherwise(F.concat(F.repeat(F.lit("copy "), 200), "id")).alias("text"))
    sizes = exact_groups(docs).groupBy("group_size").count().collect()
    assert sorted(map(tuple, sizes)) == [(1, 1000), (2000, 2000)]
