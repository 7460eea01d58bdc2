import hashlib
import zlib
from itertools import groupby

from pyspark.sql import functions as F

from rankflow.llm import merkle
from rankflow.llm.merkle import folded, merkle_manifest, row_digest, tampered_manifest
from tests.conftest import TESTDATA

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, `group` int, node string, rank int, row string, member int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def spelled(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(r, more=0):
    n = None if r[3] is None else r[3] + more
    return digest(*[spelled(v) for v in (r[0], r[1], r[2], n, r[4])])


def tree(nodes):
    """The root, and for each node its steps (left, right)."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, joined = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i : i + 2]
            for x in members[i]:
                paths[x].append(("", run[1] if len(run) > 1 else ""))
            for x in members[i + 1] if len(run) > 1 else []:
                paths[x].append((run[0], ""))
            above.append(digest(*run))
            joined.append(sum(members[i : i + 2], []))
        nodes, members = above, joined
    return nodes[0], paths


def expected(rows):
    """The rows of ``tampered_manifest``, from (doc_id, source, lang, n_chars, text, ...)."""
    order = lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf_of(r))
    groups = [list(g) for _, g in groupby(sorted(rows, key=order), key=lambda r: r[2])]
    trees = [tree([leaf_of(r) for r in g]) for g in groups]
    root, tops = tree([t[0] for t in trees])
    out = []
    for group, (subroot, paths), top in zip(groups, trees, tops):
        for r, path in zip(group, paths):
            path = path + top
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf_of(r, 1 if hit else 0)
            for left, right in path:
                node = digest(left, node, right)
            out.append((r[0], leaf_of(r), subroot, root, digest(*[a + b for a, b in path]), node, node == root))
    return sorted(out, key=str)


def table(spark, rows):
    rows = [(*r, 1, "n", 2, "r", 3) for r in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def check(spark, rows):
    assert sorted(map(tuple, tampered_manifest(table(spark, rows)).collect()), key=str) == expected(rows)


ODD = [
    (1, "s", "en", 4, "text"), (2, None, "en", None, None), (3, "", "en", 0, ""), (None, "s", "en", 1, "x"), (None, "s", "en", 1, "y"),
    (5, "s", None, 1, "null group"), (6, "s", None, 2, "é" * 10), (7, "s", "", 1, "empty group"), (8, "s", "é", 1, "alone"),
    (9, "s", "en", 1, "again"), (9, "s", "en", 1, "again"), (9, "s", "en", 1, "again"), (9, "t", "en", 1, "same id"),
    (10, "s", "zz", 1, "long " * 50_000), (-5, "s", "de", 1, "below 0"), (4, "s", "EN", 1, "capital"),
]


def test_odd_rows_and_sizes_around_digits_and_blocks(spark):
    sizes = (1, 2, 3, 31, 32, 33, 1023, 1025)
    check(spark, ODD + [(i, "s", f"g{g}", i, f"t{i}") for g, n in enumerate(sizes) for i in range(g * 5000, g * 5000 + n)])


def test_many_groups_make_a_tall_top(spark):
    check(spark, [(i, "s", f"g{i % 1100}", i, "t") for i in range(1500)])


def test_groups_of_one_row(spark):
    check(spark, [(1, "s", "a", 1, "t")])


def test_small_blocks_make_many_tiers(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DIGIT_BITS", 1)
    monkeypatch.setattr(merkle, "BLOCK_BITS", 2)
    check(spark, [(i, "s", "ab"[i % 9 == 0], i, f"t{i}") for i in range(150)] + ODD)


def test_any_change_of_a_row_is_seen(spark):
    docs = table(spark, [(i, "s", "ab"[i % 2], i, f"t{i}") for i in range(40)])
    proved = merkle_manifest(docs, carry={"other": F.concat("text", F.lit("."))})
    other = row_digest([F.col("doc_id"), F.lit("s"), F.lit("a"), F.col("doc_id"), F.col("carried.other")])
    seen = proved.select((folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("same"), (folded(other, F.col("path")) == F.col("root")).alias("changed"))
    assert {tuple(r) for r in seen.collect()} == {(True, False)}


def test_the_layout_changes_nothing(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    results = [sorted(map(tuple, tampered_manifest(d).collect()), key=str) for d in (docs, docs.repartition(5).orderBy(F.desc("text")))]
    assert results[0] == results[1]
    assert results[0] == expected([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()])


def test_empty_table(spark):
    assert tampered_manifest(table(spark, [])).count() == 0


def test_proofs_are_written_without_joins(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    plan = tampered_manifest(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate explode" in plan
