import re

from rankflow.llm.license_scan import MIN_SHARE, SLACK, TEMPLATES, Template, license_report, scan_licenses
from tests.conftest import TESTDATA

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def spans_of(words, templates=TEMPLATES):
    """(start, label, phrase, share), by looking at each template at each place."""
    found = []
    for t in templates:
        grams, width = t.grams, len(t.grams[0])
        votes = {}
        for p in range(len(words) - width + 1):
            for q, gram in enumerate(grams):
                if words[p : p + width] == gram:
                    votes.setdefault(p - q, []).append((p, q))
        island, last = [], None
        for diagonal in [*sorted(votes), None]:
            if island and (diagonal is None or diagonal - last > (0 if t.phrase else SLACK)):
                share = len({q for _, q in island}) / len(grams)
                if share >= MIN_SHARE:
                    found.append((min(p for p, _ in island), t.label, t.phrase, share))
                island = []
            if diagonal is not None:
                island, last = island + votes[diagonal], diagonal
    return found


def row(doc_id, text):
    words = words_of(text)
    spans = spans_of(words)
    starts = [s[0] for s in spans if s[2]]
    names = lambda some: ",".join(sorted({s[1] for s in some}))
    return (
        doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None),
        names([s for s in spans if s[2]]), names(spans), max((s[3] for s in spans), default=0.0),
    )


MIT = next(t.text for t in TEMPLATES if t.text.startswith("permission is hereby"))
TEXTS = [
    None, "", "?!", "word", "CC BY", "cc-by cc by-cc_by", "cc", "by cc by", "General Public\nLicense", "general public", "All rights reserved. All rights reserved.",
    "all all rights reserved rights reserved", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC 3.0.", MIT.title(), MIT.replace("of charge", "of any charge"),
    MIT.replace("granted", "given"), " ".join(MIT.split()[:10]), MIT + " x " * 500 + MIT, "é " * 30 + MIT + " general public license",
    "This work is licensed under the GNU General Public License, version 3.", "gnu lesser general public license", "gnu affero general public license",
    "general public license " * 3000, "x" * 100_000 + " all rights reserved", "ccé by", "中文 cc by 中文", "cc by\x00all\x7frights`reserved",
]


def test_odd_texts_against_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[4]), (3, TEXTS[4]), (None, TEXTS[10]), (None, None)]
    docs = spark.createDataFrame([(i, t, "w", "t", 1, 2) for i, t in rows], "doc_id bigint, text string, words string, t string, row int, id int")
    got = sorted(map(tuple, license_report(docs.repartition(3)).collect()), key=str)
    assert got == sorted((row(i, t) for i, t in rows), key=str)
    assert {"mit", "cc-by,cc-by-nc", "agpl,gpl", "gpl,lgpl"} <= {r[6] for r in got}


def test_changed_words_are_merged_from_neighbouring_diagonals(spark):
    docs = spark.createDataFrame([(1, MIT.replace("person", "person or body")), (2, MIT.replace("this ", ""))], "doc_id bigint, text string")
    for r in scan_licenses(docs).collect():
        (span,) = r.spans
        assert span.label == "mit" and span.start == 0 and span.end == r.n_words and MIN_SHARE <= span.share < 1


def test_own_templates_of_one_word_and_more(spark):
    docs = spark.createDataFrame([(1, "Proprietary and confidential; proprietary")], "doc_id bigint, text string")
    (r,) = scan_licenses(docs, templates=[Template("own", "proprietary", True), Template("both", "proprietary and confidential")]).collect()
    assert [(s.start, s.end, s.label) for s in r.spans] == [(0, 1, "own"), (0, 3, "both"), (3, 4, "own")]


def test_supplied_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    got = sorted(map(tuple, license_report(docs.repartition(5)).collect()))
    assert got == sorted(row(r.doc_id, r.text) for r in docs.collect())


def test_empty_table(spark):
    assert license_report(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
