import math
import re
from collections import Counter, defaultdict
from random import Random

import pytest
from pyspark.sql import functions as F

from rankflow.llm.url_filter import RULES, _ngrams, _ratios, _spelled, judge_urls, longest_rule, score_texts, url_host, url_path
from tests.conftest import TESTDATA

URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Org", "http://A.Org/", "https://x.example.org/es/1?q=/de/", "http://example.org/en/12", "http://example.org/en/2",
    "http://badexample.org/es/1", "http://b.com/fr/x", "http://b.com/de/x#y", "http://com/de/", "http://b.net/de/x", "http://b.net/fr/x", "ftp://u.net?x=1", "http://b.net#f/de/",
    "http://É.Org/FR/", "http://a.org:80/", "a://b.com/fr/://c.com/de/", "http://comx/de/", "http://b.com/FR/x",
]


def parts(url):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not match:
        return "", ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in match[1]), match[2]


def rule_of(host, path):
    fitting = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fitting, key=lambda r: len(r.host + r.path), default=None)
    return (best.host + best.path, best.verdict) if best else (None, None)


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id bigint, url string")
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rows = rows.withColumn("r", longest_rule(F.col("host"), F.col("path"))).collect()
    for row in rows:
        host, path = parts(URLS[row.page_id])
        assert (row.host, row.path) == (host, path)
        assert (tuple(row.r) if row.r else (None, None)) == rule_of(host, path)


def test_every_page_gets_a_verdict(spark):
    pages = spark.createDataFrame([(i, u, "h", 1.0) for i, u in enumerate(URLS)] + [(None, URLS[9], "h", 1.0), (3, URLS[3], "h", 1.0)], "page_id bigint, url string, host string, score double")
    rows = judge_urls(pages).collect()
    assert len(rows) == len(URLS) + 2
    for row in rows:
        assert row.verdict in ("allow", "block")
        rule, verdict = rule_of(row.host, row.path)
        assert row.rule == rule and (verdict is None or row.verdict == verdict) and (row.score is None) == (rule is not None)


def test_without_decided_urls_all_pass(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id bigint, url string")
    assert {r.verdict for r in judge_urls(pages).collect()} == {"allow"}
    assert judge_urls(pages.where("false")).count() == 0


def brute_ratio(text, train, order=4):
    """Mean log-ratio by Witten-Bell interpolation straight from the counts."""
    counts = {side: defaultdict(Counter) for side in (True, False)}
    for t, side in train:
        padded = "\x02" * order + t + "\x03"
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts[side][padded[i - k : i]][padded[i]] += 1

    def p(side, context, char):
        value = 1 / 256
        for k in range(len(context) + 1):
            seen = counts[side].get(context[len(context) - k :])
            if seen:
                n, t = sum(seen.values()), len(seen)
                value = (seen[char] + t * value) / (n + t)
        return value

    def known(gram):
        return any(counts[s].get(gram[:-1], {}).get(gram[-1]) for s in (True, False))

    padded, total = "\x02" * order + text + "\x03", 0.0
    for i in range(order, len(padded)):
        if known(padded[i : i + 1]):
            total += math.log(p(True, padded[i - order : i], padded[i]) / p(False, padded[i - order : i], padded[i]))
        else:
            # a character that no model has met: both leave the same contexts with their own odds
            for k in range(order + 1):
                for side, sign in ((True, 1), (False, -1)):
                    seen = counts[side].get(padded[i - k : i])
                    if seen:
                        total += sign * math.log(len(seen) / (sum(seen.values()) + len(seen)))
    return total / (len(text) + 1)


def test_scores_match_brute_force(spark):
    train = [("a.org/en/12", True), ("b.org/fr/7", True), ("a.org/x", True), ("a.com/de/1", False), ("bb.com/de/22", False)]
    tests = ["a.org/en/12", "c.net/de/9", "", "ÿzz", "b.org/de/7", "a.com"]
    ratios = _ratios(_ngrams(spark.createDataFrame(train, "text string, accepted boolean")))
    got = score_texts(spark.createDataFrame(list(enumerate(tests)), "id bigint, text string"), ratios).collect()
    assert len(got) == len(tests)
    for row in got:
        assert row.score == pytest.approx(brute_ratio(tests[row.id], train), abs=1e-6)


def test_urls_without_a_scheme_are_read(spark):
    urls = ["http://a.org/en/1", "http://b.org/en/2", "http://a.com/de/1", "http://b.com/de/2", "spam.de/de/1", "example.net/en/2", None, "", "x:/y"]
    rows = judge_urls(spark.createDataFrame(list(enumerate(urls * 6)), "page_id bigint, url string")).collect()
    by = {urls[r.page_id % len(urls)]: r for r in rows}
    assert (by["spam.de/de/1"].host, by["spam.de/de/1"].path, by["spam.de/de/1"].rule) == ("", "", None)
    assert by["spam.de/de/1"].score < by["example.net/en/2"].score and by[None].score == by[""].score


def test_method_follows_the_rules_on_undecided_hosts(spark):
    pages = spark.read.parquet(f"{TESTDATA}/sf0.1/pages.parquet")
    rows = judge_urls(pages).collect()
    assert len(rows) == 2500
    by = defaultdict(Counter)
    for r in rows:
        if r.rule is None:
            by[r.path.split("/")[1]][r.verdict] += 1
    print(dict(by))
    assert by["de"]["block"] > by["de"]["allow"] and by["fr"]["allow"] > by["fr"]["block"]
    spelled = pages.select(_spelled(F.col("url")).alias("t")).first().t
    assert "://" not in spelled


def test_every_ngram_counts_beyond_any_table_size(spark):
    """More than 2^18 n-grams and contexts: scores are those of all of them, also on hosts that share all their n-grams."""
    random = Random(5)

    def word(n):
        return "".join(random.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=n))

    names = [(word(12), word(16)) for _ in range(6000)]
    decided = [f"{host}.org/{path}" if i % 2 else f"{host}.com/de/{path}" for i, (host, path) in enumerate(names)]
    asked = [f"{host}.net/{path}" for host, path in names[:6]] + ["", "ÿé.net/"]
    urls = [f"http://{t}" for t in decided + asked * 2]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")

    texts = pages.where(F.col("page_id") < len(decided)).select(_spelled(F.col("url")).alias("text"))
    train = [(r.text, ".org/" in r.text) for r in texts.where("pmod(xxhash64(text, 1), 5) <> 4").collect()]
    assert _ratios(_ngrams(spark.createDataFrame(train, "text string, accepted boolean"))).count() > 1 << 18
    scores = {r.page_id: r.score for r in judge_urls(pages).where("rule is null").collect()}
    assert len(scores) == 2 * len(asked)
    for i, text in enumerate(asked):
        first = len(decided) + i
        assert scores[first] == scores[first + len(asked)] == pytest.approx(brute_ratio(text, train), abs=1e-6)
