"""URL filter: rules first, then the ratio of two character models learnt from the URLs that rules decide.

Both models are smoothed variable-order Markov models (Witten-Bell interpolation of contexts of 0 to ``ORDER``
characters): one of accepted URLs, one of rejected ones. Their log-ratios for all character n-grams are a table
keyed by n-gram, which grows with the input. At each character of a URL the longest n-gram in the table counts,
and each known context that had to be left for a shorter one adds its own ratio. That depends on the last
``ORDER`` + 1 characters alone, so it is worked out once for each such n-gram, joined to the characters of
the distinct URLs and summed for each URL. The mean over the characters is compared with a threshold
that separates best those URLs decided by rules that the models were not shown.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.operators.joins import join_ranked
from rankflow.sources.workspace import stored

ORDER = 4
_START, _END, _LEFT = "\x02", "\x03", "\x00"
#: Parts of a unit in the values of n-grams: whole numbers, so that the order of a sum changes nothing.
_PARTS = 1 << 30
#: Bins of a score from -8 to 8 in the calibration.
_BINS, _REACH = 1600, 8.0


@dataclass(frozen=True)
class UrlRule:
    """A host (its subdomains count as well) and the start of a path."""

    verdict: str
    host: str
    path: str


RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


def _lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    return _lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[UrlRule] = RULES) -> Column:
    """Struct of rule (host and path) and verdict, or null. For lists short enough to be one expression."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        chosen = F.when(fits, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _spelled(url: Column) -> Column:
    """What the models read: what follows the scheme, or the whole url without one, in lower case, without the control
    characters used here."""
    known = F.coalesce(url, F.lit(""))
    rest = F.when(F.contains(known, F.lit("://")), F.regexp_extract(known, r"(?s)^.*?://(.*)$", 1)).otherwise(known)
    return F.translate(_lower(rest), _START + _END + _LEFT, "")


def _padded(text: Column) -> Column:
    return F.concat(F.lit(_START * ORDER), text, F.lit(_END))


def _places(texts: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and gram (``ORDER`` characters and the one that follows), a row for each character of ``text`` and its end."""
    text = _padded(F.col("text"))
    places = F.sequence(F.lit(1), F.length("text") + 1)
    return texts.select(*columns, F.explode(F.transform(places, lambda i: F.substr(text, i, F.lit(ORDER + 1)))).alias("gram"))


def _ngrams(texts: DataFrame) -> DataFrame:
    """gram, a, b: how often in accepted and in rejected texts."""
    rows = _places(texts, "accepted")
    return rows.groupBy("gram").agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("b"))


def _ratios(grams: DataFrame) -> DataFrame:
    """key, ratio, weight: log-ratios of all n-grams, and (key ending in ``_LEFT``) of leaving each context."""
    ends = F.transform(F.sequence(F.lit(0), F.lit(ORDER)), lambda k: F.struct(k.alias("order"), F.right("gram", k + 1).alias("key")))
    keys = grams.select(F.explode(ends).alias("end"), "a", "b").groupBy("end.order", "end.key")
    keys = keys.agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    keys = keys.withColumn("context", F.expr("left(key, order)"))
    contexts = keys.groupBy("order", "context").agg(
        F.sum("a").alias("n_a"), F.sum("b").alias("n_b"),
        F.count_if(F.col("a") > 0).alias("t_a"), F.count_if(F.col("b") > 0).alias("t_b"),
    )
    seen = keys.join(contexts, ["order", "context"])

    # of each n-gram, the counts of all its endings, shortest first
    counts = F.struct("order", "a", "b", "n_a", "n_b", "t_a", "t_b")
    by_key = seen.select(F.col("key").alias("ending"), counts.alias("counts"))
    endings = keys.select("key", "a", "b", F.explode(F.transform(F.sequence(F.lit(0), F.col("order")), lambda k: F.right("key", k + 1))).alias("ending"))
    chains = endings.join(by_key, "ending").groupBy("key", "a", "b").agg(F.sort_array(F.collect_list("counts")).alias("chain"))

    def log_probability(side: str) -> Column:
        def step(p: Column, c: Column) -> Column:
            n, t = c[f"n_{side}"], c[f"t_{side}"]
            return F.when(n > 0, (c[side] + t * p) / (n + t)).otherwise(p)

        return F.log(F.aggregate("chain", F.lit(1 / 256), step))

    def log_leave(side: str) -> Column:
        n, t = F.col(f"n_{side}"), F.col(f"t_{side}")
        return F.when(n > 0, F.log(t / (n + t))).otherwise(F.lit(0.0))

    grown = chains.select("key", (log_probability("a") - log_probability("b")).alias("ratio"), (F.col("a") + F.col("b")).alias("weight"))
    left = contexts.select(
        F.concat("context", F.lit(_LEFT)).alias("key"), (log_leave("a") - log_leave("b")).alias("ratio"), (F.col("n_a") + F.col("n_b")).alias("weight")
    )
    return grown.unionByName(left)


def _gram_values(grams: DataFrame, ratios: DataFrame) -> DataFrame:
    """gram, value (in ``_PARTS``) of each row of ``grams`` (distinct) of which ``ratios`` holds an ending or a context."""
    endings = [F.struct(F.lit(k).alias("order"), F.lit(True).alias("grown"), F.right("gram", F.lit(k + 1)).alias("key")) for k in range(ORDER + 1)]
    context = F.left("gram", F.lit(ORDER))
    lefts = [
        F.struct(F.lit(k).alias("order"), F.lit(False).alias("grown"), F.concat(F.right(context, F.lit(k)), F.lit(_LEFT)).alias("key"))
        for k in range(ORDER + 1)
    ]
    wanted = grams.select("gram", F.explode(F.array(*endings, *lefts)).alias("end")).select("gram", "end.*")
    # short endings are wanted by many n-grams
    found = join_ranked(wanted, ratios.select("key", "ratio"), ["key"], "inner")
    steps = found.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("order", "grown", "ratio"))).alias("steps"))
    value = F.aggregate("steps", F.lit(0.0), lambda total, s: F.when(s["grown"], s["ratio"]).otherwise(total + s["ratio"]))
    return steps.select("gram", F.round(value * _PARTS).cast("bigint").alias("value"))


def score_texts(texts: DataFrame, ratios: DataFrame) -> DataFrame:
    """id, score of each row of ``texts`` (id and text, both distinct): the mean log-ratio over its characters and its end.

    ``ratios`` are those of :func:`_ratios`, all of them. An n-gram in every URL is a key with as many rows as there are URLs; the
    join can be split there.
    """
    places = _places(texts, "id")
    valued = join_ranked(places, _gram_values(places.select("gram").distinct(), ratios), ["gram"], "left")
    total = F.sum(F.coalesce("value", F.lit(0).cast("bigint")))
    return valued.groupBy("id").agg((total / F.lit(float(_PARTS)) / F.count(F.lit(1))).alias("score"))


def _threshold(scored: DataFrame) -> float:
    """The score from which accepting is right in most accepted and wrong in most rejected rows, each side weighing half.

    ``scored`` has score, a, b: how many accepted and rejected rows have that score.
    """
    place = F.least(F.greatest(F.floor((F.col("score") + _REACH) / (2 * _REACH) * _BINS), F.lit(0)), F.lit(_BINS - 1))
    counts = scored.where("a + b > 0").groupBy(place.cast("int").alias("bin"))
    bins = counts.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()  # at most _BINS rows
    a, b = sum(r.a for r in bins), sum(r.b for r in bins)
    if not a or not b:
        return 0.0
    above, below, best = {r.bin: r.a for r in bins}, {r.bin: r.b for r in bins}, []
    passed, stopped = a, 0
    for number in range(_BINS):
        edge = number * 2 * _REACH / _BINS - _REACH
        best.append((round(passed / a + stopped / b, 9), -abs(edge), edge))
        passed, stopped = passed - above.get(number, 0), stopped + below.get(number, 0)
    return max(best)[2]


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[UrlRule] = RULES) -> DataFrame:
    """One row for each row of ``pages``: the id, host, path, rule, verdict (allow or block), score.

    The longest rule that fits decides; ``score`` is null there. Of the URLs that rules decide, four fifths (by a hash)
    train the models and one fifth sets the threshold; without one of the two kinds the threshold is 0, without
    any decided URL all scores are 0 and the verdict is allow. A url without ``://`` has an empty host and path and is scored by all
    its characters; null counts as the empty url. Repeated rows are judged alike; an empty table gives no rows.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("_id"), url_host(url).alias("host"), url_path(url).alias("path"), _spelled(url).alias("text"))
    rows = rows.withColumn("decided", longest_rule(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("accepted", F.col("decided.verdict") == "allow")
    apart = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(5)) == 4
    ratios = _ratios(_ngrams(rows.where(F.col("accepted").isNotNull() & ~apart)))

    # each text once: those without a rule, and those that set the threshold, with their numbers of rows
    texts = rows.where(F.col("accepted").isNull() | apart).groupBy("text")
    texts = texts.agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("b"))
    texts = stored(texts.withColumn("id", F.monotonically_increasing_id()), "url-texts")
    scored = stored(texts.join(score_texts(texts, ratios), "id").select("text", "a", "b", "score"), "url-scores")
    threshold = _threshold(scored)

    by_rule = rows.where(F.col("accepted").isNotNull()).select("_id", "host", "path", "decided.rule", "decided.verdict", F.lit(None).cast("double").alias("score"))
    open_rows = rows.where(F.col("accepted").isNull()).select("_id", "host", "path", "text")
    verdict = F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    by_score = join_ranked(open_rows, scored.select("text", "score"), ["text"], "inner")
    by_score = by_score.select("_id", "host", "path", F.lit(None).cast("string").alias("rule"), verdict.alias("verdict"), "score")
    return by_rule.unionByName(by_score).withColumnRenamed("_id", id_col)
