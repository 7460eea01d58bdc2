"""Secrets in texts, and weak candidates that count only where complementary parts meet.

Patterns give spans of six kinds. ``assign``, ``access`` and ``hex`` are reported as they are. The
parts of a credential that mean nothing alone (``ident``: an account or client name, ``blob``: a
long mixed string, ``endpoint``: an address) are joined by intervals with the other parts of the same
document, and reported only where a part they need lies within the same scope.

Everything is built-in: positions of the matches come from the pieces that a split on the pattern
leaves between them. Temporary tables hold positions and lengths, never the matched text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.sources.workspace import stored

SCOPE = 256

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
IDENT = r"""(?i)(?:user(?:name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
BLOB = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}"
ENDPOINT = r"""(?i)(?:https?|ftps?|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp|jdbc:[a-z]+)://[^\s"'<>]+"""


def _has(*words: str) -> Callable[[Column], Column]:
    def check(text: Column) -> Column:
        low = F.lower(text)
        found = F.contains(low, F.lit(words[0]))
        for word in words[1:]:
            found = found | F.contains(low, F.lit(word))
        return found

    return check


@dataclass(frozen=True)
class Kind:
    """``may``: a cheap test that every text with a match passes; ``valid``: what a match must hold."""

    name: str
    pattern: str
    may: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    needs: tuple[str, ...] = ()


#: In reporting order. ``needs``: roles of which one must lie in the scope of a weak part.
KINDS = (
    Kind("assign", ASSIGN, _has("password", "passwd", "secret", "token", "apikey", "api_key"), lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6),
    Kind("access", ACCESS, lambda t: F.contains(t, F.lit("AKIA")), lambda m: F.lit(True)),
    Kind("hex", HEX, lambda t: t.rlike(HEX), lambda m: F.lit(True)),
    Kind("ident", IDENT, _has("user", "login", "account", "clientid", "client_id", "keyid", "key_id"), lambda m: F.lit(True), ("secret",)),
    Kind("blob", BLOB, lambda t: t.rlike(BLOB), lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]"), ("identity", "endpoint")),
    Kind("endpoint", ENDPOINT, lambda t: F.contains(t, F.lit("://")), lambda m: F.lit(True), ("secret",)),
)
ROLES = {"assign": "secret", "hex": "secret", "blob": "secret", "access": "identity", "ident": "identity", "endpoint": "endpoint"}
N_BASE = 3


def _hits(text: Column, number: int, kind: Kind) -> Column:
    """Of each match in order: gap before it, its length, and whether it is valid."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    pieces = F.arrays_zip(matches.alias("match"), gaps.alias("gap"))

    def one(piece: Column, place: Column) -> Column:
        return F.struct(
            F.lit(number).alias("kind"),
            place.alias("place"),
            F.length(piece["gap"]).alias("gap"),
            F.length(piece["match"]).alias("size"),
            (piece["match"].isNotNull() & kind.valid(piece["match"])).alias("valid"),
        )

    none = F.array().cast("array<struct<kind:int,place:int,gap:int,size:int,valid:boolean>>")
    return F.when(kind.may(text), F.transform(pieces, one)).otherwise(none)


def _spans(scanned: DataFrame) -> DataFrame:
    """row, kind, start, end of the valid matches, by running sums of gaps and lengths."""
    hits = scanned.where(F.size("hits") > 0).select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    before = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(before)
    hits = hits.withColumn("start", (F.coalesce(passed, F.lit(0)) + F.col("gap")).cast("bigint")).where("valid")
    return hits.select("row", "kind", "start", (F.col("start") + F.col("size")).alias("end"))


def _linked(spans: DataFrame, scope: int) -> DataFrame:
    """The weak spans with a part they need inside their scope: ``scope`` code points on either side.

    Spans meet in buckets of ``scope`` code points, so a bucket holds few of them however long the text is.
    """
    role = F.element_at(F.array(*[F.lit(ROLES[k.name]) for k in KINDS]), F.col("kind") + 1)
    needs = F.element_at(F.array(*[F.array(*[F.lit(n) for n in k.needs]).cast("array<string>") for k in KINDS]), F.col("kind") + 1)
    first, last = F.floor(F.greatest(F.col("start") - scope, F.lit(0)) / scope), F.floor((F.col("end") + scope) / scope)
    weak = spans.where(F.col("kind") >= N_BASE).withColumn("needs", needs)
    weak = weak.withColumn("bucket", F.explode(F.sequence(first, last))).alias("w")
    parts = spans.withColumn("role", role).withColumn(
        "bucket", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope)))
    ).alias("p")
    fits = (
        (F.col("w.row") == F.col("p.row"))
        & (F.col("w.bucket") == F.col("p.bucket"))
        & F.array_contains("w.needs", F.col("p.role"))
        & (F.col("p.start") < F.col("w.end") + scope)
        & (F.col("p.end") > F.col("w.start") - scope)
        & ((F.col("p.end") <= F.col("w.start")) | (F.col("p.start") >= F.col("w.end")))
    )
    return weak.join(parts, fits, "left_semi").select("row", "kind", "start", "end").distinct()


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    texts = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE
) -> DataFrame:
    """One row for each row of ``docs``: the id, ``base`` and ``spans`` (arrays of kind, start, end, in order).

    Offsets are code points, ends exclusive; order is by start, then by kind as in ``KINDS``. ``base``
    holds the first three kinds, ``spans`` the linked weak ones as well. A null text counts as empty and has
    empty arrays; null and repeated ids stay as they are; an empty table gives no rows; other columns
    are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hits = F.concat(*[_hits(text, number, kind) for number, kind in enumerate(KINDS)])
    scanned = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("row"), hits.alias("hits"))
    scanned = stored(scanned, "secret-hits")
    spans = stored(_spans(scanned), "secret-spans")
    found = spans.where(F.col("kind") < N_BASE).unionByName(_linked(spans, scope))
    span = F.struct("start", "kind", "end")
    by_row = found.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("all"))
    rows = scanned.select("_id", "row").join(by_row, "row", "left")
    every = F.coalesce("all", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    return rows.select(
        F.col("_id").alias(id_col),
        F.filter(every, lambda s: s["kind"] < N_BASE).alias("base"),
        every.alias("spans"),
    )


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text, for each row."""
    scanned = scan_secrets(docs, id_col, text_col, scope)

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("bigint").alias(f"n_{KINDS[number].name}")

    return scanned.select(
        id_col,
        *[count(number) for number in range(N_BASE)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
