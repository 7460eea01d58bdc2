"""License scan by diagonal voting: word k-grams of texts meet template positions, and diagonals gather their votes.

All rolling k-grams of a text are hashed and joined to the table of template k-grams. A hit at word ``p`` of the text and
word ``q`` of a template votes for the diagonal ``p - q``. Diagonals of one template that lie next to each other (words
were put in or left out) are merged, and a merged span stands if enough of the template's k-grams are in it. Hits are
compared word by word, so a hash alone decides nothing.

Each text is read once: the document itself is a first element among its k-grams, with a hash of its own, so that a text
without any hit comes out of the same join.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words of a k-gram; a shorter template is one k-gram of all its words.
WIDTH = 3
#: Diagonals at most this far apart are neighbours.
SLACK = 4
#: Share of a template's k-grams that a span must hold.
MIN_SHARE = 0.8
#: Templates are broadcast as k-grams: beyond this number the join is left to Spark's own choice.
BROADCAST_GRAMS = 100_000
#: What is not a word, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DOCUMENT = 0


@dataclass(frozen=True)
class Template:
    """Words separated by blanks, in lower case. Each place of a ``phrase`` counts by itself; others tolerate changes."""

    label: str
    text: str
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def grams(self) -> list[list[str]]:
        width = min(WIDTH, len(self.words))
        return [self.words[i : i + width] for i in range(len(self.words) - width + 1)]


# The phrases that are always looked for.
PHRASES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)
#: Notices as their licenses recommend them, and short statements in common use.
NOTICES = (
    Template("agpl", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-nd", "licensed under cc by nd 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    Template("gpl", "it under the terms of the gnu general public license as published by the free software foundation"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("mit", "licensed under the mit license"),
    Template("mit", "released under the mit license"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)
TEMPLATES = PHRASES + NOTICES


def words_of(text: Column) -> Column:
    """The words of ``text`` (null: none), A-Z in lower case."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _gram_hash(width: int, words: Sequence[Column]) -> Column:
    return F.xxhash64(F.lit(width), *words)


def gram_table(spark: SparkSession, templates: Sequence[Template], slack: int = SLACK) -> DataFrame:
    """hash, q, gram (words) and t (what is known of the template), a row for each k-gram; the document's row has a null t."""
    rows: list[dict] = [{}]
    for number, template in enumerate(templates):
        grams, slack_here = template.grams, 0 if template.phrase else slack
        known = {"number": number, "label": template.label, "phrase": template.phrase, "grams": len(grams), "slack": slack_here}
        rows += [{"q": q, "gram": gram, "t": known} for q, gram in enumerate(grams)]
    kind = "array<struct<q:int,gram:array<string>,t:struct<number:int,label:string,phrase:boolean,grams:int,slack:int>>>"
    table = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))
    value = F.lit(_DOCUMENT).cast("bigint")
    for width in range(1, WIDTH + 1):
        value = F.when(F.size("gram") == width, _gram_hash(width, [F.get("gram", F.lit(k)) for k in range(width)])).otherwise(value)
    table = table.withColumn("hash", value)
    return F.broadcast(table) if len(rows) <= BROADCAST_GRAMS else table


def _hits(docs: DataFrame, id_col: str, text_col: str, templates: Sequence[Template], slack: int) -> DataFrame:
    """row, id, n, and for each hit p, q, width and t; one row of each document has a null t."""
    widths = sorted({len(t.grams[0]) for t in templates})
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    n = F.size("words")
    many = {w: F.greatest(n - (w - 1), F.lit(0)) for w in widths}

    def rolling(width: int) -> Column:
        places = F.slice(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), 1, many[width])
        return F.transform(places, lambda p: _gram_hash(width, [F.get("words", p - 1 + k) for k in range(width)]))

    hashes = F.concat(F.array(F.lit(_DOCUMENT).cast("bigint")), *[rolling(w) for w in widths])
    # never empty; the outer form keeps the optimizer from hashing everything once more to find that out
    spread = texts.withColumn("hashes", hashes).select("row", "id", "words", F.posexplode_outer("hashes").alias("at", "hash"))

    # k-grams of one width after those of another: where each of them begins
    starts, before = [], F.lit(1)
    for width in widths:
        starts.append((width, before))
        before = before + many[width]
    width, begin = F.size("gram"), F.lit(0)
    for w, first in starts:
        begin = F.when(width == w, first).otherwise(begin)
    p = F.greatest(F.col("at") - begin, F.lit(0))
    same = F.when(F.col("t").isNull(), F.col("at") == 0).otherwise((F.col("at") > 0) & (F.slice("words", p + 1, width) == F.col("gram")))
    found = spread.join(gram_table(docs.sparkSession, templates, slack), "hash").where(same)
    return found.select("row", "id", n.cast("bigint").alias("n"), p.alias("p"), "q", width.alias("width"), "t")


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[Template] = TEMPLATES,
    slack: int = SLACK,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """One row for each row of ``docs``: the id, n_words, and spans (start, end, label, phrase, share), in order.

    Places are words from 0, ends exclusive; ``share`` is the part of the template's k-grams that the span holds, 1 for
    phrases. A null or empty text has no words and no spans; null and repeated ids stay as they are, row by row; an
    empty table gives no rows; other columns are ignored. What is collected for a document is bounded by its own text.
    """
    if any(not t.words for t in templates):
        raise ValueError("a template needs words")
    # all that follows stays with the document's row, so the hits are dealt out once
    hits = _hits(docs, id_col, text_col, templates, slack).repartition("row")
    diagonals = hits.groupBy("row", "id", "n", "t", (F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.collect_set("q").alias("voted"), F.min("p").alias("first"), F.max(F.col("p") + F.col("width")).alias("last")
    )
    along = Window.partitionBy("row", "t").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.col("t.slack"), F.lit(False))
    islands = diagonals.withColumn("far", far.cast("int")).withColumn("island", F.sum("far").over(along))
    spans = islands.groupBy("row", "id", "n", "t", "island").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("voted")))).alias("voted"),
        F.min("first").alias("start"), F.max("last").alias("end"),
    )
    share = F.col("voted") / F.col("t.grams")
    span = F.struct(
        F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"),
        F.col("t.label").alias("label"), F.col("t.phrase").alias("phrase"), share.alias("share"),
    )
    kept = F.when(F.col("t").isNotNull() & (share >= min_share), span)
    rows = spans.groupBy("row", "id", "n").agg(F.sort_array(F.collect_list(kept)).alias("spans"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_words"), "spans")


def license_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[Template] = TEMPLATES
) -> DataFrame:
    """Numbers and labels of :func:`scan_licenses`. ``score`` is the largest share of a template found, 0 without any."""
    scanned = scan_licenses(docs, id_col, text_col, templates)
    phrases = F.filter("spans", lambda s: s["phrase"])
    starts = F.transform(phrases, lambda s: s["start"])

    def labels(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return scanned.select(
        id_col,
        "n_words",
        F.size(phrases).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(phrases).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )
