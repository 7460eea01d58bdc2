"""Ranked lexical search by scanning: an Aho-Corasick automaton of all query terms reads the documents, no index is built.

The distinct terms of the items go into automata, each term between two guards (blanks). In a text all that is not a term
becomes a blank, so a hit is a whole term, and neighbouring terms share their guard. One scan gives each document's number of
terms and how often it holds each query term; from these rows come the counts over the corpus, the weights, and the scores.
Tasks score their documents for a block of items at a time and hand on their best ones for each item only.

An automaton and a block of items have a bounded size: more terms make more automata, more items more blocks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.words import blocks
from rankflow.sources.workspace import stored

#: Characters of the terms in an automaton (a node each, about 50 bytes), on average over the blocks of terms.
AUTOMATON_CHARS = 1 << 21
#: Pairs of item and term in a block of items, and items, on average.
BLOCK_PAIRS, BLOCK_ITEMS = 1 << 20, 1024
#: Of longer terms the automaton holds the beginning; the rest is compared in the text.
LONG_TERM = 128
#: Cells of a table of scores (documents by items), and pairs of a document's term and an item that are expanded at once.
CELLS, EXPANDED = 1 << 20, 1 << 21
K = 10

_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of UTF-8: A-Z in lower case, other ASCII but digits and letters a blank.
_GUARDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_HITS = "row bigint, id bigint, n bigint, terms array<bigint>, tf array<bigint>"
_BEST = "asked bigint, id bigint, score bigint"


def terms_of(text: Column) -> Column:
    """The terms of ``text`` in order, with repeats."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(plain, _SEPARATORS), lambda t: t != "")


def _parts(total: int, size: int) -> int:
    return max(1, -(-total // size))


def _automaton(terms: Sequence[tuple[int, str]]):
    """The automaton of ``(number, term)`` and the long terms by their beginnings; values below 0 point to those."""
    import ahocorasick

    found, long_terms = ahocorasick.Automaton(), {}
    for number, term in terms:
        if len(term) < LONG_TERM:
            found.add_word(f" {term} ", number)
        else:
            long_terms.setdefault(term[:LONG_TERM], []).append((number, term))
    long_lists = list(long_terms.values())
    for place, (head, _) in enumerate(long_terms.items()):
        found.add_word(f" {head}", -1 - place)
    if len(found):
        found.make_automaton()
    return found, long_lists


def _matches(automaton, long_lists, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the terms in ``text``, which is guarded, end (the place of the guard after them), and their numbers."""
    flat = np.fromiter(itertools.chain.from_iterable(automaton.iter(text)), dtype=np.int64) if len(automaton) else np.zeros(0, np.int64)
    ends, numbers = flat[::2], flat[1::2]
    short = numbers >= 0
    more = []
    for end, number in zip(ends[~short].tolist(), numbers[~short].tolist()):
        begin = end - LONG_TERM + 1
        stop = text.index(" ", begin)
        more += [(stop, n) for n, term in long_lists[-1 - number] if stop - begin == len(term) and text.startswith(term, begin)]
    ends, numbers = ends[short], numbers[short]
    if more:
        ends = np.concatenate([ends, np.array([m[0] for m in more], dtype=np.int64)])
        numbers = np.concatenate([numbers, np.array([m[1] for m in more], dtype=np.int64)])
    return ends, numbers


def _scanner(terms):
    """Batches of row, id, text to rows of ``_HITS``. ``terms`` is a broadcast list of number and term."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, long_lists = _automaton(terms.value)
        for batch in batches:
            first = 0
            for texts in blocks(batch.column("text")):
                plain = [(t or "").encode().translate(_GUARDED).decode() for t in texts.to_pylist()]
                n = np.array([len(t.encode().split()) for t in plain], dtype=np.int64)
                offsets = np.cumsum([0] + [len(t) + 1 for t in plain])
                ends, numbers = _matches(automaton, long_lists, " " + " ".join(plain) + " ")
                places = np.searchsorted(offsets, ends - 2, side="right") - 1
                order = np.lexsort((numbers, places))
                places, numbers = places[order], numbers[order]
                new = np.ones(len(numbers), dtype=bool)
                new[1:] = (np.diff(places) != 0) | (np.diff(numbers) != 0)
                at = np.flatnonzero(new)
                tf = np.diff(np.append(at, len(numbers)))
                bounds = np.searchsorted(places[at], np.arange(len(plain) + 1)).astype(np.int32)
                part = batch.slice(first, len(plain))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), part.column("id"), pa.array(n, pa.int64()),
                        pa.ListArray.from_arrays(bounds, pa.array(numbers[at], pa.int64())),
                        pa.ListArray.from_arrays(bounds, pa.array(tf, pa.int64())),
                    ],
                    names=["row", "id", "n", "terms", "tf"],
                )
                first += len(plain)

    return scan


def _best_of(keep, items, ids, known, scores, k):
    """The ``k`` best of each item among what was kept and the new rows (item, id, whether there is one, score)."""
    items, ids, known, scores = (np.concatenate([a, b]) for a, b in zip(keep, (items, ids, known, scores)))
    order = np.lexsort((ids, known, -scores, items))
    items, ids, known, scores = items[order], ids[order], known[order], scores[order]
    first = np.searchsorted(items, items, side="left")
    best = np.arange(len(items)) - first < k
    return items[best], ids[best], known[best], scores[best]


def _scorer(postings, documents: int, words: int, k: int):
    """Batches of ``_HITS`` to the ``k`` best documents of each item of a block.

    ``postings`` is broadcast: the items; numbers of terms in order, each as often as it has items; and for each of
    them the place of the item and the weight times the repeats.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, term, item, weight = postings.value
        n_items = len(asked)
        keep = tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, bool, np.int64))
        least = np.ones(n_items, dtype=np.int64)  # scores below cannot be among the k best any more
        rows = max(1, CELLS // n_items)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                lists, counts = part.column("terms"), part.column("tf")
                sizes = np.diff(np.asarray(lists.offsets))
                doc = np.repeat(np.arange(part.num_rows), sizes)
                terms, tf = np.asarray(lists.flatten()), np.asarray(counts.flatten())
                n = np.asarray(part.column("n"))
                m = 25 + (75 * n * documents) // max(1, words)
                gain = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
                low, high = np.searchsorted(term, terms, side="left"), np.searchsorted(term, terms, side="right")
                many = high - low
                table = np.zeros(part.num_rows * n_items, dtype=np.int64)
                # a bounded number of terms at a time, as a term may stand in every item
                cuts = np.searchsorted(np.cumsum(many), np.arange(0, int(many.sum()) + EXPANDED, EXPANDED), side="left")
                for a, b in zip(cuts[:-1].tolist(), [*cuts[1:-1].tolist(), len(many)]):
                    times = many[a:b]
                    each = np.repeat(np.arange(a, b), times)
                    place = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times) + low[each]
                    np.add.at(table, doc[each] * n_items + item[place], weight[place] * gain[each])
                hit = np.flatnonzero(table.reshape(-1, n_items) >= least)
                ids = part.column("id")
                known = np.asarray(ids.is_valid())
                ids = np.asarray(ids.fill_null(0))
                of = hit // n_items
                keep = _best_of(keep, hit % n_items, ids[of], known[of], table[hit], k)
                full = np.flatnonzero(np.bincount(keep[0], minlength=n_items) == k)
                least[full] = keep[3][np.searchsorted(keep[0], full, side="right") - 1]
        items, ids, known, scores = keep
        yield pa.RecordBatch.from_arrays(
            [pa.array(asked[items], pa.int64()), pa.array(ids, pa.int64(), mask=~known), pa.array(scores, pa.int64())],
            names=["asked", "id", "score"],
        )

    return score


def _term_table(pairs: DataFrame, automaton_chars: int) -> tuple[DataFrame, int]:
    """block, number, term of all distinct terms, and how many blocks there are. A number is unique over all blocks."""
    distinct = stored(pairs.select("term").distinct(), "search-terms")
    chars = distinct.agg(F.sum(F.least(F.length("term"), F.lit(LONG_TERM)) + 2)).first()[0] or 0
    parts = _parts(chars, automaton_chars)
    block = F.pmod(F.xxhash64("term"), F.lit(parts))
    nth = F.row_number().over(Window.partitionBy("block").orderBy("term"))
    numbered = distinct.withColumn("block", block).withColumn("number", F.shiftleft("block", 32) + nth)
    return stored(numbered, "search-numbers"), parts


def _hits(docs: DataFrame, terms: DataFrame, parts: int) -> DataFrame:
    """``_HITS`` of each row of ``docs`` (row, id, text): one scan for each automaton."""
    context, scans = docs.sparkSession.sparkContext, []
    for part in range(parts):
        own = [(r.number, r.term) for r in terms.where(F.col("block") == part).select("number", "term").collect()]
        scans.append(docs.mapInArrow(_scanner(context.broadcast(own)), _HITS))
    if parts == 1:
        return stored(scans[0], "search-hits")
    every = scans[0]
    for scan in scans[1:]:
        every = every.unionByName(scan)
    met = stored(every, "search-parts").groupBy("row", "id", "n")
    found = met.agg(F.flatten(F.collect_list("terms")).alias("terms"), F.flatten(F.collect_list("tf")).alias("tf"))
    return stored(found, "search-hits")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = K,
    automaton_chars: int = AUTOMATON_CHARS,
    block_pairs: int = BLOCK_PAIRS,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """item id, rank, document id, score: the ``k`` best documents of each row of ``items``, best first, none without a score.

    Of equal scores the lower document id comes first (null before all). Ids of documents are whole numbers. A null text has
    no terms; an item without terms, or whose terms no document holds, has no rows. Repeated rows of ``docs`` are documents
    of their own and each row of ``items`` is ranked by itself, also with a repeated or null id. Empty tables give
    no rows; other columns are ignored.
    """
    asked = items.select(F.monotonically_increasing_id().alias("asked"), F.col(item_col).alias("item_id"), terms_of(F.col(item_text_col)).alias("terms"))
    asked = stored(asked, "search-items")
    pairs = asked.select("asked", F.explode("terms").alias("term")).groupBy("asked", "term").agg(F.count(F.lit(1)).alias("repeats"))
    pairs = stored(pairs, "search-pairs")
    terms, parts = _term_table(pairs, automaton_chars)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    if parts > 1:
        rows = stored(rows, "search-texts")  # the scans must agree on the rows' numbers
    hits = _hits(rows, terms, parts)

    corpus = hits.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    held = hits.select(F.explode("terms").alias("number")).groupBy("number").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2 * corpus.documents + F.lit(2)).cast("double") / (2 * F.col("df") + 1)))
    weights = terms.join(held, "number").select("term", "number", weight.cast("bigint").alias("weight"))
    blocks_of = max(_parts(pairs.count(), block_pairs), _parts(asked.count(), block_items))
    block = F.pmod(F.xxhash64("asked"), F.lit(blocks_of)).alias("block")
    postings = pairs.join(weights, "term").select(block, "asked", "number", (F.col("weight") * F.col("repeats")).alias("gain"))
    postings = stored(postings.where("gain > 0"), "search-postings")

    context, found = docs.sparkSession.sparkContext, []
    for part in range(blocks_of):
        own = postings.where(F.col("block") == part).select("asked", "number", "gain").orderBy("number").toArrow()
        if not own.num_rows:
            continue
        asked_ids, item = np.unique(np.asarray(own["asked"]), return_inverse=True)
        shared = context.broadcast((asked_ids, np.asarray(own["number"]), item.astype(np.int64), np.asarray(own["gain"])))
        found.append(hits.mapInArrow(_scorer(shared, corpus.documents, corpus.words, k), _BEST))
    if not found:
        found.append(asked.select("asked", F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("score")).limit(0))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), F.asc_nulls_first("id")))
    ranked = every.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.join(asked.select("asked", "item_id"), "asked").select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score"
    )
